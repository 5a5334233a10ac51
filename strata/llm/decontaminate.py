"""Benchmark decontamination by winnowing.

From every window of consecutive ``gram``-word hashes that spans ``span``
words the minimum is kept as a fingerprint, in documents and benchmark items
alike, so two texts that share ``span`` words share a fingerprint there: no
long enough overlap can be missed.  Fingerprints of both sides are joined; each
hit is extended word by word, on the words themselves, as far as a window
reaches, and counts if the matched stretch holds a whole window.

Items shorter than a window are one window themselves; each such length is its
own span with its own fingerprints.

Plan: one pass over the documents returns a small row per document and its
fingerprints with a few words around.  If the benchmark's distinct
fingerprints are at most ``max_broadcast`` (counted first; 8 bytes each), they
are sent to the tasks, which then return only fingerprints that hit; beyond
that all fingerprints go to the join, with the same result.  The benchmark's
contexts carry no broadcast hint: they are written, and the planner chooses by
their measured bytes.  Document texts are never shuffled.

Defined cases: NULL, empty and wordless texts have no words: such a document
is clean, such an item has no window; repeated documents get equal results;
repeated items are one item; a NULL item id is named by the empty string;
extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import KEY, doc_id, keyed, written
from strata.llm.textnp import BYTE, U, mix, sliding, sliding_min, span_hash, text_chunks, word_spans

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Separators after lower-casing: everything in ASCII but digits and letters.
SEPARATOR = np.ones(256, bool)
SEPARATOR[list(b"0123456789abcdefghijklmnopqrstuvwxyz")] = False
SEPARATOR[128:] = False

GRAM = 5
FIELDS = "key long, _doc long, _hash long, span long, pos long, gram string, before array<string>, after array<string>"


def winnow(words: np.ndarray, first: np.ndarray, span: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the minimal ``gram``-word hashes of all windows of ``span`` words within a row (every minimum of a tie)."""
    n = len(words)
    if n < span:
        return np.empty(0, np.int64), np.empty(0, U)
    i = np.arange(n - gram + 1)
    grams = span_hash(words, i, i + gram)
    w = span - gram + 1
    low = sliding_min(grams, w)
    edge = np.zeros(len(low) + 1, np.int32)
    np.add.at(edge, np.clip(first[1:-1] - span + 1, 0, len(low)), 1)
    np.add.at(edge, np.clip(first[1:-1], 0, len(low)), -1)
    valid = np.cumsum(edge[:-1]) == 0
    padded = np.zeros(len(low) + 2 * (w - 1), U)
    padded[w - 1:w - 1 + len(low)] = np.where(valid, low, U(0))
    at = np.flatnonzero(grams == sliding(np.maximum, padded, w))
    return at, mix(grams[at] + U(span))


def _fingerprints(batch_text: pa.Array, spans: list[int], whole: bool, among: np.ndarray | None):
    """Per chunk: ``(row, row_end, words per row, fingerprint rows)``; ``whole``: only rows of just ``span`` words for short spans."""
    for lo, hi, data, offs in text_chunks(batch_text):
        low = LOWER[data]
        s, e, first = word_spans(low, offs, SEPARATOR)
        hashed = span_hash(BYTE[low], s, e)
        count = np.diff(first)
        raw, rows = low.tobytes(), []
        longest = max(spans, default=0)
        for span in spans:
            gram = min(GRAM, span)
            at, key = winnow(hashed, first, span, gram)
            if among is not None and len(at):
                hit = among[np.minimum(np.searchsorted(among, key), len(among) - 1)] == key if len(among) else np.zeros(len(at), bool)
                at, key = at[hit], key[hit]
            row = np.searchsorted(first, at, "right") - 1
            if whole:
                # An item has one span: the longest if it has as many words, else its own number of words.
                mine = (count[row] >= span) if span == longest else (count[row] == span)
                at, key, row = at[mine], key[mine], row[mine]
            reach = span - gram
            for a, k, r in zip(at.tolist(), key.view(np.int64).tolist(), row.tolist(), strict=True):
                word = lambda i: raw[s[i]:e[i]].decode()  # noqa: E731, B023
                rows.append((r, k, span, a - int(first[r]), " ".join(map(word, range(a, a + gram))),
                             [word(i) for i in range(a - 1, max(a - 1 - reach, int(first[r]) - 1), -1)],
                             [word(i) for i in range(a + gram, min(a + gram + reach, int(first[r + 1])))]))
        yield lo, hi, count, rows


def _table(docs: DataFrame, spans: list[int], whole: bool, among=None) -> DataFrame:
    """Rows of one pass: per row ``span`` 0 with ``pos`` its number of words, and its fingerprints."""
    kinds = [pa.int64()] * 5 + [pa.string(), pa.list_(pa.string()), pa.list_(pa.string())]
    names = ["key", *KEY, "span", "pos", "gram", "before", "after"]

    def run(batches):
        for batch in batches:
            ids, hashes = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lo, hi, count, found in _fingerprints(batch.column(2), spans, whole, among.value if among else None):
                rows = [(None, ids[lo + i], hashes[lo + i], 0, n, None, None, None) for i, n in enumerate(count.tolist())]
                rows += [(k, ids[lo + r], hashes[lo + r], sp, p, g, b, a) for r, k, sp, p, g, b, a in found]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return docs.mapInArrow(run, FIELDS)


def _agree(a: str, b: str):
    """How many words two arrays share from the front."""
    same = F.filter(F.sequence(F.lit(1), F.least(F.size(a), F.size(b))), lambda i: F.slice(a, F.lit(1), i) == F.slice(b, F.lit(1), i))
    return F.when(F.least(F.size(a), F.size(b)) > 0, F.size(same)).otherwise(0)


def contamination(docs: DataFrame, benchmark: DataFrame, span: int = 10, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", max_broadcast: int = 1_000_000) -> DataFrame:
    """One row per document: ``_doc, _hash, doc_id, n_words, hits`` (word intervals, merged) ``, n_hit, items`` (sorted ids as strings)."""
    spark = docs.sparkSession
    items = keyed(benchmark, item_col, item_text_col)
    # Which short lengths there are: at most span - 1 numbers.
    short = [r["pos"] for r in _table(items, [], True).where(f"pos > 0 AND pos < {int(span)}").select("pos").distinct().collect()]
    spans = sorted(short) + [span]
    prints = written(_table(items, spans, True).where("span > 0"), "winnow-items")
    keys = prints.select("key").distinct()
    few = keys.limit(max_broadcast + 1).count() <= max_broadcast
    among = spark.sparkContext.broadcast(np.sort(keys.toArrow()["key"].to_numpy().view(U))) if few else None
    rows = written(_table(keyed(docs, id_col, text_col), spans, False, among), "winnow-docs")
    # Equal contexts of many items are one row with all their ids.
    known = written(prints.groupBy("key", "span", "gram", F.col("before").alias("b"), F.col("after").alias("a")).agg(
        F.collect_set(F.when(F.col("_doc") == -(2 ** 63), "").otherwise(F.col("_doc").cast("string"))).alias("ids")), "winnow-known")
    # Written, so the planner sees their size and broadcasts them only below its byte threshold; else hot hits are split as skew.
    hits = rows.where("span > 0").join(known, ["key", "span", "gram"])
    left, right, gram = _agree("before", "b"), _agree("after", "a"), F.least(F.lit(GRAM), F.col("span"))
    extended = hits.select(*KEY, "ids", "span", (F.col("pos") - left).alias("from"), (F.col("pos") + gram + right).alias("to")) \
        .where(F.col("to") - F.col("from") >= F.col("span"))
    stretches = extended.groupBy(*KEY).agg(F.sort_array(F.collect_set(F.struct("from", "to"))).alias("s"),
                                           F.sort_array(F.array_distinct(F.flatten(F.collect_set("ids")))).alias("items"))
    total = F.aggregate("s", F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end")),
                        lambda acc, x: F.struct((acc["n"] + F.greatest(F.lit(0).cast("long"), x["to"] - F.greatest(x["from"], acc["end"]))).alias("n"),
                                                F.greatest(acc["end"], x["to"]).alias("end")))["n"]
    return rows.where("span = 0").select(*KEY, F.col("pos").alias("n_words")).join(
        stretches.select(*KEY, "s", total.alias("n_hit"), "items"), KEY, "left").select(
        *KEY, doc_id(), "n_words", F.coalesce("s", F.array().cast("array<struct<from:bigint,to:bigint>>")).alias("hits"),
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` without any word in a benchmark window, all columns unchanged."""
    hit = contamination(docs, benchmark, id_col=id_col, text_col=text_col, **options).where("n_hit > 0").select(*KEY).distinct()
    # The row travels as one struct, so its columns may have any names.
    marked = docs.select(F.struct(*docs.columns).alias("row"), F.coalesce(F.col(id_col).cast("long"), F.lit(-(2 ** 63))).alias("_doc"),
                         F.xxhash64(text_col).alias("_hash"))
    return marked.join(hit, KEY, "left_anti").select("row.*")
