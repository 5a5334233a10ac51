"""SimHash near-duplicates by anchor-point covering.

A fingerprint has one bit per hash bit: set if it is set in over half of the
hashes of the text's word shingles.  Distinct fingerprints at ``threshold`` or
fewer differing bits are linked; documents in one connected component are near
duplicates.

Anchors are the words of a covering code on 46 of the 64 bits: the product of
two binary Golay codes (23 bits, 4096 words, covering radius 3 each).  Every
fingerprint has one home anchor, within the covering radius of each half, and
is replicated to every anchor within radius plus threshold.  For fingerprints
x and y that differ in ``t`` bits, of which ``t1`` and ``t2`` fall in the
halves, home(x) lies within 3 + t1 and 3 + t2 of y's halves, so y is replicated
to it: every link meets at an anchor (exact, no false negatives).  In an
anchor only rows of which one is at home are compared, by the exact distance.

Copies collapse first (one row per distinct fingerprint, with the smallest
id), so a group of copies of any size is one row.  Within an anchor no pairs
are listed: big groups are linked through shared neighbours (two words differ
in at most 2 bits exactly if they share a word within 1 bit), each to the
smallest member, in linear time and memory.  An anchor with more than
``max_anchor`` fingerprints is not held in its task at all: its rows pass
through, and the same neighbour rule is a grouping by neighbour over all
tasks, where a group has at most 65 members.
"""

from __future__ import annotations

import functools
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import partitions, written
from strata.llm.graph import components

# Generator polynomial of the binary Golay code: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
N, GENERATOR = 23, 0b110001110101
LOW = (1 << N) - 1
MAX_THRESHOLD = 2


def fingerprint(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """SimHash of the ``shingle``-word shingles of a text, repeats included; 0 without words."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle, len(words))
    digest, n = xxhash.xxh64_intdigest, len(words) - k + 1
    ones = np.zeros(64, np.int64)
    for lo in range(0, n, 1 << 15):
        hi = min(n, lo + (1 << 15))
        h = np.array([digest(joined[a:b], seed) for a, b in zip(starts[lo:hi].tolist(), ends[lo + k - 1:hi + k - 1].tolist(), strict=True)], np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``(doc_id, h, fp)``: content hash and fingerprint (a signed long) of every row."""
    def run(batches):
        for batch in batches:
            fps = np.array([fingerprint((t.as_py() or "").encode(), shingle) for t in batch.column(2)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps)], names=["doc_id", "h", "fp"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("h"), F.col(text_col)) \
        .mapInArrow(run, "doc_id long, h long, fp long")


def _syndrome(x: np.ndarray) -> np.ndarray:
    """Remainder of 23-bit words by the generator polynomial."""
    x = x.astype(np.int64).copy()
    for bit in range(N - 1, 10, -1):
        x ^= np.where(x >> bit & 1, GENERATOR << bit - 11, 0)
    return x


@functools.cache
def _patterns(reach: int):
    """Error patterns of weight up to ``reach`` by syndrome: patterns and weights sorted by syndrome and weight, and where each syndrome begins."""
    errors = np.array([sum(1 << b for b in c) for w in range(reach + 1) for c in combinations(range(N), w)], np.int64)
    weights = np.array([w for w in range(reach + 1) for _ in combinations(range(N), w)], np.int64)
    s = _syndrome(errors)
    order = np.lexsort((weights, s))
    return errors[order], weights[order], np.searchsorted(s[order], np.arange((1 << 11) + 1))


def anchors(fps: np.ndarray, threshold: int = MAX_THRESHOLD):
    """``(row, anchor, home)`` of every replica: the row of the fingerprint, the 46-bit anchor, whether it is the home."""
    errors, weights, first = _patterns(3 + threshold)
    x = fps.view(np.uint64)
    halves = [(x >> np.uint64(N * i) & np.uint64(LOW)).astype(np.int64) for i in (0, 1)]
    row = np.arange(len(fps))
    excess, code = np.zeros(len(fps), np.int64), np.zeros(len(fps), np.int64)
    for i, half in enumerate(halves):
        syn = _syndrome(half)[row]
        n = first[syn + 1] - first[syn]
        rep = np.repeat(np.arange(len(row)), n)
        at = np.arange(len(rep)) - np.repeat(np.cumsum(n) - n, n) + first[syn][rep]
        more = np.maximum(weights[at] - 3, 0)
        ok = excess[rep] + more <= threshold
        rep, at = rep[ok], at[ok]
        excess = excess[rep] + more[ok]
        code = code[rep] | (half[row[rep]] ^ errors[at]) << N * i
        row = row[rep]
    return row, code, excess == 0


def _links(anchor: np.ndarray, fp: np.ndarray, home: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between fingerprints that share an anchor, rows sorted by anchor; whole anchors only."""
    a, b = [], []
    bounds = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1], [True])))
    size = np.diff(bounds)
    homes = np.add.reduceat(home, bounds[:-1]) if len(fp) else home
    live = (size > 1) & (homes > 0)
    big = live & (size > 64)
    keep = np.repeat(live & ~big, size)
    an, f, ho = anchor[keep], fp[keep], home[keep]
    lag = 1
    while len(f) > lag:
        same = an[lag:] == an[:-lag]
        if not same.any():
            break
        near = same & (ho[lag:] | ho[:-lag]) & (np.bitwise_count(f[lag:] ^ f[:-lag]) <= threshold)
        a.append(f[:-lag][near])
        b.append(f[lag:][near])
        lag += 1
    for i in np.flatnonzero(big):
        x = np.unique(fp[bounds[i]:bounds[i + 1]])
        for y, z in _stars(x, threshold):
            a.append(y)
            b.append(z)
    if not a:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    return np.concatenate(a), np.concatenate(b)


def _stars(x: np.ndarray, threshold: int):
    """Spanning links of the distinct words ``x`` at ``threshold`` 1 or 2: words that share a neighbour, each to the smallest."""
    flips = np.concatenate(([0], np.uint64(1) << np.arange(64, dtype=np.uint64))).astype(np.uint64)
    if threshold < 2:
        for bit in flips[1:] if threshold else []:
            hit = np.isin(x ^ bit, x)
            yield x[hit], (x ^ bit)[hit]
        return
    near = (x[:, None] ^ flips[None, :]).ravel()
    owner = np.repeat(x, len(flips))
    order = np.lexsort((owner, near))
    near, owner = near[order], owner[order]
    start = np.concatenate(([True], near[1:] != near[:-1]))
    least = owner[np.flatnonzero(start)][np.cumsum(start) - 1]
    linked = owner != least
    pairs = np.unique(np.stack([owner[linked], least[linked]], 1), axis=0)
    yield pairs[:, 0], pairs[:, 1]


def _neighbour_links(fps: DataFrame, threshold: int) -> DataFrame:
    """``(a, b)``: the links of :func:`_stars` for fingerprints ``a`` of any number, grouped by neighbour (at most 65 each)."""
    if not threshold:
        return fps.select("a", F.col("a").alias("b")).limit(0)
    flips = [0, *(1 << b for b in range(63)), -(1 << 63)]
    near = fps.select("a", F.explode(F.array(*(F.col("a").bitwiseXOR(F.lit(f).cast("long")) for f in flips))).alias("near"))
    owners = near.groupBy("near").agg(F.sort_array(F.collect_set("a")).alias("owners")).where(F.size("owners") > 1)
    if threshold == 1:
        # Owners of a word that is a fingerprint itself are one bit from it, others two bits from each other.
        return owners.where(F.array_contains("owners", F.col("near"))).select(F.col("near").alias("a"), F.explode("owners").alias("b")).where("a <> b")
    return owners.select(F.col("owners")[0].alias("a"), F.explode(F.slice("owners", 2, len(flips))).alias("b"))


def link_fingerprints(fps: DataFrame, threshold: int = MAX_THRESHOLD, max_anchor: int = 100_000) -> DataFrame:
    """``(a, b)``: links that connect all distinct ``fp`` at up to ``threshold`` (2 at most) differing bits."""
    if not 0 <= threshold <= MAX_THRESHOLD:
        raise ValueError(f"threshold must be 0 to {MAX_THRESHOLD}")

    def replicate(batches):
        for batch in batches:
            fp = batch.column(0).to_numpy()
            for lo in range(0, len(fp), 4096):
                part = fp[lo:lo + 4096]
                row, code, home = anchors(part, threshold)
                yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(part[row]), pa.array(home)], names=["anchor", "fp", "home"])

    def compare(batches):
        def passed(fp: np.ndarray) -> pa.RecordBatch:
            """Fingerprints of an anchor too big for a task: ``a`` without ``b``."""
            return pa.RecordBatch.from_arrays([pa.array(fp), pa.nulls(len(fp), pa.int64())], names=["a", "b"])

        def flush(t: pa.Table):
            anchor, fp, home = (t[c].to_numpy() for c in ("anchor", "fp", "home"))
            bounds = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1], [True])))
            many = np.repeat(np.diff(bounds) > max_anchor, np.diff(bounds))
            if many.any():
                yield passed(np.unique(fp[many]))
                anchor, fp, home = anchor[~many], fp[~many], home[~many]
            a, b = _links(anchor, fp.view(np.uint64), home, threshold) if len(fp) else (fp, fp)
            both = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1), axis=0) if len(a) else np.empty((0, 2), np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(both[:, i].copy().view(np.int64)) for i in (0, 1)], names=["a", "b"])

        held: list[pa.RecordBatch] = []
        rows, hot = 0, None
        for batch in batches:
            if hot is not None:
                cut = int(np.searchsorted(batch.column(0).to_numpy(), hot, "right"))
                yield passed(batch.column(1).slice(0, cut).to_numpy())
                batch = batch.slice(cut)
                if not len(batch):
                    continue
                hot = None
            held.append(batch)
            rows += len(batch)
            # Enough rows: everything before the last anchor, which may go on, is complete.
            if rows > 5 * max_anchor:
                t = pa.Table.from_batches(held).combine_chunks()
                code = t["anchor"].to_numpy()
                cut = int(np.searchsorted(code, code[-1], "left"))
                if cut:
                    yield from flush(t.slice(0, cut))
                last = t.slice(cut)
                held, rows = last.to_batches(), len(last)
                if rows > max_anchor:
                    hot = code[-1]
                    yield passed(last["fp"].to_numpy())
                    held, rows = [], 0
        if rows:
            yield from flush(pa.Table.from_batches(held).combine_chunks())

    # Fingerprints are few bytes and their replicas many: dealt out by number first, or few tasks would make them all.
    dealt = fps.select("fp").repartition(partitions(fps), "fp").mapInArrow(replicate, "anchor long, fp long, home boolean") \
        .repartition(partitions(fps), "anchor").sortWithinPartitions("anchor")
    found = written(dealt.mapInArrow(compare, "a long, b long"), "simhash-links")
    links, big = found.where("b IS NOT NULL"), found.where("b IS NULL").select("a").distinct()
    return (links if big.isEmpty() else links.union(_neighbour_links(big, threshold))).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    threshold: int = MAX_THRESHOLD, max_anchor: int = 100_000) -> DataFrame:
    """``(doc_id, h, fp, root, component_id)`` for every row: the component's smallest fingerprint and smallest ``doc_id``.

    Defined cases: NULL, empty and blank texts have fingerprint 0 and link
    like any other; a text shorter than a shingle is one shingle; repeated
    rows are one fingerprint; a NULL id is never the smallest unless all ids
    of its component are NULL; extra columns are ignored.
    """
    rows = written(fingerprints(docs, id_col, text_col, shingle), "simhash")
    distinct = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    parts = components(link_fingerprints(rows.select("fp").distinct(), threshold, max_anchor))
    named = distinct.join(parts, distinct["fp"] == parts["node"], "left") \
        .select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = written(named, "simhash-roots")
    smallest = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return rows.join(named.join(smallest, "root").select("fp", "root", "component_id"), "fp") \
        .select("doc_id", "h", "fp", "root", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row of each component: the smallest id (NULL last), then the smallest content hash; all columns unchanged."""
    found = near_duplicates(docs, id_col, text_col, **options)
    doc = F.coalesce(F.col("doc_id"), F.lit(-(2 ** 63)))
    chosen = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), doc.alias("_doc"), F.col("h").alias("_hash"))).alias("k")) \
        .select("k._doc", "k._hash")
    # The row travels as one struct, so its columns may have any names.
    marked = docs.select(F.struct(*docs.columns).alias("row"), F.coalesce(F.col(id_col).cast("long"), F.lit(-(2 ** 63))).alias("_doc"),
                         F.xxhash64(text_col).alias("_hash"))
    return marked.join(chosen, ["_doc", "_hash"], "left_semi").dropDuplicates(["_doc", "_hash"]).select("row.*")
