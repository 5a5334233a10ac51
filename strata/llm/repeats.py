"""Windows of a text that occur more than once in a corpus: the distributed part shared by both substring operators.

A window is ``length`` consecutive units (words or bytes) of one document.

1. Anchors: each window is named by the smallest hash of the ``gram``-unit
   sequences in it.  Consecutive windows with one anchor form a run; equal
   windows have equal anchors wherever they stand.  One pass over the texts
   returns one small row per run.
2. Candidates: runs whose anchor occurs once are unique and leave here.  The
   counts are partial aggregates; runs and counts meet in a sort-merge join,
   which splits hot anchors.
3. Segments: a candidate run's text is sent once per distinct content, with
   the number of its occurrences.  Contents are told apart by a 128-bit digest
   of their bytes, taken in the pass over the texts.
4. Shards: segments of one anchor come together; groups of anchors up to a
   byte bound are given to a ``finder``, an index that decides which windows
   of a segment occur at least twice.
   An anchor with more than ``hot`` different segments (a phrase in very many
   surroundings) is split by a deeper name: its segments are searched like
   documents, with anchors of a longer ``gram``, up to the window itself.  A
   longer anchor reaches into the surroundings, so such groups fall apart, and
   all of them end in the same finder.
5. The covered intervals go back to all occurrences and to their documents.

Windows of copies never multiply: a third of all rows may be one text, which
is one segment per run here.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import KEY, keyed, partitions, written
from strata.llm.textnp import BYTE, SPACE, U, mix, powers, sliding, sliding_min, span_hash, text_chunks, word_spans

#: ``(key, digest, occurrences, windows, content)`` of one distinct segment.
Segment = tuple[int, tuple[int, int], int, int, bytes]
#: The digest of a segment's content, as two longs.
DIGEST = ["d1", "d2"]
SPANS = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
Finder = Callable[[list[Segment]], Iterator[tuple[Segment, list[tuple[int, int]]]]]


@dataclass(frozen=True)
class Kind:
    """What a unit is, and the parameters of a search."""

    words: bool
    length: int
    gram: int
    shard_bytes: int
    hot: int

    def units(self, data: np.ndarray, offs: np.ndarray):
        """Hash values of the units of all rows and the first unit of each row."""
        if not self.words:
            return BYTE[data], offs
        s, e, first = word_spans(data, offs)
        return span_hash(BYTE[data], s, e), first

    def deeper(self) -> Kind:
        """The same search with longer anchors; the last ones are the windows themselves, and no group is too large for it."""
        near = self.length - self.length // 16
        gram = 2 * self.gram if 2 * self.gram < near else near if self.gram < near else self.length
        return replace(self, gram=gram, hot=self.hot if gram < self.length else 1 << 62)

    def bytes_of(self, data: np.ndarray, offs: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
        """The units of all rows as one string, and where each of them begins and ends in it; words have one space between them."""
        if not self.words:
            at = np.arange(len(data) + 1, dtype=np.int64)
            return data.tobytes(), at[:-1], at[1:]
        s, e, _ = word_spans(data, offs)
        keep = ~SPACE[data]
        size = e - s
        begin = np.cumsum(size + 1) - size - 1
        out = np.full(int((size + 1).sum()), 32, np.uint8)
        inside = np.ones(len(out), bool)
        inside[begin + size] = False
        out[inside] = data[keep]
        return out.tobytes(), begin, begin + size

    def split(self, text: bytes):
        return text.split() if self.words else text

    def join(self, units) -> bytes:
        return b" ".join(units) if self.words else bytes(units)


def runs(values: np.ndarray, first: np.ndarray, length: int, gram: int):
    """``(row, first unit, start, windows, key, anchors)`` of all runs; ``start`` counts from the row's first unit.

    ``anchors`` is 2 if the run holds its anchor more than once (then it may
    repeat within itself), else 1.  Runs longer than ``length`` are cut.
    """
    n, w = len(values), length - gram + 1
    none = [np.empty(0, np.int64)] * 4 + [np.empty(0, U), np.empty(0, np.int64)]
    if n < length:
        return none
    p, q = powers(n + 1)
    c = np.zeros(n + 1, U)
    np.cumsum(values * p[:-1], out=c[1:])
    grams = mix((c[gram:] - c[:-gram]) * q[:n - gram + 1])
    low = sliding_min(grams, w)
    # Windows that reach over the end of a row are none.
    edge = np.zeros(len(low) + 1, np.int32)
    ends = first[1:-1]
    np.add.at(edge, np.clip(ends - length + 1, 0, len(low)), 1)
    np.add.at(edge, np.clip(ends, 0, len(low)), -1)
    # Rows shorter than a window overlap their neighbours' marks, which the sum handles.
    valid = np.cumsum(edge[:-1]) == 0
    begin = valid.copy()
    begin[1:] &= ~valid[:-1] | (low[1:] != low[:-1])
    stop = valid.copy()
    stop[:-1] &= ~valid[1:] | (low[1:] != low[:-1])
    a, b = np.flatnonzero(begin), np.flatnonzero(stop) + 1
    if not len(a):
        return none
    key = low[a]
    # Positions that are the minimum of some window; neighbours in that order with one value stand in one run.
    padded = np.zeros(len(low) + 2 * (w - 1), U)
    padded[w - 1:w - 1 + len(low)] = np.where(valid, low, U(0))
    anchor = np.flatnonzero(grams == sliding(np.maximum, padded, w))
    row_of = np.searchsorted(first, anchor, "right")
    fresh = np.ones(len(anchor), bool)
    fresh[1:] = (grams[anchor[1:]] != grams[anchor[:-1]]) | (row_of[1:] != row_of[:-1])
    group = np.flatnonzero(fresh)
    many = np.diff(np.append(group, len(anchor)))
    many = np.minimum(many, 2) if len(many) == len(a) else np.full(len(a), 2)
    # Cut long runs.
    parts = -(-(b - a) // length)
    if parts.max() > 1:
        rep = np.repeat(np.arange(len(a)), parts)
        nth = np.arange(len(rep)) - np.repeat(np.cumsum(parts) - parts, parts)
        a, b = a[rep] + nth * length, np.minimum(b[rep], a[rep] + (nth + 1) * length)
        key, many = key[rep], np.where(parts[rep] > 1, 2, many[rep])
    row = np.searchsorted(first, a, "right") - 1
    # Empty rows share a first unit with the next: the run is in the last of them, which the search gives.
    return row, a, a - first[row], b - a, key, many


def _anchor_rows(docs: DataFrame, kind: Kind) -> DataFrame:
    def run(batches):
        for batch in batches:
            for lo, hi, data, offs in text_chunks(batch.column(2)):
                values, first = kind.units(data, offs)
                row, unit, start, n, key, many = runs(values, first, kind.length, kind.gram)
                if not len(row):
                    continue
                text, begin, end = kind.bytes_of(data, offs)
                cut = zip(begin[unit].tolist(), end[unit + n + kind.length - 2].tolist(), strict=True)
                digest = np.frombuffer(b"".join([hashlib.blake2b(text[i:j], digest_size=16).digest() for i, j in cut]), np.int64).reshape(-1, 2)
                at = pa.array(row + lo)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), pa.array(digest[:, 0].copy()), pa.array(digest[:, 1].copy()), batch.column(0).take(at), batch.column(1).take(at),
                     pa.array(start.astype(np.int64) << 16 | n), pa.array(many)],
                    names=["key", *DIGEST, *KEY, "place", "many"])

    return docs.mapInArrow(run, "key long, d1 long, d2 long, _doc long, _hash long, place long, many long")


def _hot_keys(candidates: DataFrame, kind: Kind) -> DataFrame | None:
    """Anchors with more different segments than one task should hold; None if there are none."""
    big = candidates.where("big")
    if big.isEmpty():
        return None
    hot = written(big.select("key", *DIGEST).distinct().groupBy("key").agg(F.count("*").alias("c")).where(F.col("c") > kind.hot).select("key"), "repeat-hot")
    return None if hot.isEmpty() else hot


def find_repeats(docs: DataFrame, kind: Kind, finder: Finder, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(_doc, _hash, text, spans)``: every row with the unit intervals covered by repeated windows (NULL: none)."""
    docs = keyed(docs, id_col, text_col)
    return docs.join(_covered(docs, kind, finder), KEY, "left")


def _covered(docs: DataFrame, kind: Kind, finder: Finder) -> DataFrame:
    """``(_doc, _hash, spans)`` of the rows of ``docs`` (``_doc, _hash, text``) with repeated windows."""
    found = written(_anchor_rows(docs, kind), "repeat-runs")
    often = found.groupBy("key").agg(F.sum("many").alias("c")).where("c > 1").select("key", (F.col("c") > kind.hot).alias("big"))
    candidates = written(found.join(often.hint("shuffle_merge"), "key").select("key", *DIGEST, *KEY, "place", "many", "big"), "repeat-candidates")
    hot = _hot_keys(candidates, kind)

    def holders(rows: DataFrame, texts: DataFrame) -> DataFrame:
        """The text of one holder per distinct segment, with the places to cut."""
        distinct = rows.groupBy("key", *DIGEST).agg(F.count("*").alias("n"), F.max("many").alias("many"), F.min(F.struct(*KEY, "place")).alias("one"))
        wanted = distinct.groupBy("one._doc", "one._hash").agg(F.collect_list(F.struct("key", *DIGEST, "n", "many", F.col("one.place").alias("place"))).alias("places"))
        return texts.join(wanted, KEY).select("text", "places")

    def pack(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.int64()] * 6 + [pa.binary()], strict=True)],
                                          names=["key", *DIGEST, "n", "many", "windows", "content"])

    def cut(batches):
        rows, size = [], 0
        for batch in batches:
            for text, places in zip(batch.column(0), batch.column(1), strict=True):
                units = kind.split(_raw(text.as_py()))
                for p in places.as_py():
                    start, n = p["place"] >> 16, p["place"] & 0xFFFF
                    rows.append((p["key"], p["d1"], p["d2"], p["n"], p["many"], n, kind.join(units[start:start + n - 1 + kind.length])))
                    size += len(rows[-1][-1]) + 100
                    if size > 8 << 20:
                        yield pack(rows)
                        rows, size = [], 0
        if rows:
            yield pack(rows)

    def search(batches):
        for shard in _shards(batches, kind.shard_bytes):
            out = [(s[0], *s[1], [{"a": a, "b": b} for a, b in spans]) for s, spans in _decided(shard, kind, finder) if spans]
            cols = list(zip(*out, strict=True)) if out else [()] * 4
            kinds = [pa.int64()] * 3 + [SPANS]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=["key", *DIGEST, "spans"])

    schema = "key long, d1 long, d2 long, n long, many long, windows long, content binary"
    cold = candidates if hot is None else candidates.join(hot, "key", "left_anti")
    repeated = holders(cold, docs).mapInArrow(cut, schema).repartition(partitions(docs), "key").sortWithinPartitions("key", *DIGEST) \
        .mapInArrow(search, "key long, d1 long, d2 long, spans array<struct<a:long,b:long>>")
    if hot is not None:
        # Hot anchors are few (each has over ``hot`` segments); written, so they are broadcast only by their size.
        warm = written(candidates.join(hot, "key"), "repeat-warm")
        segments = written(holders(warm, _holding(docs, warm)).mapInArrow(cut, schema), "repeat-segments")
        below = _covered(segments.select(F.col("d1").alias("_doc"), F.col("d2").alias("_hash"), F.col("content").alias("text")), kind.deeper(), finder)
        whole = F.array(F.struct(F.lit(0).cast("long").alias("a"), (F.col("windows") + kind.length - 1).alias("b")))
        mine = segments.drop("content", "many").join(below.select(F.col("_doc").alias("d1"), F.col("_hash").alias("d2"), "spans"), DIGEST, "left")
        repeated = repeated.unionByName(mine.select("key", *DIGEST, F.when(F.col("n") > 1, whole).otherwise(F.col("spans")).alias("spans")).where("spans IS NOT NULL"))
    start = F.shiftright("place", 16)
    return candidates.join(repeated, ["key", *DIGEST]).select(*KEY, F.explode("spans").alias("s"), start.alias("at")) \
        .groupBy(*KEY).agg(F.collect_set(F.struct((F.col("s.a") + F.col("at")).alias("a"), (F.col("s.b") + F.col("at")).alias("b"))).alias("spans"))


FILTER_BITS = 1 << 22


def _holding(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """The rows of ``docs`` that may be named by ``rows``, so that a join shuffles only their texts: a bit table by key
    of ``FILTER_BITS`` bits at most (65,536 rows, so it may be broadcast); a full table lets more through."""
    at = F.pmod(F.xxhash64(*KEY), F.lit(FILTER_BITS))
    bits = rows.select(at.alias("at")).groupBy(F.shiftright("at", 6).alias("slot")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(at % 64 AS INT))")).alias("word"))
    marked = docs.withColumn("at", at)
    return marked.join(F.broadcast(bits), F.shiftright(marked["at"], 6) == bits["slot"]) \
        .where(F.expr("shiftright(word, CAST(at % 64 AS INT)) & 1 = 1")).select(*docs.columns)


def _raw(text: str | bytes | None) -> bytes:
    return text.encode() if isinstance(text, str) else text or b""


def _decided(shard: list[tuple], kind: Kind, finder: Finder) -> Iterator[tuple[Segment, list[tuple[int, int]]]]:
    """A shard's segments with their spans.  One that is alone with its anchor, and holds it once, has no equal windows
    inside and none elsewhere: all of it is repeated or nothing; the others go to the index."""
    alone, rest = [], []
    for i, s in enumerate(shard):
        single = (i == 0 or shard[i - 1][0] != s[0]) and (i + 1 == len(shard) or shard[i + 1][0] != s[0])
        (alone if single and s[5] == 1 else rest).append(s)
    for s in alone:
        yield s, [(0, s[3] + kind.length - 1)] if s[2] > 1 else []
    if rest:
        yield from finder([s[:5] for s in rest])


def _shards(batches, bound: int) -> Iterator[list[tuple]]:
    """Whole keys, sorted, up to ``bound`` bytes of content (one key may be more, and is then alone): segments, each with its
    number of anchors behind."""
    shard: list[tuple] = []
    size = begin = before = 0  # of all segments; where the last key begins, and the bytes in front of it
    for batch in batches:
        for key, d1, d2, n, many, windows, content in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if not shard or key != shard[-1][0]:
                begin, before = len(shard), size
            elif shard[-1][1] == (d1, d2):
                continue
            shard.append((key, (d1, d2), n, windows, content, many))
            size += len(content)
            if size > bound and begin:
                yield shard[:begin]
                shard, size, begin, before = shard[begin:], size - before, 0, 0
    if shard:
        yield shard


def merged(spans) -> list[tuple[int, int]]:
    """Sorted, disjoint intervals that cover the same units; touching ones are joined."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def window_spans(starts: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Intervals covered by the windows at the sorted ``starts``."""
    if not len(starts):
        return []
    gap = np.flatnonzero(np.diff(starts) > length)
    return list(zip(starts[np.concatenate(([0], gap + 1))].tolist(), (starts[np.append(gap, len(starts) - 1)] + length).tolist(), strict=True))


def doubled_ranks(rank: np.ndarray, room: np.ndarray, depth: int, limit: int) -> np.ndarray:
    """Ranks of suffixes by prefix doubling.

    ``rank`` orders by the first ``depth`` symbols; ``room`` is the number of
    symbols up to the end of the suffix's own string, beyond which nothing
    follows (a shorter suffix sorts first, equal ones stay equal).  Ranks are
    the number of smaller suffixes; doubling ends at ``limit`` symbols.
    """
    order = np.argsort(rank, kind="stable")
    ordered = rank[order]
    start = np.concatenate(([True], ordered[1:] != ordered[:-1])) if len(order) else np.empty(0, bool)
    place = np.flatnonzero(start)[np.cumsum(start) - 1] if len(order) else order
    rank = np.empty(len(order), np.int64)
    rank[order] = place
    del order, ordered, start, place
    todo = np.flatnonzero(room > depth)
    n = len(rank) + 1
    while len(todo) and depth < limit:
        pair = rank[todo] * n + np.where(room[todo] > depth, rank[np.minimum(todo + depth, n - 2)] + 1, 0)
        order = np.argsort(pair, kind="stable")
        ordered, first = pair[order], rank[todo][order]
        fresh = np.concatenate(([True], ordered[1:] != ordered[:-1]))
        group = np.concatenate(([True], first[1:] != first[:-1]))
        del pair, ordered
        at = np.arange(len(order))
        new = np.maximum.accumulate(np.where(fresh, at, 0))
        new -= np.maximum.accumulate(np.where(group, at, 0))
        new += first
        del at, first, group
        # Members of a group that ended before this depth are equal to each other only and not in ``todo``.
        rank[todo[order]] = new
        depth *= 2
        alone = fresh & np.append(fresh[1:], True)
        keep = np.ones(len(todo), bool)
        keep[order[alone]] = False
        todo = todo[keep & (room[todo] > depth)]
    return rank
