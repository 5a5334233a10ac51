"""Substring dedup: a compressed FM-index per shard.

The distributed search (:mod:`strata.llm.repeats`) brings the distinct
candidate segments of equal anchors into one shard.  A shard's index is the
Burrows-Wheeler transform of its segments as a wavelet matrix of packed bits
with block counts.  Every segment is then streamed against the index: backward
search extends a match word by word to the left and keeps the interval of its
occurrences, weighted by how often each segment occurs in the corpus; where a
match can no longer be extended, its right end is drawn in just as far as
needed (found by bisection) and the search goes on.  These are the matching
statistics, and the stretches matched ``length`` words or more with two
occurrences are reported.

Defined cases: NULL, empty and blank texts have no words; a document shorter
than a window keeps all words; a document repeated as a row loses every word
that a window covers, in each copy; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import doc_id
from strata.llm.repeats import Kind, Segment, doubled_ranks, find_repeats, merged

U = np.uint64


class Wavelet:
    """Wavelet matrix: rank of a symbol in a prefix, one packed bit vector per level."""

    def __init__(self, symbols: np.ndarray, top: int):
        self.levels = max(1, int(top).bit_length())
        self.n = len(symbols)
        self.bits, self.counts, self.zeros = [], [], []
        cur = symbols.astype(np.int64)
        for level in range(self.levels - 1, -1, -1):
            bit = (cur >> level & 1).astype(bool)
            packed = np.packbits(bit, bitorder="little")
            packed = np.append(packed, np.zeros(16 - len(packed) % 8, np.uint8)).view(U)
            self.bits.append(packed)
            self.counts.append(np.concatenate(([0], np.cumsum(np.bitwise_count(packed), dtype=np.int32))).astype(np.int32))
            self.zeros.append(int(len(bit) - bit.sum()))
            cur = np.concatenate([cur[~bit], cur[bit]])

    def walk(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where position ``at`` of the root lies in the leaf order of ``symbol``."""
        for i in range(self.levels):
            bit = symbol >> (self.levels - 1 - i) & 1
            word = at >> 6
            ones = self.counts[i][word] + np.bitwise_count(self.bits[i][word] & ((U(1) << (at & 63).astype(U)) - U(1)))
            at = np.where(bit == 1, self.zeros[i] + ones, at - ones)
        return at


class FMIndex:
    """Backward search over the words of many short texts; word 0 ends a text."""

    def __init__(self, text: np.ndarray, room: np.ndarray, weight: np.ndarray, depth: int):
        rank = doubled_ranks(text, room, 1, depth)
        order = np.argsort(rank, kind="stable")
        top = int(text.max())
        self.wavelet = Wavelet(text[order - 1], top)
        self.start = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=top + 1)))).astype(np.int64)
        every = np.arange(top + 1)
        self.origin = self.wavelet.walk(every, np.zeros(top + 1, np.int64))
        self.weights = np.concatenate(([0], np.cumsum(weight[order])))

    def extend(self, word: np.ndarray, lo: np.ndarray, hi: np.ndarray):
        both = self.wavelet.walk(np.concatenate([word, word]), np.concatenate([lo, hi]))
        base = self.start[word] - self.origin[word]
        return both[:len(word)] + base, both[len(word):] + base

    def occurrences(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        return self.weights[hi] - self.weights[lo]


def fm_finder(length: int):
    def find(shard: list[Segment]) -> Iterator[tuple[Segment, list[tuple[int, int]]]]:
        ids: dict[bytes, int] = {}
        texts = [s[4].split(b" ") for s in shard]
        size = np.array([len(t) for t in texts], np.int64)
        first = np.cumsum(size + 1) - size - 1
        text = np.zeros(int((size + 1).sum()), np.int64)
        for a, t in zip(first.tolist(), texts, strict=True):
            text[a:a + len(t)] = [ids.setdefault(w, len(ids) + 1) for w in t]
        owner = np.repeat(np.arange(len(shard)), size + 1)
        room = (first + size + 1)[owner] - np.arange(len(text))
        weight = np.array([s[2] for s in shard], np.int64)[owner]
        index = FMIndex(text, room, weight, int(size.max()) + 1)
        spans = matches(index, text, first, size, length)
        for i, s in enumerate(shard):
            yield s, merged(spans.get(i, ()))
    return find


def matches(index: FMIndex, text: np.ndarray, first: np.ndarray, size: np.ndarray, length: int) -> dict[int, list[tuple[int, int]]]:
    """Per text the maximal stretches of ``length`` words or more that occur twice, all texts in lockstep.

    State of a text: ``end`` of the match, ``at`` its first word, the interval
    of its occurrences.  When word ``at - 1`` cannot be put before it, ``good``
    and ``bad`` bracket the largest end at which it can; a probe searches from
    an end in between back to that word.
    """
    out: dict[int, list[tuple[int, int]]] = {}
    n = int(index.start[-1])
    live = np.flatnonzero(size >= length)
    end = size.copy()
    at = end.copy()
    lo, hi = np.zeros(len(size), np.int64), np.full(len(size), n)
    goal = np.full(len(size), -1)  # the word a probe must reach; -1: no probe
    good, bad = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)

    def report(who):
        for g in who[end[who] - at[who] >= length].tolist():
            out.setdefault(g, []).append((int(at[g]), int(end[g])))

    def restart(who, ends):
        end[who] = ends
        at[who] = ends
        lo[who], hi[who] = 0, n

    while len(live):
        # Probes that reached their word: the end is good. Done at once if no larger end can be.
        reached = live[(goal[live] >= 0) & (at[live] == goal[live])]
        if len(reached):
            good[reached] = end[reached]
            settled = reached[bad[reached] - good[reached] <= 1]
            goal[settled] = -1
            more = reached[bad[reached] - good[reached] > 1]
            restart(more, (good[more] + bad[more] + 1) // 2)
        done = (goal[live] < 0) & (at[live] == 0)
        report(live[done])
        live = live[~done]
        # A match that ends before any window can is no use.
        live = live[(goal[live] >= 0) | (end[live] >= length)]
        if not len(live):
            break
        l, h = index.extend(text[first[live] + at[live] - 1], lo[live], hi[live])
        ok = (h > l) & (index.occurrences(np.minimum(l, h), h) >= 2)
        go = live[ok]
        lo[go], hi[go] = l[ok], h[ok]
        at[go] -= 1
        fail = live[~ok]
        if len(fail):
            scan = fail[goal[fail] < 0]
            report(scan)
            # Windows left of here start at or before word ``i`` and end by ``i + length``.
            i = at[scan] - 1
            goal[scan] = i
            good[scan] = i
            bad[scan] = np.minimum(end[scan], i + length + 1)
            probe = fail[~np.isin(fail, scan)] if len(scan) else fail
            bad[probe] = end[probe]
            # The first probe takes the largest end allowed, later ones bisect.
            top = np.where(end[scan] > i + length, i + length, (good[scan] + bad[scan]) // 2)
            restart(scan, np.maximum(top, good[scan]))
            restart(probe, (good[probe] + bad[probe]) // 2)
            both = np.concatenate([scan, probe])
            # Only the empty match is left: the word occurs nowhere else, go on to its left.
            empty = both[(bad[both] - good[both] <= 1) & (good[both] == goal[both])]
            restart(empty, goal[empty])
            goal[empty] = -1
            # The good end is known: search from it once more, then go on.
            known = both[(bad[both] - good[both] <= 1) & (good[both] > goal[both]) & (goal[both] >= 0)]
            restart(known, good[known])
    return out


def remove_repeats(docs: DataFrame, length: int = 35, gram: int = 12, id_col: str = "doc_id", text_col: str = "text",
                   hot: int = 1 << 16) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept)``: every document without the words covered by repeated windows, joined by one space.

    Anchors with more than ``hot`` different segments are split by longer anchors before they come to a shard's index.
    """
    kind = Kind(words=True, length=length, gram=gram, shard_bytes=6 << 20, hot=hot)

    def drop(batches):
        for batch in batches:
            rows = []
            for doc, text, spans in zip(*(batch.column(i) for i in (0, 1, 2)), strict=True):
                words = (text.as_py() or "").encode().split()
                cover = merged((s["a"], s["b"]) for s in spans.as_py() or ())
                kept, at = [], 0
                for a, b in cover:
                    kept += words[at:a]
                    at = b
                kept += words[at:]
                rows.append((doc.as_py(), len(words), len(words) - len(kept), b" ".join(kept).decode()))
            cols = list(zip(*rows, strict=True)) if rows else [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [pa.int64()] * 3 + [pa.string()], strict=True)],
                                             names=["doc_id", "n_words", "n_removed", "kept"])

    found = find_repeats(docs, kind, fm_finder(length), id_col, text_col)
    return found.select(doc_id(), "text", "spans").mapInArrow(drop, "doc_id long, n_words long, n_removed long, kept string")
