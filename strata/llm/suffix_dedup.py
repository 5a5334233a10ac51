"""Suffix-array dedup by prefix-free parsing.

The distributed search (:mod:`strata.llm.repeats`) brings the distinct
candidate segments of equal anchors into one shard.  There, trigger windows of
a rolling hash cut the segments into phrases that overlap by one trigger; the
phrases form a dictionary (each distinct phrase once, however often the copies
repeat it) and the segments a parse, the sequence of phrase ranks.  Suffix
arrays of dictionary and parse, both by prefix doubling, combine into corpus
order: because phrases end in a trigger, no phrase suffix longer than a
trigger is a prefix of another, so a position sorts by the rank of its phrase
suffix, then by the rank of the parse behind it.  Windows that are equal stand
next to each other in that order; neighbours are compared, runs of them byte
by byte, and windows with two occurrences in the corpus (a segment counts as
often as it occurs) are reported.

Defined cases: NULL and empty texts have no bytes; a document shorter than a
window keeps all bytes; a document repeated as a row loses every byte that a
window covers, in each copy; extra columns are ignored.  Removal may cut a
character: the remainder is bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import doc_id
from strata.llm.repeats import Kind, Segment, doubled_ranks, find_repeats, merged, window_spans
from strata.llm.textnp import BYTE, U, gram_hash, mix, powers

TRIGGER, MODULUS = 8, 32
END = 0xFF  # stands in no UTF-8 text


def eight_bytes(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as one number in byte order (zeros beyond the end)."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    out = np.zeros(len(data), U)
    for i in range(8):
        out <<= U(8)
        out |= padded[i:i + len(data)]
    return out


def cut_at_triggers(data: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of all phrases, and whether a phrase ends its text."""
    # A trigger may not reach over the end of a text, which itself ends a phrase.
    trigger = np.flatnonzero(gram_hash(BYTE[data], TRIGGER) % U(MODULUS) == 0)
    text_of = np.searchsorted(first, trigger, "right") - 1
    ok = (trigger + TRIGGER < last[text_of]) & (trigger > first[text_of])
    # Phrases begin at a text's first byte or at a trigger and end behind the next trigger or at the text's end.
    begin = np.sort(np.concatenate([first, trigger[ok]]))
    nxt = np.append(begin[1:], last[-1])
    ends_text = np.isin(nxt, np.append(first[1:], last[-1]))
    return begin, np.where(ends_text, nxt, nxt + TRIGGER), ends_text


def first_ranks(joined: np.ndarray, room: np.ndarray) -> np.ndarray:
    """Ranks of the suffixes of phrases by their first eight bytes; ``room`` is what is left of the phrase."""
    head = eight_bytes(joined)
    short = np.minimum(room, 8).astype(np.uint8)
    # Bytes behind the phrase are cut off; a shorter suffix sorts before those it begins.
    cut = (U(8) - short) * U(8)
    head = head >> cut << cut
    del cut
    order = np.lexsort((short, head))
    head, short = head[order], short[order]
    fresh = np.concatenate(([True], (head[1:] != head[:-1]) | (short[1:] != short[:-1])))
    del head, short
    start = np.empty(len(joined), np.int64)
    start[order] = np.cumsum(fresh)
    return start


class Parse:
    """Prefix-free parse of texts that end in ``END``: dictionary, parse, and the corpus order of any positions."""

    def __init__(self, data: np.ndarray, first: np.ndarray, last: np.ndarray):
        begin, stop, ends_text = cut_at_triggers(data, first, last)
        self.begin, self.ends_text = begin, ends_text
        raw = data.tobytes()
        ids: dict[bytes, int] = {}
        of = np.array([ids.setdefault(raw[a:b], len(ids)) for a, b in zip(begin.tolist(), stop.tolist(), strict=True)], np.int64)
        # Dictionary: distinct phrases one behind the other; ranks of all their suffixes.
        phrases = list(ids)
        size = np.array([len(p) for p in phrases], np.int64)
        self.entry = np.cumsum(size) - size
        joined = np.frombuffer(b"".join(phrases), np.uint8)
        room = np.repeat(self.entry + size, size) - np.arange(len(joined))
        self.suffix_rank = doubled_ranks(first_ranks(joined, room), room, 8, int(size.max()))
        del room
        # Parse: phrase ranks per text; ranks of its suffixes.
        phrase_rank = self.suffix_rank[self.entry]
        self.of = of
        text_end = np.flatnonzero(ends_text)
        behind = text_end[np.searchsorted(text_end, np.arange(len(of)))] + 1 - np.arange(len(of))
        self.parse_rank = doubled_ranks(phrase_rank[of], behind, 1, int(behind.max()))

    def order(self, at: np.ndarray) -> np.ndarray:
        """The positions ``at`` in corpus order."""
        j = np.searchsorted(self.begin, at, "right") - 1
        alpha = self.suffix_rank[self.entry[self.of[j]] + at - self.begin[j]]
        after = np.where(self.ends_text[j], 0, self.parse_rank[np.minimum(j + 1, len(self.of) - 1)] + 1)
        return np.argsort(alpha * (len(self.of) + 2) + after, kind="stable")


def pfp_finder(length: int):
    def find(shard: list[Segment]) -> Iterator[tuple[Segment, list[tuple[int, int]]]]:
        data = np.frombuffer(b"".join(s[4] + bytes([END]) for s in shard), np.uint8)
        size = np.array([len(s[4]) + 1 for s in shard], np.int64)
        last = np.cumsum(size)
        first = last - size
        windows = np.array([s[3] for s in shard], np.int64)
        owner = np.repeat(np.arange(len(shard)), windows)
        at = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows) + first[owner]
        repeated = repeated_windows(data, Parse(data, first, last), at, np.array([s[2] for s in shard], np.int64)[owner], length)
        bound = np.concatenate(([0], np.cumsum(windows)))
        local = at - first[owner]
        for i, s in enumerate(shard):
            here = slice(bound[i], bound[i + 1])
            yield s, window_spans(local[here][repeated[here]], length)
    return find


def windows_hash(data: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """Hash of the ``length`` bytes from each of the positions ``at`` on."""
    p, q = powers(len(data) + 1)
    c = np.zeros(len(data) + 1, U)
    np.cumsum(BYTE[data] * p[:-1], out=c[1:])
    return mix((c[at + length] - c[at]) * q[at])


def repeated_windows(data: np.ndarray, parse: Parse, at: np.ndarray, weight: np.ndarray, length: int) -> np.ndarray:
    """Whether the window at each position occurs twice: itself ``weight`` times or next to an equal one in corpus order."""
    order = parse.order(at)
    h = windows_hash(data, at, length)[order]
    same = h[1:] == h[:-1]
    del h
    # Equal hashes are proved by the bytes: neighbours whose successors are neighbours too are compared as one stretch.
    x, y = at[order][:-1][same], at[order][1:][same]
    where = np.argsort(x, kind="stable")
    x, y = x[where], y[where]
    joins = np.concatenate(([False], (np.diff(x) == 1) & (np.diff(y) == 1))) if len(x) else np.empty(0, bool)
    starts = np.flatnonzero(~joins)
    stops = np.append(starts[1:], len(x)) if len(x) else starts
    raw = data.tobytes()
    proved = np.ones(len(x), bool)
    for a, b in zip(starts.tolist(), stops.tolist(), strict=True):
        n = b - a - 1 + length
        if raw[x[a]:x[a] + n] != raw[y[a]:y[a] + n]:
            proved[a:b] = [raw[i:i + length] == raw[j:j + length] for i, j in zip(x[a:b], y[a:b], strict=True)]
    equal = np.zeros(len(same), bool)
    equal[np.flatnonzero(same)[where]] = proved
    out = weight >= 2
    out[order[:-1][equal]] = True
    out[order[1:][equal]] = True
    return out


def remove_repeats(docs: DataFrame, length: int = 400, gram: int = 64, id_col: str = "doc_id", text_col: str = "text",
                   hot: int = 1 << 11) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept)``: every document's bytes without those covered by repeated windows.

    Anchors with more than ``hot`` different segments are split by longer anchors before they come to a shard's arrays,
    which take about 100 bytes of memory for each of its bytes.
    """
    kind = Kind(words=False, length=length, gram=gram, shard_bytes=2 << 20, hot=hot)

    def drop(batches):
        for batch in batches:
            rows = []
            for doc, text, spans in zip(*(batch.column(i) for i in (0, 1, 2)), strict=True):
                raw = (text.as_py() or "").encode()
                cover = merged((s["a"], s["b"]) for s in spans.as_py() or ())
                kept, at = [], 0
                for a, b in cover:
                    kept.append(raw[at:a])
                    at = b
                kept = b"".join([*kept, raw[at:]])
                rows.append((doc.as_py(), len(raw), len(raw) - len(kept), len(cover), kept))
            cols = list(zip(*rows, strict=True)) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [pa.int64()] * 4 + [pa.binary()], strict=True)],
                                             names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    found = find_repeats(docs, kind, pfp_finder(length), id_col, text_col)
    return found.select(doc_id(), "text", "spans").mapInArrow(drop, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
