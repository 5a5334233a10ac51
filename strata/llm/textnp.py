"""Vectorised text helpers for tasks: whole Arrow columns as byte arrays, words, rolling hashes, window minima."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


#: A random value per byte, by rule.
BYTE = mix(np.arange(1, 257, dtype=U) * U(0x9E3779B97F4A7C15))
BASE = 0x5851F42D4C957F2D  # odd, so it has an inverse modulo 2**64
INVERSE = pow(BASE, -1, 1 << 64)
SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True

_powers = [np.ones(1, U), np.ones(1, U)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n-1 of the base and of its inverse; kept between calls."""
    if len(_powers[0]) < n:
        m = 1 << (n - 1).bit_length()
        for i, b in enumerate((BASE, INVERSE)):
            steps = np.full(m, b, U)
            steps[0] = 1
            _powers[i] = np.cumprod(steps)
    return _powers[0][:n], _powers[1][:n]


def text_chunks(col: pa.Array, limit: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(row, row_end, bytes, offsets)`` of a text column in pieces of whole rows, about ``limit`` bytes each; NULL as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_binary()).fill_null(b"")
    n = len(col)
    if not n:
        return
    offs = np.frombuffer(col.buffers()[1], np.int64)[col.offset: col.offset + n + 1]
    buf = col.buffers()[2]
    data = np.frombuffer(buf, np.uint8) if buf is not None and buf.size else np.empty(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, "right")) - 1)
        yield i, j, data[offs[i]:offs[j]], offs[i:j + 1] - offs[i]
        i = j


def word_spans(data: np.ndarray, offs: np.ndarray, sep: np.ndarray = SPACE):
    """Start and end bytes of all words, and the first word of each row (length rows + 1)."""
    n = len(data)
    if not n:
        z = np.empty(0, np.int64)
        return z, z, np.zeros(len(offs), np.int64)
    inside = ~sep[data]
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    lo = offs[:-1][offs[:-1] < n]
    hi = offs[1:][offs[1:] > 0] - 1
    start[lo] = inside[lo]
    end[hi] = inside[hi]
    s, e = np.flatnonzero(start), np.flatnonzero(end) + 1
    return s, e, np.searchsorted(s, offs)


def span_hash(values: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Hash of ``values[s:e]`` for each span, from one prefix sum of a polynomial."""
    p, q = powers(len(values) + 1)
    c = np.zeros(len(values) + 1, U)
    np.cumsum(values * p[:-1], out=c[1:])
    return mix((c[e] - c[s]) * q[s] + (e - s).astype(U) * U(0x9E3779B97F4A7C15))


def gram_hash(values: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` values (:func:`span_hash` of all of them)."""
    n = len(values)
    if n < k:
        return np.empty(0, U)
    p, q = powers(n + 1)
    c = np.zeros(n + 1, U)
    np.cumsum(values * p[:-1], out=c[1:])
    out = c[k:] - c[:-k]
    out *= q[:n - k + 1]
    out += U(k * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    return mix(out)


def sliding(f, a: np.ndarray, w: int) -> np.ndarray:
    """``f`` (minimum or maximum) over each window of ``w`` values, by doubling."""
    span = 1
    while 2 * span <= w:
        a = f(a[:-span], a[span:])
        span *= 2
    return f(a[:span - w], a[w - span:]) if span < w else a


def sliding_min(a: np.ndarray, w: int) -> np.ndarray:
    return sliding(np.minimum, a, w)
