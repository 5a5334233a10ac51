"""Secret scans: a recursive decoding worklist per document.

Every text is scanned for secrets; then its URL escapes, Unicode escapes and
compatibility characters, base64 tokens and compressed payloads are unwrapped
into new layers, each of which is scanned and unwrapped in turn until nothing
new appears.  A layer seen before (same content, same place) is not visited
again, so self-reproducing payloads end.  Each layer carries, per character,
the span of the original text it came from, so a secret found at any depth is
reported at its place in the document.

Documents are independent: one pass, no shuffle.  Layers are visited depth
first and made lazily.  A payload's data is one layer, all its members
together, so nothing inside it is cut; ``max_inflated`` bounds what a document
inflates to, and so the memory of its task.

Defined cases: NULL and empty texts have no spans; repeated rows give
repeated results; a NULL id stays NULL; extra columns are ignored; a document
whose payloads inflate to more than ``max_inflated`` bytes is scanned that
far and says so in ``n_oversize`` (the guard against decompression bombs);
rewritten layers are not charged to it, only escapes nested hundreds deep end
in a guard of their own, with the same mark.
"""

from __future__ import annotations

import base64
import binascii
import bz2
import codecs
import hashlib
import lzma
import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")

PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
#: What URL encoders leave bare (``encodeURI`` the most) and escapes.
STRETCH = re.compile(r"[A-Za-z0-9;,/?:@&=+$._~!*'()#%-]+")
BARE = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789;,/?:@&=+$._~!*'()#%-")
ONE_BYTE = re.compile(r"%[0-9A-Fa-f]{2}|.")
ESCAPE = re.compile(r"(?:\\u\{[0-9A-Fa-f]{1,6}\}|\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2}"
                    r"|&#[0-9]{1,7};|&#[xX][0-9A-Fa-f]{1,6};)+")
ONE_ESCAPE = re.compile(r"\\u\{[0-9A-Fa-f]+\}|\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2}|&#[0-9]+;|&#[xX][0-9A-Fa-f]+;")
#: Wrapped lines after the first are of any length.
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}(?:\r?\n[A-Za-z0-9+/_-]+)*={0,2}")
LINE = re.compile(r"[A-Za-z0-9+/_-]+={0,2}")
SEPARATOR = re.compile(r"[/_-]")
BETWEEN = re.compile(r"[A-Za-z0-9+]{16,}")
#: The least that may hold a secret or its wrapping: 12 characters that are, or become, printable ASCII.
TEXTY = re.compile(rb"[\t\n\r\x20-\x7e\xa0\xaa\xb2\xb3\xb9\xba]{12}")
#: Headers of compressed data; those of zlib are the pairs divisible by 31 without a preset dictionary.
ZLIB = {c: bytes(f for f in range(256) if (c << 8 | f) % 31 == 0 and not f & 32) for c in range(0x08, 0x80, 0x10)}
MAGIC = re.compile(b"|".join(re.escape(bytes([c])) + b"[" + re.escape(f) + b"]" for c, f in ZLIB.items())
                   + rb"|\x1f\x8b\x08|BZh[1-9](?:1AY&SY|\x17rE8P\x90)|\x28\xb5\x2f\xfd|\xfd7zXZ\x00|\x5d\x00\x00", re.S)
RAW = re.compile(MAGIC.pattern.decode("latin-1"), re.S)
LATIN = re.compile(r"[\x00-\xff]+")
URLSAFE = bytes.maketrans(b"-_", b"+/")
PIECE = 1 << 22
#: Layers as long as the document and all its inflated data, beyond which (and 2^28 characters) escapes of escapes end.
REWRITTEN = 256
#: The text of a document whose search was stopped: what was not searched does not go on.
UNSEARCHED = "[UNSEARCHED]"

Span = tuple[str, int, int]


def scan(text: str) -> list[Span]:
    """Secrets of one layer: leftmost, non-overlapping per kind."""
    out = []
    if "=" in text or ":" in text:
        out += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [("access", *m.span()) for m in ACCESS.finditer(text)]
    out += [("hex", *m.span()) for m in HEX.finditer(text)]
    return out


def ordered(spans) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def digest(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


class Layer:
    """A text and, per character, where it begins and ends in the document (``None``: it is the document)."""

    def __init__(self, text: str, start=None, end=None, guard: Guard | None = None):
        self.text, self.start, self.end, self.guard = text, start, end, guard

    def at_one_place(self) -> bool:
        """Inflated text stands whole at the place of its payload: one pair of numbers however long it is."""
        return self.start is not None and len(self.start) > 1 and self.start.strides == (0,) == self.end.strides

    def place(self, a: int, b: int) -> tuple[int, int]:
        return (a, b) if self.start is None else (int(self.start[a]), int(self.end[b - 1]))

    def arrays(self):
        n = np.arange(len(self.text) + 1)
        return (n[:-1], n[1:]) if self.start is None else (self.start, self.end)


def _rewritten(layer: Layer, parts: list[tuple[int, int, str, list[int] | None]]) -> Layer | None:
    """The layer with each ``[a, b)`` replaced; ``widths`` gives the source length of each new character (None: the whole span)."""
    if not parts:
        return None
    if layer.at_one_place():
        text, at = [], 0
        for a, b, new, _ in parts:
            text += [layer.text[at:a], new]
            at = b
        new = "".join([*text, layer.text[at:]])
        return Layer(new, np.broadcast_to(layer.start[0], len(new)), np.broadcast_to(layer.end[0], len(new)), layer.guard)
    s, e = layer.arrays()
    text, starts, ends, at = [], [], [], 0
    for a, b, new, widths in parts:
        text += [layer.text[at:a], new]
        starts.append(s[at:a])
        ends.append(e[at:a])
        if widths is None:
            starts.append(np.full(len(new), s[a]))
            ends.append(np.full(len(new), e[b - 1]))
        else:
            edge = a + np.concatenate(([0], np.cumsum(widths))).astype(np.int64)
            starts.append(s[edge[:-1]])
            ends.append(e[edge[1:] - 1])
        at = b
    text.append(layer.text[at:])
    starts.append(s[at:])
    ends.append(e[at:])
    return Layer("".join(text), np.concatenate(starts), np.concatenate(ends), layer.guard)


class Guard:
    """What the payloads of one document may still inflate to, in bytes, and whether that stopped one."""

    def __init__(self, left: int):
        self.left, self.stopped = left, False


def _kind(head: bytes) -> str:
    return "zstd" if head[:2] == b"\x28\xb5" else {0x42: "bzip", 0xfd: "lzma", 0x5d: "lzma"}.get(head[0], "deflate")


def _unit(kind: str):
    """A decompressor and how much input it gets at once (zstd has no bound on its output but its input)."""
    if kind == "zstd":
        import zstandard
        return zstandard.ZstdDecompressor().decompressobj(), 1 << 9
    return {"deflate": lambda: zlib.decompressobj(47), "bzip": bz2.BZ2Decompressor, "lzma": lzma.LZMADecompressor}[kind](), 1 << 16


def _inflate(blob: memoryview, guard: Guard) -> tuple[bytes, int]:
    """The data of the payload at the start of ``blob`` and the bytes it takes (0: it has no end); members of its kind that follow belong to it."""
    kind, out, at, used = _kind(bytes(blob[:2])), bytearray(), 0, 0
    while (m := MAGIC.match(blob, at)) and _kind(m[0]) == kind and not guard.stopped:
        unit, step = _unit(kind)
        fed, data = at, b""
        try:
            while not unit.eof:
                if not data and getattr(unit, "needs_input", True):
                    data = bytes(blob[fed:fed + step])
                    fed += len(data)
                x = unit.decompress(data) if kind == "zstd" else unit.decompress(data, max(1, min(PIECE, guard.left + 1)))
                if not x and not data:
                    return bytes(out), used
                data = getattr(unit, "unconsumed_tail", b"")
                out += x
                guard.left -= len(x)
                if guard.left < 0:
                    guard.stopped = True
                    return bytes(out), used
        except MemoryError:
            guard.stopped = True
            return bytes(out), used
        except Exception as e:  # noqa: BLE001  each library has its own error for bytes that are no payload
            if type(e).__name__ not in ("error", "OSError", "LZMAError", "EOFError", "ValueError", "ZstdError"):
                raise
            return bytes(out), used
        at = used = fed - len(unit.unused_data)
        while at < len(blob) and not blob[at]:
            at += 1
    return bytes(out), used


def _payloads(blob: bytes, guard: Guard) -> Iterator[tuple[int, int, bytes]]:
    """Compressed payloads wherever they begin in the bytes: ``(start, end, data)``; one without an end goes to the last byte."""
    at = 0
    while not guard.stopped and (m := MAGIC.search(blob, at)):
        data, used = _inflate(memoryview(blob)[m.start():], guard)
        at = m.start() + (used or 1)
        if data:
            yield m.start(), m.start() + used if used else len(blob), data


def _decoded(data: bytes) -> str:
    """Bytes that are no text still hold ASCII secrets or further payloads: Latin-1 keeps them one to one."""
    try:
        return codecs.getincrementaldecoder("utf-8")().decode(data)
    except UnicodeDecodeError:
        return data.decode("latin-1")


def _url_bytes(layer: Layer) -> Iterator[Layer]:
    """Percent-encoded payloads: ordinary encoders leave some bytes bare, so a whole stretch is decoded as bytes."""
    end = 0
    for m in PERCENT.finditer(layer.text):
        if m.start() < end:
            continue
        a = m.start()
        while a > end and layer.text[a - 1] in BARE:
            a -= 1
        end = STRETCH.match(layer.text, a).end()
        units = ONE_BYTE.findall(layer.text, a, end)
        edge = a + np.concatenate(([0], np.cumsum([len(u) for u in units])))
        blob = bytes(ord(u) if len(u) == 1 else int(u[1:], 16) for u in units)
        # Form encoders write a blank as a plus.
        blank = bytes(0x20 if u == "+" else b for u, b in zip(units, blob, strict=True))
        for x in dict.fromkeys((blob, blank)):
            yield from _inflated(layer, x, lambda i, edge=edge: int(edge[i]))


def _url(layer: Layer) -> Iterator[Layer]:
    yield from _url_bytes(layer)
    parts = []
    for m in PERCENT.finditer(layer.text):
        raw = bytes.fromhex(m[0].replace("%", ""))
        try:
            new = raw.decode()
        except UnicodeDecodeError:
            # Decode the valid characters, keep the escapes of other bytes.
            new, widths = "", []
            for i, c in enumerate(raw.decode(errors="surrogateescape")):
                kept = c if not 0xDC80 <= ord(c) <= 0xDCFF else f"%{ord(c) - 0xDC00:02x}"
                new += kept
                widths += [3 * len(c.encode(errors="surrogateescape"))] if len(kept) == 1 else [1, 1, 1]
            if all(w == 1 for w in widths):
                continue
        else:
            widths = [3 * len(c.encode()) for c in new]
        parts.append((m.start(), m.end(), new, widths))
    if out := _rewritten(layer, parts):
        yield out


def _code(x: str) -> int:
    if x[0] == "&":
        return int(x[3:-1], 16) if x[2] in "xX" else int(x[2:-1])
    return int(x[2:].strip("{}"), 16)


def _unicode(layer: Layer) -> Iterator[Layer]:
    parts = []
    for m in ESCAPE.finditer(layer.text):
        codes, widths = [], []
        for x in ONE_ESCAPE.findall(m[0]):
            c = _code(x)
            if codes and 0xD800 <= codes[-1] < 0xDC00 <= c < 0xE000:
                codes[-1] = 0x10000 + (codes[-1] - 0xD800 << 10) + c - 0xDC00
                widths[-1] += len(x)
            else:
                codes.append(c if c < 0x110000 else 0xFFFD)
                widths.append(len(x))
        new = "".join("\ufffd" if 0xD800 <= c < 0xE000 else chr(c) for c in codes)
        parts.append((m.start(), m.end(), new, widths))
    if out := _rewritten(layer, parts):
        yield out
    if not layer.text.isascii() and not unicodedata.is_normalized("NFKC", layer.text):
        odd = [(i, i + 1, n, None) for i, c in enumerate(layer.text)
               if c > "\x7f" and (n := unicodedata.normalize("NFKC", c)) != c and n.isascii()]
        if out := _rewritten(layer, odd):
            yield out


def _inflated(layer: Layer, blob: bytes, where) -> Iterator[Layer]:
    """Layers of the payloads in ``blob``, whose byte ``i`` begins at ``where(i)`` in the layer."""
    for a, b, data in _payloads(blob, layer.guard):
        text = _decoded(data)
        s, e = layer.place(where(a), where(b))
        yield Layer(text, np.broadcast_to(s, len(text)), np.broadcast_to(e, len(text)), layer.guard)


def _blocks(layer: Layer, a: int, b: int) -> Iterator[list[tuple[int, int]]]:
    """The line spans of base64 texts in a wrapped stretch: all its lines, lines of one length with the shorter last one, each long line."""
    lines = [m.span() for m in LINE.finditer(layer.text, a, b)]
    yield lines
    if len(lines) == 1:
        return
    yield from ([x] for x in lines if x[1] - x[0] >= 16)
    i = 0
    while i < len(lines):
        width, j = lines[i][1] - lines[i][0], i + 1
        while j < len(lines) and lines[j][1] - lines[j][0] == width:
            j += 1
        if j < len(lines) and lines[j][1] - lines[j][0] < width:
            yield lines[i:j + 1]
        if j - i > 1:
            yield lines[i:j]
        i = j


def _base64(layer: Layer) -> Iterator[Layer]:
    """Base64 texts, also behind other characters of the alphabet (a path, a name): a token is decoded from its first four
    characters on, so from every alignment, and in the parts between ``/``, ``_`` and ``-``."""
    for wrapped in BASE64.finditer(layer.text):
        for lines in _blocks(layer, *wrapped.span()):
            if sum(b - a for a, b in lines) < 16:
                continue
            yield from _base64_body(layer, "".join(layer.text[a:b] for a, b in lines).rstrip("=").replace("=", ""), lines)
        a, b = wrapped.span()
        if SEPARATOR.search(layer.text, a, b):
            for part in BETWEEN.finditer(layer.text, a, b):
                if part.start() > a or part.end() < b:
                    yield from _base64_body(layer, part[0], [part.span()], 1)


def _base64_body(layer: Layer, body: str, lines: list[tuple[int, int]], alignments: int = 4) -> Iterator[Layer]:
    """Layers of a base64 text that stands in ``lines`` of the layer; further alignments only where the first is no clean text."""
    where = None
    coded = body.encode().translate(URLSAFE)
    for skip in range(alignments):
        part = coded[skip:]
        if len(part) % 4 == 1:
            part = part[:-1]
        if len(part) < 16 and skip:
            return
        try:
            raw = base64.b64decode(part + b"=" * (-len(part) % 4))
        except binascii.Error:
            continue
        clean = False
        for text, width in _texts(raw):
            clean |= width is not None or raw.isascii()
            if layer.at_one_place():
                yield Layer(text, np.broadcast_to(layer.start[0], len(text)), np.broadcast_to(layer.end[0], len(text)), layer.guard)
                continue
            if where is None:
                where = np.concatenate([np.arange(a, b) for a, b in lines])
                where = where[:len(body)] if "=" not in layer.text[lines[0][0]:lines[-1][1]] else np.array([i for i in where if layer.text[i] != "="], np.int64)[:len(body)]
            edge = np.arange(len(text) + 1) if width is None else np.concatenate(([0], np.cumsum([width(c) for c in text]))).astype(np.int64)
            s, e = layer.arrays()
            yield Layer(text, s[where[skip + edge[:-1] * 4 // 3]], e[where[skip + np.minimum((edge[1:] * 4 + 2) // 3, len(part)) - 1]], layer.guard)
        if clean:
            return


def _texts(raw: bytes):
    """Layers of decoded bytes with the byte width of a character (None: one): text, and bytes that are no text one to one if they can hold anything."""
    text, width = _as_text(raw)
    if text is not None:
        yield text, width
    if (text is None and TEXTY.search(raw)) or (not raw.isascii() and MAGIC.search(raw)):
        yield raw.decode("latin-1"), None


def _as_text(raw: bytes):
    """Text of decoded bytes with the byte width of a character, if they look like text."""
    for name, width in (("utf-8", lambda c: len(c.encode())), ("utf-16-le", lambda c: 4 if c > "\uffff" else 2)):
        if name == "utf-16-le" and raw[1::2].count(0) * 2 < len(raw) // 2:
            continue
        try:
            text = raw.decode(name)
        except UnicodeDecodeError:
            continue
        odd = sum(c < " " and c not in "\t\n\r\x0b\x0c" for c in text)
        if odd * 10 <= len(text):
            return text, None if raw.isascii() and name == "utf-8" else width
    return None, None


def _raw(layer: Layer) -> Iterator[Layer]:
    """Payloads whose bytes stand in the text as characters up to U+00FF."""
    if RAW.search(layer.text):
        for m in LATIN.finditer(layer.text):
            yield from _inflated(layer, m[0].encode("latin-1"), lambda i, a=m.start(): a + i)


def children(layer: Layer) -> Iterator[Layer]:
    if "%" in layer.text:
        yield from _url(layer)
    if "\\" in layer.text or "&#" in layer.text or not layer.text.isascii():
        yield from _unicode(layer)
    yield from _base64(layer)
    yield from _raw(layer)


def find_secrets(text: str | None, max_inflated: int = 1 << 28) -> tuple[list[Span], list[Span], bool]:
    """Base spans, all spans, and whether the inflation guard stopped the search."""
    text = text or ""
    base = ordered(scan(text))
    spans, seen, guard = set(base), set(), Guard(max_inflated)
    spent = 0
    root = Layer(text, guard=guard)
    seen.add(_mark(root))
    work = [children(root)]
    while work:
        layer = next(work[-1], None)
        if layer is None:
            work.pop()
            continue
        if not layer.text or (mark := _mark(layer)) in seen:
            continue
        seen.add(mark)
        spent += len(layer.text)
        if spent > REWRITTEN * (len(text) + max_inflated - guard.left) + (1 << 28):
            return base, ordered(spans), True
        spans.update((k, *layer.place(a, b)) for k, a, b in scan(layer.text))
        work.append(children(layer))
    return base, ordered(spans), guard.stopped


def _mark(layer: Layer):
    at = (0, len(layer.text)) if layer.start is None or not layer.text else (int(layer.start[0]), int(layer.end[-1]))
    return hashlib.blake2b(layer.text.encode(errors="surrogatepass"), digest_size=16).digest(), at


def masked(text: str | None, spans: list[Span]) -> str | None:
    """The text with every (merged) span replaced by ``[SECRET]``; NULL stays NULL."""
    if text is None or not spans:
        return text
    out, at = [], 0
    for _, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], "[SECRET]"]
        elif b > at and not out:
            out.append("[SECRET]")
        at = max(at, b)
    return "".join(out + [text[at:]])


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 with_text: bool = False, max_inflated: int = 1 << 28) -> DataFrame:
    """One row per document: the span counts and spans, and on request the masked text.

    Columns: id, ``n_assign``, ``n_access``, ``n_hex`` (of the text itself),
    ``base_spans``, ``spans`` (``kind:start:end`` in code points, end
    exclusive), ``n_oversize``, and ``masked``.
    """
    schema = (f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, n_assign long, n_access long, n_hex long, "
              "base_spans string, spans string, n_oversize long" + (", masked string" if with_text else ""))

    def run(batches):
        for batch in batches:
            rows = []
            for text in batch.column(1):
                text = text.as_py()
                base, spans, over = find_secrets(text, max_inflated)
                n = [sum(s[0] == k for s in base) for k in KINDS]
                rows.append((*n, digest(base), digest(spans), int(over), masked(text, spans) if with_text else None))
            cols = list(zip(*rows, strict=True)) if rows else [()] * 7
            kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64(), pa.string()]
            arrays = [pa.array(c, t) for c, t in zip(cols, kinds, strict=True)][:6 + with_text]
            names = [id_col, "n_assign", "n_access", "n_hex", "base_spans", "spans", "n_oversize", "masked"]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=names[:7 + with_text])

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)


def mask_secrets(docs: DataFrame, text_col: str = "text", max_inflated: int = 1 << 28) -> DataFrame:
    """The rows of ``docs`` with the secrets in ``text_col`` replaced by ``[SECRET]``, all other columns unchanged.

    A text whose search the guard stopped may hold more: it is replaced whole by ``UNSEARCHED``.
    """
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            texts = []
            for t in batch.column(at).to_pylist():
                _, spans, over = find_secrets(t, max_inflated)
                texts.append(UNSEARCHED if over else masked(t, spans))
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    return docs.mapInArrow(run, docs.schema)
