"""WARC archives: a writer with revisit records, and a salvage reader.

Writer: one record per page, each a gzip member of its own (or plain).  Of
pages with equal payloads of at least ``min_bytes`` the one with the largest
id is a ``response``; the others are ``revisit`` records that refer to it and
hold only its HTTP header.  Spark's text sink writes the archives: a member's
last byte (the top byte of its length, zero below 16 MiB) or a plain record's
closing line ends are the sink's line separator.  A record of 16 MiB or more
is several members, which a gzip stream allows.

Reader: walks an archive record by record and checks each (member CRC and
length, version line, header fields, length, closing line ends, block digest).
After a failed check it searches on from the next byte for a gzip member or a
version line that passes, so every later record is recovered; what lies
between is one quarantined gap with its byte range and reason.  Spark lists
and reads the files (any store it can reach) and cuts them into chunks; a task
streams the chunks of a file and holds the record at hand.  A damaged length
can make it hold the rest of that file until the check fails.

Defined cases: a NULL page is an empty payload; a NULL url gives no target; a
NULL id is the smallest, and a page that refers to it has NULL ``refers_to``;
of repeated rows one is the response; an empty table gives no archive rows; a
file without any record is one gap; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import urllib.parse
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import written
from strata.session import checkpoint_root, hadoop_path

END = b"\r\n\r\n"
MEMBER = 1 << 24  # uncompressed bytes of a member stay below this
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest_label(raw: bytes) -> str:
    return "sha1:" + base64.b32encode(raw).decode()


def record_bytes(fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    """A whole record; fields without a value are left out."""
    fields = [*fields, ("WARC-Block-Digest", digest_label(hashlib.sha1(block).digest())), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None)
    return head.encode() + b"\r\n" + block + END


def members(record: bytes) -> bytes:
    """The record as gzip members, each of fewer than 16 MiB; none but the first begins like a record."""
    out, i = [], 0
    while i < len(record):
        j = i + MEMBER - 1
        j -= record[j:j + 7] == b"WARC/1."
        z = zlib.compressobj(6, zlib.DEFLATED, 31)
        out.append(z.compress(record[i:j]) + z.flush())
        i = j
    return b"".join(out)


def _urn(page, uid) -> str:
    return f"<urn:page:{'' if page is None else page}:{uid}>"


def _decided(pages: DataFrame, id_col: str, url_col: str, html_col: str, min_bytes: int) -> DataFrame:
    """Pages with their payload and, for those that are not the first of their kind, the page they refer to."""
    base = pages.select(F.col(id_col).cast("long").alias("page"), F.col(url_col).cast("string").alias("url"),
                        F.coalesce(F.col(html_col).cast("string").cast("binary"), F.lit(b"")).alias("payload"),
                        F.monotonically_increasing_id().alias("uid"))
    # Written, so that row numbers are the same wherever they are read.
    base = written(base.withColumn("key", F.when(F.octet_length("payload") >= min_bytes, F.substring(F.unhex(F.sha2("payload", 256)), 1, 16))), "warc-pages", compression="zstd")
    # Partial maxima: a payload that a third of the pages share is one row a task.  Written, so that the planner knows
    # its size and broadcasts it only below its byte threshold; else the join shuffles the payloads once.
    again = base.where("key IS NOT NULL").groupBy(F.col("key").alias("k")).agg(
        F.max(F.struct("page", "uid")).alias("w"), F.count("*").alias("n")).where("n > 1").select("k", F.col("w.page").alias("w_page"), F.col("w.uid").alias("w_uid"))
    again = written(again, "warc-first")
    revisit = F.col("w_uid").isNotNull() & (F.col("w_uid") != F.col("uid"))
    return base.join(again, F.col("key") == F.col("k"), "left").select(
        "page", "uid", "url", "payload", revisit.alias("revisit"), "w_page", "w_uid")


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   min_bytes: int = 1000, compressed: bool = True, date: str = "2020-01-01T00:00:00Z") -> None:
    """Write one record per page under ``path``; a file holds what one task writes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                out = []
                for page, uid, url, payload, revisit, w_page, w_uid in zip(*(c.to_pylist() for c in batch.slice(i, 64).columns), strict=True):
                    http = HTTP.format(len(payload)).encode()
                    whole = record_bytes([
                        ("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _urn(page, uid)), ("WARC-Date", date),
                        ("WARC-Target-URI", None if url is None else urllib.parse.quote(url, safe="%/:?#[]@!$&'()*+,;=~")),
                        ("WARC-Refers-To", _urn(w_page, w_uid) if revisit else None), ("WARC-Profile", PROFILE if revisit else None),
                        ("WARC-Payload-Digest", digest_label(hashlib.sha1(payload).digest())),
                        ("Content-Type", "application/http; msgtype=response")], http if revisit else http + payload)
                    out.append(members(whole)[:-1] if compressed else whole[:-len(END)])
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])

    records = _decided(pages, id_col, url_col, html_col, min_bytes).mapInArrow(run, "record binary")
    # The sink writes the bytes of the string as they are.
    records.select(F.col("record").cast("string").alias("value")).write.option("lineSep", "\x00" if compressed else END.decode()).text(path)


# --- reader ---------------------------------------------------------------------------------------------------------


class Window:
    """The bytes of a file that are at hand, from an iterator of chunks."""

    def __init__(self, chunks: Iterable[bytes]) -> None:
        self.chunks, self.base, self.data, self.ended = iter(chunks), 0, bytearray(), False

    def have(self, end: int) -> bool:
        while self.base + len(self.data) < end and not self.ended:
            chunk = next(self.chunks, None)
            if chunk is None:
                self.ended = True
            else:
                self.data += chunk
        return self.base + len(self.data) >= end

    def end(self) -> int:
        return self.base + len(self.data)

    def get(self, lo: int, hi: int) -> bytes:
        self.have(hi)
        return bytes(self.data[lo - self.base:hi - self.base])

    def find(self, needle: re.Pattern, at: int, longest: int, limit: int | None = None) -> int | None:
        """The first match at or after ``at`` (and before ``limit``); matches are at most ``longest`` bytes."""
        while True:
            found = needle.search(self.data, at - self.base)
            # A match at the end of what is at hand may start earlier once more is read; it cannot here, as patterns are fixed strings.
            if found:
                return found.start() + self.base if limit is None or found.start() + self.base < limit else None
            at = max(at, self.end() - longest + 1)
            if limit is not None and at >= limit or not self.have(self.end() + 1):
                return None

    def drop(self, to: int) -> None:
        del self.data[:to - self.base]
        self.base = to


START = re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r\n")
VERSION = re.compile(rb"WARC/1\.[01]\r\n")
HEAD_END = re.compile(rb"\r\n\r\n")
HEADER_LIMIT = 1 << 20


class Bad(Exception):
    """A failed check, with its reason."""


class Short(Bad):
    """The data ends before the record does."""


def _digest_ok(label: str, block: bytes) -> bool:
    kind, _, value = label.partition(":")
    if kind.lower() != "sha1":
        return True  # another algorithm: nothing to compare with
    raw = hashlib.sha1(block).digest()
    return value.upper() == base64.b32encode(raw).decode() or value.lower() == raw.hex()


def plain_record(w: Window, at: int) -> tuple[dict[str, str], bytes, int]:
    """The checked record at ``at``: headers, block and the offset behind it."""
    if w.get(at, at + 10) not in (b"WARC/1.0\r\n", b"WARC/1.1\r\n"):
        raise Short("cut off in the version line") if not w.have(at + 10) and b"WARC/1.1\r\n".startswith(w.get(at, at + 10)[:7]) else Bad("no version line")
    head = w.find(HEAD_END, at, len(END), at + HEADER_LIMIT)
    if head is None:
        raise Short("cut off in the header") if w.ended and w.end() < at + HEADER_LIMIT else Bad("header without an end")
    fields = {}
    for line in w.get(at + 10, head).split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            raise Bad("header line without a colon")
        fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    length = fields.get("content-length", "")
    if not length.isascii() or not length.isdigit() or not fields.get("warc-type") or not fields.get("warc-record-id"):
        raise Bad("missing header field")
    start, stop = head + len(END), head + len(END) + int(length)
    if not w.have(stop + len(END)):
        raise Short("cut off in the block")
    if w.get(stop, stop + len(END)) != END:
        raise Bad("no end of record where the length says")
    block = w.get(start, stop)
    if not _digest_ok(fields.get("warc-block-digest", ""), block):
        raise Bad("block digest differs")
    return fields, block, stop + len(END)


def _inflated(w: Window, at: int, step: int = 1 << 16) -> Iterator[tuple[bytes, int | None]]:
    """Pieces of the member at ``at``; the last comes with the offset behind the member."""
    z = zlib.decompressobj(31)
    while not z.eof:
        piece = w.get(at, at + step)
        if not piece:
            raise Bad("cut off in a gzip member")
        try:
            data = z.decompress(piece)
        except zlib.error:
            raise Bad("damaged gzip member") from None
        at += len(piece) - len(z.unused_data)
        yield data, at if z.eof else None


def member_records(w: Window, at: int) -> tuple[list[tuple], int]:
    """``(headers, block, None)`` per checked record of the member at ``at``, ``(None, None, reason)`` per gap inside it, and the offset behind.

    A record may go on in the members behind, which then do not begin like a record.
    """
    data, end, out = bytearray(), at, []
    while True:
        for piece, stop in _inflated(w, end):
            data += piece
            if not out and data and not b"WARC/1.".startswith(data[:7]):
                raise Bad("gzip member without a record")
            end = end if stop is None else stop
        inner, done, more = Window([bytes(data)]), 0, False
        while inner.have(done + 1) and not more:
            try:
                fields, block, done = plain_record(inner, done)
                out.append((fields, block, None))
            except Bad as bad:
                more = isinstance(bad, Short) and _goes_on(w, end)
                if not more:
                    out.append((None, None, str(bad)))
                    found = inner.find(VERSION, done + 1, 10)
                    done = inner.end() if found is None else found
        if not more:
            if all(reason for _, _, reason in out):
                raise Bad(out[0][2] if out else "empty gzip member")
            return out, end
        del data[:done]


def _goes_on(w: Window, at: int) -> bool:
    """Whether a member follows that does not begin like a record."""
    if w.get(at, at + 3) != b"\x1f\x8b\x08":
        return False
    try:
        head = zlib.decompressobj(31).decompress(w.get(at, at + 1024), 7)
    except zlib.error:
        return False
    return head[:7] != b"WARC/1."


def salvaged(w: Window) -> Iterator[tuple[int, int, str | None, list[tuple]]]:
    """``(start, end, reason, records)`` of one file: checked records (reason None) and, between them, gaps."""
    at, gap, why = 0, None, None
    while w.have(at + 1):
        try:
            if w.get(at, at + 3) == b"\x1f\x8b\x08":
                records, end = member_records(w, at)
            else:
                fields, block, end = plain_record(w, at)
                records = [(fields, block, None)]
        except Bad as bad:
            gap, why = (at, str(bad)) if gap is None else (gap, why)
            found = w.find(START, at + 1, 10)
            at = w.end() if found is None else found
            w.drop(at)
            continue
        if gap is not None:
            yield gap, at, why, []
            gap = None
        yield at, end, None, records
        at = end
        w.drop(at)
    if gap is not None:
        yield gap, at, why, []


FIELDS = "path string, start long, end long, reason string, headers map<string,string>, block binary, body int"


def salvage(spark: SparkSession, path: str, chunk: int = 4 << 20) -> DataFrame:
    """Records and gaps of all archives under ``path``: ``path, start, end, reason, headers, block, body``.

    A row with a ``reason`` is a quarantined gap (no headers, no block); the
    others are checked records.  Header names are lower case; ``body`` bytes of
    the block come before the payload (an HTTP header).
    """
    files = spark.read.format("binaryFile").load(path)
    chunks = files.select("path", "length", "content", F.expr(f"explode(sequence(0L, greatest(0L, length - 1) div {chunk}))").alias("i")).select(
        "path", F.expr(f"substring(content, CAST(i * {chunk} + 1 AS INT), {chunk})").alias("data"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((p.as_py(), d.as_py()) for batch in batches for p, d in zip(batch.column(0), batch.column(1), strict=True))
        held = next(rows, None)
        out, size = [], 0
        while held is not None:
            name, more = held[0], [held]

            def of_file(name=name, more=more):
                # The chunks of a file follow each other; the first of the next file ends it.
                while more[0] is not None and more[0][0] == name:
                    yield more[0][1]
                    more[0] = next(rows, None)

            for start, end, reason, records in salvaged(Window(of_file())):
                for fields, block, inside in records or [(None, None, None)]:
                    out.append((name, start, end, reason or inside, None if fields is None else list(fields.items()), block, _body(fields, block)))
                    size += 500 + len(block or b"")
                if size > 1 << 22:
                    yield _rows(out)
                    out, size = [], 0
            held = more[0]
        yield _rows(out)

    return chunks.mapInArrow(run, FIELDS)


def _body(fields: dict[str, str] | None, block: bytes | None) -> int | None:
    if fields is None:
        return None
    if not fields.get("content-type", "").lower().startswith("application/http"):
        return 0
    end = block.find(END)
    return len(block) if end < 0 else end + len(END)


_TYPES = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.map_(pa.string(), pa.string()), pa.binary(), pa.int32()]


def _rows(out: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*out, strict=True)) if out else [[]] * len(_TYPES)
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, _TYPES, strict=True)],
                                      names=["path", "start", "end", "reason", "headers", "block", "body"])


def _hex(base32: Column) -> Column:
    """The hex form of a base-32 SHA-1: every eight digits are ten hex digits."""
    digits = F.translate(base32, "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "0123456789abcdefghijklmnopqrstuv")
    return F.lower(F.concat(*(F.lpad(F.conv(F.substring(digits, at, 8), 32, 16), 10, "0") for at in (1, 9, 17, 25))))


def pages_of(records: DataFrame) -> DataFrame:
    """Pages from salvaged records: ``page_id, record_type, refers_to, url, payload, payload_bytes, payload_digest``.

    A response's payload is measured; a revisit has none, its digest and size
    are those its headers give for the full payload.
    """
    def page(field: str) -> Column:
        return F.nullif(F.regexp_extract(F.col("headers")[field], "^<urn:page:(-?[0-9]*):", 1), F.lit("")).cast("long")

    kind = F.col("headers")["warc-type"]
    again = kind == "revisit"
    payload = F.when(~again, F.expr("substring(block, body + 1)"))
    told = F.regexp_extract(F.decode(F.expr("substring(block, 1, body)"), "ISO-8859-1"), r"(?i)\r\nContent-Length: ([0-9]+)\r\n", 1)
    return records.where(F.col("reason").isNull() & kind.isin("response", "revisit")).select(
        page("warc-record-id").alias("page_id"), kind.alias("record_type"), page("warc-refers-to").alias("refers_to"),
        F.col("headers")["warc-target-uri"].alias("url"), payload.alias("payload"),
        F.when(again, F.nullif(told, F.lit("")).cast("long")).otherwise(F.octet_length(payload).cast("long")).alias("payload_bytes"),
        F.when(again, _hex(F.substring(F.col("headers")["warc-payload-digest"], 6, 32))).otherwise(F.sha1(payload)).alias("payload_digest"))


def archived(spark: SparkSession, pages: DataFrame, **options) -> DataFrame:
    """Write the pages to archives in the shared folder and return what the salvage reader finds there."""
    path = f"{checkpoint_root(spark)}/llm/warc-{uuid.uuid4().hex[:12]}"
    write_archives(pages, path, **options)
    fs, where = hadoop_path(spark, path)
    fs.deleteOnExit(where)
    return salvage(spark, path)
