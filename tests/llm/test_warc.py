"""WARC round trips, and salvage of damaged archives: every undamaged record comes back, the rest is in gaps."""

import gzip
import hashlib
import random
import uuid

import pytest
from pyspark.sql import functions as F

from strata.llm import warc
from strata.llm.warc import Window, members, record_bytes, salvaged
from tests.conftest import SMOKE

LONG = "<p>" + "é text " * 300
SCHEMA = "page_id long, url string, html string, key string, payload string, uid long, path string, page long"


def pages():
    out = [(1, "http://a/é b\r\n", LONG), (2, None, LONG), (3, "u", LONG + "!"), (4, "u", "short"), (5, "u", "short"), (6, "u", None), (7, "u", ""),
           (None, "u", "N" * 1000), (None, "u", "N" * 1000), (8, "u", "N" * 999), (9, "u", "N" * 999), (10, "u", "N" * 1000), (11, "u", "R" * 2000), (11, "u", "R" * 2000),
           (12, "u", "WARC/1.1\r\nWARC-Type: response\r\n\r\n\x00\x1f" + "\r\n\r\n" * 500), (None, "u", "M" * 1500), (None, None, "M" * 1500)]
    return [(*r, "a", "b", 1, "c", 2) for r in out]


def want(rows):
    groups = {}
    for i, r in enumerate(rows):
        payload = (r[2] or "").encode()
        groups.setdefault(payload if len(payload) >= 1000 else (i,), []).append(r[0])
    out = []
    for key, ids in groups.items():
        payload = key if isinstance(key, bytes) else (rows[key[0]][2] or "").encode()
        first = max(ids, key=lambda i: (i is not None, i or 0))
        ids.remove(first)
        base = (len(payload), hashlib.sha1(payload).hexdigest())
        out += [(first, *base, "response", None)] + [(i, *base, "revisit", first) for i in ids]
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)


@pytest.mark.parametrize("compressed", [True, False])
def test_round_trip(spark, compressed):
    df = spark.createDataFrame(pages(), SCHEMA).repartition(3)
    rows = warc.archived(spark, df, compressed=compressed)
    assert rows.where("reason IS NOT NULL").count() == 0
    found = warc.pages_of(rows)
    assert got(found) == want(pages())
    texts = {r["page_id"]: bytes(r["payload"]).decode() for r in found.where("record_type = 'response' AND page_id IS NOT NULL").collect()}
    assert all(texts[r[0]] == (r[2] or "") for r in pages() if r[0] in texts)
    assert {r["refers_to"] for r in found.where("record_type = 'revisit'").collect()} == {2, 10, 11, None}
    assert found.where("record_type = 'revisit' AND payload IS NOT NULL").count() == 0


def test_smallest_data_and_empty(spark):
    table = spark.read.parquet(f"{SMOKE}/pages.parquet")
    rows = [(r["page_id"], None, r["html"]) for r in table.collect()]
    assert got(warc.pages_of(warc.archived(spark, table))) == want(rows)
    assert warc.pages_of(warc.archived(spark, table.limit(0))).collect() == []


def test_record_over_several_members(spark):
    rng = random.Random(1)
    big = "".join(rng.choice("abcdefgh") for _ in range(1 << 16)) * 300  # 19 MiB
    df = spark.createDataFrame([(1, "u", big), (2, "u", "x")], "page_id long, url string, html string").coalesce(1)
    assert got(warc.pages_of(warc.archived(spark, df))) == want([(1, "u", big), (2, "u", "x")])
    cut = record_bytes([("WARC-Type", "resource"), ("WARC-Record-ID", "<r>")], b"a" * (warc.MEMBER - 200) + b"WARC/1." * 60)
    found = list(salvaged(Window([members(cut)])))
    assert [(r[2], len(r[3])) for r in found] == [(None, 1)]


def records(n, seed):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        block = bytes(rng.randrange(256) for _ in range(rng.randrange(400)))
        if rng.random() < 0.3:
            block += b"\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\n" + block[:50]
        if rng.random() < 0.2:
            block += b"\x1f\x8b\x08" + block[:30]
        out.append(record_bytes([("WARC-Type", "resource"), ("WARC-Record-ID", f"<{i}>")], block))
    return out


def chunks(data, size):
    return [data[i:i + size] for i in range(0, len(data), size)]


@pytest.mark.parametrize("seed", range(30))
def test_salvage_finds_every_whole_record(seed):
    rng = random.Random(seed)
    parts = [members(r) if (seed % 3 == 0 or seed % 3 == 2 and rng.random() < 0.5) else r for r in records(25, seed)]
    data = bytearray(b"".join(parts))
    for _ in range(rng.randrange(1, 5)):
        at, n = rng.randrange(len(data)), rng.randrange(1, 60)
        if rng.random() < 0.7:
            data[at:at + n] = bytes(rng.randrange(256) for _ in range(len(data[at:at + n])))
        else:
            del data[at:at + n]  # everything behind moves
    found = list(salvaged(Window(chunks(bytes(data), rng.choice([7, 100, 1 << 20])))))
    read = {f["warc-record-id"]: (f, block) for *_, rs in found for f, block, reason in rs if not reason}
    blocks = {f"<{i}>": list(salvaged(Window([p])))[0][3][0][1] for i, p in enumerate(parts)}
    whole = {f"<{i}>" for i, p in enumerate(parts) if bytes(p) in bytes(data)}
    assert whole <= set(read)
    # A damaged header may still be one; the block is the one written wherever its digest field was left.
    for name, (fields, block) in read.items():
        assert name not in blocks or block == blocks[name] or "warc-block-digest" not in fields
    # Ranges cover the file, in order, without overlap.
    at = 0
    for lo, hi, _, _ in found:
        assert lo == at and hi > lo
        at = hi
    assert at == len(data)


def test_gaps_are_logged(spark):
    root = f"{spark.sparkContext.getCheckpointDir() or '/tmp'}/warc-{uuid.uuid4().hex}"
    good = records(6, 9)
    bad = bytearray(members(good[2]))
    bad[len(bad) // 2] ^= 0xFF
    files = {"a": b"".join(members(r) for r in good[:2]) + bytes(bad) + members(good[3]), "b": b"no archive at all", "c": b"".join(good)[:-3],
             "d": gzip.compress(b"".join(good)), "e": b""}
    spark.createDataFrame([(k, v) for k, v in files.items()], "k string, v binary").repartition(5, "k").select(
        F.col("v").cast("string").alias("value")).where("length(value) > 0").write.option("lineSep", "#").text(root)
    rows = warc.salvage(spark, root, chunk=64).collect()
    gaps = [(r["end"] - r["start"], r["reason"]) for r in rows if r["reason"]]
    assert len([r for r in rows if not r["reason"]]) == 3 + 5 + 6
    assert (len(bad), "damaged gzip member") in gaps or any(reason == "damaged gzip member" for _, reason in gaps)
    assert any("version line" in reason for _, reason in gaps) and any("cut off in the block" in reason for _, reason in gaps)
    assert sum(r["end"] - r["start"] for r in rows if r["reason"]) > 17
