"""Atomic micro-batches and the silver table by key: partial and replayed batches, buckets that are left alone."""

import json
import os
import uuid

import pytest
from pyspark.sql import functions as F

from strata.plans import silver
from strata.streaming import buckets as keyed
from strata.streaming import commits, ingest, silver_state
from tests.test_stream import _msg, _write

EVENT = {"tipo": "medicao_desempenho", "ano": 2023, "sigla_uf": "SP", "taxa_alfabetizacao": 80.5, "timestamp": "2024-01-01T10:00:00+00:00"}


def land(root, name, ids, minute=1, rate=80.5, bad=()):
    _write(f"{root}/landing", name, [_msg(i, f"2024-01-01T10:{minute:02d}:00+00:00", "{" if i in bad else json.dumps({**EVENT, "taxa_alfabetizacao": rate})) for i in ids])


def take_in(spark, root):
    ingest.ingest_events(spark, f"{root}/landing", f"{root}/bronze", f"{root}/bad", f"{root}/ckpt").awaitTermination()


def ids(df):
    return sorted(r["pubsub_message_id"] for r in df.collect())


def test_a_reader_sees_none_of_an_uncommitted_batch(spark, tmp_root, monkeypatch):
    land(tmp_root, "a.json", ["1", "2"], bad=("2",))
    take_in(spark, tmp_root)
    land(tmp_root, "b.json", ["3", "4"], bad=("4",))
    seen = []

    def dies(spark, root, name, lines):
        # The rows are written; between write and commit a reader looks, then the batch is killed.
        seen.append((ids(ingest.read_bronze(spark, f"{tmp_root}/bronze")), ids(ingest.read_quarantine(spark, f"{tmp_root}/bad"))))
        raise RuntimeError("killed before the commit")

    with monkeypatch.context() as m:
        m.setattr(commits, "add", lambda spark, root, name, lines: dies(spark, root, name, lines) if lines[0][0] == "rows" else True)
        with pytest.raises(Exception, match="killed before the commit"):
            take_in(spark, tmp_root)
    assert seen == [(["1"], ["2"])]
    take_in(spark, tmp_root)  # the same batch, written anew
    assert ids(ingest.read_bronze(spark, f"{tmp_root}/bronze")) == ["1", "3"]
    assert ids(ingest.read_quarantine(spark, f"{tmp_root}/bad")) == ["2", "4"]
    attempts = [d for d, _, files in os.walk(f"{tmp_root}/bronze") if "attempt=" in os.path.basename(d)]
    assert len(attempts) == 3 and len(commits.names(spark, f"{tmp_root}/bronze")) == 2


def test_a_batch_replayed_after_its_commit_changes_nothing(spark, tmp_root):
    parsed = ingest.parse_messages(spark.createDataFrame([("9", None, json.dumps(EVENT), None)], "message_id string, publish_time timestamp, data string, _corrupt_record string"))
    assert ingest.commit_batch(spark, parsed, f"{tmp_root}/bronze", "i", 0)
    assert not ingest.commit_batch(spark, parsed, f"{tmp_root}/bronze", "i", 0)
    assert ids(ingest.read_bronze(spark, f"{tmp_root}/bronze")) == ["9"]


def test_commit_names_are_taken_once(spark, tmp_root):
    root = f"{tmp_root}/log"
    assert commits.names(spark, root) == []
    assert commits.add(spark, root, "a", [("rows", "x y")]) and not commits.add(spark, root, "a", [("rows", "z")])
    assert commits.lines_of(spark, root) == [("rows", "x y")] and commits.names(spark, root) == ["a"]


def test_only_touched_buckets_are_written(spark, tmp_root):
    def merged():
        silver_state.start_silver_stream(spark, f"{tmp_root}/bronze", f"{tmp_root}/silver", f"{tmp_root}/sckpt", buckets=16).awaitTermination()
    many = [str(i) for i in range(200)]
    land(tmp_root, "a.json", many[:150])
    take_in(spark, tmp_root)
    merged()
    land(tmp_root, "b.json", many[100:], minute=2, rate=70.0)
    take_in(spark, tmp_root)
    merged()
    land(tmp_root, "c.json", ["7", "150"], minute=0, rate=60.0)  # older than what is stored, and newer than nothing
    land(tmp_root, "d.json", ["8"], minute=9, rate=50.0)
    take_in(spark, tmp_root)
    merged()
    merged()  # nothing new: no version
    versions = silver_state.written_by_version(spark, f"{tmp_root}/silver")
    touched = {r[0] for r in spark.createDataFrame([("7",), ("150",), ("8",)], "pubsub_message_id string").select(silver_state.bucket_of(16)).collect()}
    assert [v[1] for v in versions] == [16, 16, len(touched)] and len(touched) < 16
    bronze, latest = ingest.read_bronze(spark, f"{tmp_root}/bronze"), silver_state.read_latest(spark, f"{tmp_root}/silver")
    cols = ["pubsub_message_id", "metrica", "valor", "ingestao_ts"]
    want = sorted(map(tuple, silver.streaming_eventos_clean(bronze).select(cols).collect()))
    assert sorted(map(tuple, silver.melted_events(latest).select(cols).collect())) == want
    assert {r["pubsub_message_id"]: r["valor"] for r in silver.melted_events(latest).where("pubsub_message_id IN ('7', '8', '150')").collect()} == {
        "7": "80.5", "8": "50.0", "150": "70.0"}
    # Files of the last version lie in the touched buckets only.
    last = [d for d, _, files in os.walk(f"{tmp_root}/silver") if "version=v-0000000003" in d and "bucket=" in os.path.basename(d)]
    assert {int(os.path.basename(d).split("=")[1]) for d in last} == touched


def test_a_replayed_wave_and_an_empty_one(spark, tmp_root):
    root = f"{tmp_root}/silver-{uuid.uuid4().hex}"
    rows = spark.createDataFrame(
        [("t", None, 2023, "SP", None, None, None, 1.0, None, None, None, None, None, None, "1", None)], ingest.BRONZE_SCHEMA).withColumn("timestamp", F.current_timestamp())
    assert len(silver_state.merge_wave(spark, rows, root, "w1", buckets=4)) == 1
    assert silver_state.merge_wave(spark, rows, root, "w1") == []
    assert silver_state.merge_wave(spark, rows.limit(0), root, "w2") == []
    assert silver_state.read_latest(spark, root).count() == 1
    assert silver_state.merge_wave(spark, rows, root, "w3", buckets=99) and keyed.state(spark, root)[1]["buckets"] == "4"
