"""Exact bounded intake and redelivery: counts, restarts, lines on split borders, attempts and dead letters."""

import json
import os
import time

import pytest

from strata.streaming import bounded, commits, ingest, redelivery
from tests.test_commits import EVENT, ids, land, take_in
from tests.test_stream import _msg


def paths(root):
    return f"{root}/landing", f"{root}/bronze", f"{root}/bad", f"{root}/bounded"


def test_seven_of_files_of_five_then_the_eighth(spark, tmp_root):
    names = [f"m{i:02d}" for i in range(15)]
    for f in range(3):
        land(tmp_root, f"f{f}.json", names[5 * f:5 * f + 5], bad=("m03",))
        os.utime(f"{tmp_root}/landing/f{f}.json", (1_700_000_000 + f, 1_700_000_000 + f))
    assert bounded.take(spark, *paths(tmp_root), 7) == 7
    got = ids(ingest.read_bronze(spark, f"{tmp_root}/bronze")) + ids(ingest.read_quarantine(spark, f"{tmp_root}/bad"))
    assert sorted(got) == names[:7] and ids(ingest.read_quarantine(spark, f"{tmp_root}/bad")) == ["m03"]
    assert bounded.take(spark, *paths(tmp_root), 1) == 1  # a new call, as after a restart: the eighth
    assert ids(ingest.read_bronze(spark, f"{tmp_root}/bronze"))[-1] == "m07"
    assert bounded.take(spark, *paths(tmp_root), 100) == 7
    assert bounded.take(spark, *paths(tmp_root), 100) == 0
    assert ids(ingest.read_bronze(spark, f"{tmp_root}/bronze")) == [n for n in names if n != "m03"]
    # Another checkpoint is another subscription: it starts at the beginning.
    assert bounded.take(spark, *paths(tmp_root)[:3], f"{tmp_root}/other", 2) == 2


def test_a_call_that_dies_took_nothing(spark, tmp_root, monkeypatch):
    land(tmp_root, "a.json", ["1", "2", "3"])
    with monkeypatch.context() as m:
        m.setattr(commits, "add", lambda spark, root, name, lines: False)
        with pytest.raises(RuntimeError, match="another intake"):
            bounded.take(spark, *paths(tmp_root), 2)
    assert ids(ingest.read_bronze(spark, f"{tmp_root}/bronze")) == []
    assert bounded.take(spark, *paths(tmp_root), 2) == 2
    assert ids(ingest.read_bronze(spark, f"{tmp_root}/bronze")) == ["1", "2"]


def test_cuts_inside_a_file_of_many_splits(spark, tmp_root):
    names = [f"{i:05d}" for i in range(3000)]
    os.makedirs(f"{tmp_root}/landing")
    with open(f"{tmp_root}/landing/big.json", "w", encoding="utf-8") as fh:
        for n in names:
            fh.write(_msg(n, "2024-01-01T10:00:00+00:00", json.dumps(EVENT)) + "\n" + ("\n  \n" if n.endswith("7") else ""))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        taken = []
        for n in (1, 999, 1500, 5000):
            assert bounded.take(spark, *paths(tmp_root), n) == min(n, 3000 - len(taken))
            taken = ids(ingest.read_bronze(spark, f"{tmp_root}/bronze"))
            assert taken == names[:len(taken)]
        assert taken == names
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_small_counting_steps_and_time_bound(spark, tmp_root, monkeypatch):
    monkeypatch.setattr(bounded, "FIRST_STEP", 1)
    for f in range(6):
        land(tmp_root, f"f{f}.json", [f"{f}-{i}" for i in range(3)])
    t0 = time.monotonic()
    assert bounded.take_messages(spark, *paths(tmp_root), 16) == 16
    assert bounded.take_messages(spark, *paths(tmp_root), 16, timeout_s=1.5, poll_s=0.2) == 2
    assert time.monotonic() - t0 > 1.5
    assert len(ids(ingest.read_bronze(spark, f"{tmp_root}/bronze"))) == 18


def test_repaired_on_the_second_attempt_reaches_bronze_once(spark, tmp_root):
    land(tmp_root, "a.json", ["1", "2", "3"], bad=("2", "3"))
    land(tmp_root, "b.json", ["2"], minute=3, bad=("2",))  # the same bad message again
    with open(f"{tmp_root}/landing/c.json", "w", encoding="utf-8") as fh:
        fh.write("no envelope\n")
    take_in(spark, tmp_root)
    bronze = f"{tmp_root}/bronze"
    fixed = spark.createDataFrame([("2", json.dumps({**EVENT, "taxa_alfabetizacao": 55.0}))], "message_id string, data string")
    assert redelivery.redeliver(spark, bronze, fixed, max_attempts=3) == {"recovered": 1, "pending": 2}
    assert redelivery.redeliver(spark, bronze, fixed, max_attempts=3) == {"dead": 2}
    assert redelivery.redeliver(spark, bronze, fixed, max_attempts=3) == {}
    good = ingest.read_bronze(spark, bronze).where("pubsub_message_id = '2'").collect()
    assert [(r["taxa_alfabetizacao"], str(r["ingestao_ts"])) for r in good] == [(55.0, "2024-01-01 10:03:00")]
    known = {r["message"]: (r["attempts"], r["outcome"]) for r in redelivery.outcomes(spark, bronze).collect()}
    assert known["id:2"] == (2, "recovered") and known["id:3"] == (3, "dead") and len(known) == 3
    dead = redelivery.dead_letters(spark, bronze).collect()
    assert {r["raw"] for r in dead} == {"{", "no envelope"} and all(r["attempts"] == 3 for r in dead)
    # A bad delivery of a settled message starts nothing new.
    land(tmp_root, "d.json", ["2"], minute=9, bad=("2",))
    take_in(spark, tmp_root)
    assert redelivery.pending(spark, bronze).collect() == []


def test_a_round_that_dies_did_nothing(spark, tmp_root, monkeypatch):
    land(tmp_root, "a.json", ["1"], bad=("1",))
    take_in(spark, tmp_root)
    bronze = f"{tmp_root}/bronze"
    fixed = spark.createDataFrame([("1", json.dumps(EVENT))], "message_id string, data string")
    with monkeypatch.context() as m:
        m.setattr(commits, "add", lambda spark, root, name, lines: False)
        with pytest.raises(RuntimeError, match="another writer"):
            redelivery.redeliver(spark, bronze, fixed)
    assert ids(ingest.read_bronze(spark, bronze)) == [] and redelivery.pending(spark, bronze).count() == 1
    assert redelivery.redeliver(spark, bronze, fixed) == {"recovered": 1}
    assert ids(ingest.read_bronze(spark, bronze)) == ["1"]
