"""The stream's gate: a planted bad batch is held, the next good one passes, counts equal the quality rules."""

import json

from pyspark.sql import functions as F

from strata.plans import silver
from strata.plans.quality import evaluate, rules_for
from strata.streaming import ingest, silver_state
from strata.streaming.gate import Gate, release, verdicts
from tests.test_commits import EVENT, ids, land
from tests.test_stream import _msg, _write


def take_in(spark, root, gate=Gate()):
    ingest.ingest_events(spark, f"{root}/landing", f"{root}/bronze", f"{root}/bad", f"{root}/ckpt", gate=gate).awaitTermination()


def test_a_bad_batch_is_held_and_the_next_passes(spark, tmp_root):
    bronze = f"{tmp_root}/bronze"
    land(tmp_root, "a.json", ["1", "2", "3"], bad=("3",))
    take_in(spark, tmp_root)
    nameless = {k: v for k, v in EVENT.items() if k != "sigla_uf"}
    _write(f"{tmp_root}/landing", "b.json", [_msg(i, "2024-01-01T10:01:00+00:00", json.dumps(nameless)) for i in ("4", "5")] + [_msg("6", "2024-01-01T10:01:00+00:00", json.dumps(EVENT))])
    take_in(spark, tmp_root)
    land(tmp_root, "c.json", ["7", "7"], rate=180.0)
    land(tmp_root, "d.json", ["8", "9", "10"])
    take_in(spark, tmp_root)
    got = [(r["rows"], r["malformed"], r["nulls"], r["out_of_range"], r["repeated"], r["held"]) for r in verdicts(spark, bronze).orderBy("commit").collect()]
    assert got == [(3, 1, 0, 0, 0, False), (3, 0, 2, 0, 0, True), (5, 0, 0, 2, 1, False)]
    assert ids(ingest.read_bronze(spark, bronze)) == sorted(["1", "2", "7", "7", "8", "9", "10"])
    assert ids(ingest.read_quarantine(spark, f"{tmp_root}/bad")) == ["3"]
    # Followers of the bronze folder do not see the held batch either, until it is released.
    def follow():
        silver_state.start_silver_stream(spark, bronze, f"{tmp_root}/silver", f"{tmp_root}/sckpt", buckets=4).awaitTermination()
        return ids(silver_state.read_latest(spark, f"{tmp_root}/silver"))
    assert follow() == ["1", "10", "2", "8", "9"]
    held = verdicts(spark, bronze).where("held").first()["commit"]
    assert release(spark, bronze, held) and not release(spark, bronze, held)
    assert follow() == ["1", "10", "2", "6", "8", "9"]
    # The counts of the passing batches are those of the rule over the table they make.
    good = ingest.read_bronze(spark, bronze)
    rules = [r for r in rules_for("silver", True) if r.kind == "nulls" and r.table == "streaming_eventos_clean"]
    rule = evaluate(spark, {("silver", "streaming_eventos_clean"): silver.streaming_eventos_clean(good)}, rules).collect()[0]
    assert rule["violations"] == 0
    assert good.where(F.col("sigla_uf").isNull()).count() == 2 == verdicts(spark, bronze).agg(F.sum("nulls")).first()[0]


def test_empty_and_strict_gates(spark, tmp_root):
    land(tmp_root, "a.json", ["1", "1"])
    take_in(spark, tmp_root, Gate(repeated=0.0))
    assert [r["held"] for r in verdicts(spark, f"{tmp_root}/bronze").collect()] == [True]
    assert ids(ingest.read_bronze(spark, f"{tmp_root}/bronze")) == []
    assert verdicts(spark, f"{tmp_root}/nothing").collect() == []
    assert not Gate().holds({"rows": 0, "malformed": 0, "nulls": 0, "out_of_range": 0, "repeated": 0})
