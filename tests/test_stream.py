"""Stream intake: schema handling, quarantine, restart from the checkpoint."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from strata.plans import silver
from strata.streaming.ingest import ingest_events, read_bronze, read_quarantine, run_bounded


def _write(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as fh:
        fh.write("\n".join(lines) + "\n")


def _msg(mid, publish, data):
    return json.dumps({"message_id": mid, "publish_time": publish, "data": data})


def test_intake_quarantine_and_restart(spark):
    root = tempfile.mkdtemp(prefix="strata-stream-")
    landing, bronze_dir, bad_dir, ckpt = (f"{root}/{k}" for k in ("landing", "bronze", "bad", "ckpt"))
    good = {"tipo": "medicao_desempenho", "timestamp": "2024-01-01T10:00:00.5+00:00", "ano": 2023,
            "sigla_uf": "SP", "taxa_alfabetizacao": 80.5, "campo_novo": 1}
    _write(landing, "a.json", [
        _msg("1", "2024-01-01T10:00:01+00:00", json.dumps(good)),
        _msg("2", "2024-01-01T10:00:02+00:00", json.dumps({**good, "ano": "x"})),
        _msg("3", "2024-01-01T10:00:03+00:00", '{"tipo": "a", "ano": '),
        "not json at all",
    ])
    assert run_bounded(ingest_events(spark, landing, bronze_dir, bad_dir, ckpt), timeout_s=120)
    b = read_bronze(spark, bronze_dir).collect()
    assert [(r.pubsub_message_id, r.ano, r.taxa_alfabetizacao, r.media_portugues) for r in b] == [
        ("1", 2023, 80.5, None)]
    assert b[0].timestamp is not None
    assert sorted(str(r.pubsub_message_id) for r in read_quarantine(spark, bad_dir).collect()) == [
        "2", "3", "None"]

    # Restart: nothing new -> nothing added; a redelivery -> appended to bronze.
    ingest_events(spark, landing, bronze_dir, bad_dir, ckpt).awaitTermination()
    assert read_bronze(spark, bronze_dir).count() == 1
    _write(landing, "b.json", [_msg("1", "2024-01-01T10:05:00+00:00", json.dumps({**good, "taxa_alfabetizacao": 81.0}))])
    ingest_events(spark, landing, bronze_dir, bad_dir, ckpt).awaitTermination()
    bronze = read_bronze(spark, bronze_dir)
    assert bronze.count() == 2
    # Silver keeps the latest delivery.
    s = silver.streaming_eventos_clean(bronze).where(F.col("metrica") == "taxa_alfabetizacao").collect()
    assert [(r.pubsub_message_id, r.valor) for r in s] == [("1", "81.0")]


def test_late_event_and_second_checkpoint_keep_every_message(spark):
    """A message far older than the newest one is kept, and a new checkpoint adds to what is there."""
    from strata.streaming.ingest import first_deliveries, read_versions, start_versions_stream
    root = tempfile.mkdtemp(prefix="strata-stream-")
    event = {"tipo": "medicao_desempenho", "ano": 2023, "sigla_uf": "SP", "taxa_alfabetizacao": 80.5}
    def land(folder, name, mid, day):
        ts = f"2024-01-{day:02d}T10:00:00+00:00"
        _write(f"{root}/{folder}", name, [_msg(mid, ts, json.dumps({**event, "timestamp": ts}))])
    def take_in(folder, ckpt):
        ingest_events(spark, f"{root}/{folder}", f"{root}/bronze", f"{root}/bad", f"{root}/{ckpt}").awaitTermination()
        start_versions_stream(spark, f"{root}/bronze", f"{root}/versions", f"{root}/vckpt").awaitTermination()
    land("l1", "a.json", "A", 20)
    take_in("l1", "c1")
    land("l1", "b.json", "B", 1)   # new, but 19 days older than A
    take_in("l1", "c1")
    land("l2", "c.json", "C", 2)   # another landing folder with its own checkpoint
    take_in("l2", "c2")
    assert sorted(r.pubsub_message_id for r in read_bronze(spark, f"{root}/bronze").collect()) == ["A", "B", "C"]
    versions = read_versions(spark, f"{root}/versions")
    for silver_rows in (silver.streaming_eventos_clean(versions), first_deliveries(versions)):
        assert sorted(r.pubsub_message_id for r in silver_rows.collect()) == ["A", "B", "C"]
