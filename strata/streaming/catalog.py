"""Registered stream queries.

Each one lands the event deliveries of the test data in two waves (first
deliveries, then redeliveries), runs the intake with ``availableNow`` after
each wave (the second run restarts from the checkpoint and only takes the new
files) and returns what the sink wrote, read back.  Everything goes to a fresh
folder under the session's checkpoint directory.  Event times are returned as
epoch microseconds, which do not depend on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.catalog import present
from strata.plans import silver
from strata.session import scratch_dir
from strata.sources import testviews as tv
from strata.streaming.bounded import take_messages
from strata.streaming.gate import Gate, verdicts
from strata.streaming.ingest import (first_deliveries, ingest_events, read_batches, read_bronze, read_quarantine,
                                     read_versions, start_versions_stream)
from strata.streaming.landing import envelopes, write_wave
from strata.streaming.redelivery import dead_letters, outcomes, redeliver
from strata.streaming.silver_state import read_latest, start_silver_stream


def _intake(spark: SparkSession, sf_dir: str, late: bool = False, versions: bool = False) -> dict[str, str]:
    """Land two waves and take each in: first deliveries, then redeliveries; ``late`` holds back the older half of the events for the second wave."""
    root = scratch_dir(spark, "events")
    paths = {k: f"{root}/{k}" for k in ("landing", "bronze", "quarantine", "checkpoint", "versions", "versions_checkpoint")}
    deliveries = tv.event_deliveries(spark, sf_dir)
    second = F.col("delivery") == 1
    if late:
        cutoff = deliveries.agg(F.min("timestamp") + (F.max("timestamp") - F.min("timestamp")) / 2).first()[0]
        second = second | (F.col("timestamp") < F.lit(cutoff).cast("timestamp_ntz"))
    for wave in (~second, second):
        write_wave(deliveries.where(wave), paths["landing"])
        ingest_events(spark, paths["landing"], paths["bronze"], paths["quarantine"],
                      paths["checkpoint"]).awaitTermination()
        if versions:
            start_versions_stream(spark, paths["bronze"], paths["versions"],
                                  paths["versions_checkpoint"]).awaitTermination()
    return paths


def _micros(df: DataFrame, ts: str, out: str) -> DataFrame:
    return df.withColumn(out, F.unix_micros(F.col(ts))).drop(ts)


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-1/3, SRC-6, SNK-4: bronze as landed by the stream (duplicates kept)."""
    bronze = read_bronze(spark, _intake(spark, sf_dir)["bronze"])
    out = _micros(_micros(bronze, "timestamp", "evento_us"), "ingestao_ts", "ingestao_us")
    return present(out)


def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-2, SCL-13/14: messages that do not fit the schema."""
    bad = read_quarantine(spark, _intake(spark, sf_dir)["quarantine"])
    return present(_micros(bad, "ingestao_ts", "ingestao_us"))


def stream_dedup_melt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-4: the batch silver event table over the streamed bronze."""
    bronze = read_bronze(spark, _intake(spark, sf_dir)["bronze"])
    return present(_micros(silver.streaming_eventos_clean(bronze), "evento_ts", "evento_us"))


def stream_silver_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-4/5: the first delivery of each message, from the streamed versions table."""
    paths = _intake(spark, sf_dir, versions=True)
    return present(_micros(first_deliveries(read_versions(spark, paths["versions"])), "evento_ts", "evento_us"))


def stream_late_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-4/5, SNK-4: new events that arrive long after younger ones are kept."""
    paths = _intake(spark, sf_dir, late=True, versions=True)
    latest = silver.streaming_eventos_clean(read_versions(spark, paths["versions"]))
    return present(_micros(latest, "evento_ts", "evento_us"))


def stream_two_intakes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-4, STR-1: a second checkpoint appends to bronze; nothing earlier is replaced."""
    root = scratch_dir(spark, "events")
    deliveries = tv.event_deliveries(spark, sf_dir)
    for wave in (0, 1):
        write_wave(deliveries.where(F.col("delivery") == wave), f"{root}/landing-{wave}")
        ingest_events(spark, f"{root}/landing-{wave}", f"{root}/bronze", f"{root}/quarantine",
                      f"{root}/checkpoint-{wave}").awaitTermination()
    return present(_micros(_micros(read_bronze(spark, f"{root}/bronze"), "timestamp", "evento_us"), "ingestao_ts", "ingestao_us"))


def stream_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRT-3: bounded intake, as many files per batch as a wave has landed."""
    root = scratch_dir(spark, "events")
    deliveries = tv.event_deliveries(spark, sf_dir)
    files = 8
    for wave in (0, 1):
        write_wave(deliveries.where(F.col("delivery") == wave).repartition(files), f"{root}/landing")
    ingest_events(spark, f"{root}/landing", f"{root}/bronze", f"{root}/quarantine", f"{root}/checkpoint",
                  max_files_per_trigger=files).awaitTermination()
    rows = read_batches(spark, f"{root}/bronze").where("bad = 'false'")
    return rows.groupBy(F.col("batch_id").cast("long").alias("batch_id")).agg(F.count("*").alias("n_rows"))


def _three_waves(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Bronze and the bucketed silver state after three waves: the older half, the rest, the redeliveries of few messages last."""
    root = scratch_dir(spark, "events")
    deliveries = tv.event_deliveries(spark, sf_dir)
    cutoff = deliveries.agg(F.min("timestamp") + (F.max("timestamp") - F.min("timestamp")) / 2).first()[0]
    again, old = F.col("delivery") == 1, F.col("timestamp") < F.lit(cutoff).cast("timestamp_ntz")
    for wave in (~again & old, ~again & ~old, again):
        write_wave(deliveries.where(wave), f"{root}/landing")
        ingest_events(spark, f"{root}/landing", f"{root}/bronze", f"{root}/quarantine", f"{root}/checkpoint").awaitTermination()
        start_silver_stream(spark, f"{root}/bronze", f"{root}/silver", f"{root}/silver_checkpoint", buckets=16).awaitTermination()
    return f"{root}/bronze", f"{root}/silver"


def stream_silver_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-4, WIN-2: the silver event table kept by key over three waves equals the recomputed one."""
    _, state = _three_waves(spark, sf_dir)
    return present(_micros(silver.melted_events(read_latest(spark, state)), "evento_ts", "evento_us"))


def _bounded(spark: SparkSession, sf_dir: str) -> tuple[str, list[int]]:
    """Bronze after three bounded intakes (7 messages, 1,000 and the rest) of both waves, and what each of them took."""
    root = scratch_dir(spark, "events")
    for wave in (0, 1):
        write_wave(tv.event_deliveries(spark, sf_dir).where(F.col("delivery") == wave), f"{root}/landing")
    took = [take_messages(spark, f"{root}/landing", f"{root}/bronze", f"{root}/quarantine", f"{root}/checkpoint", n) for n in (7, 1000, 1 << 40)]
    return f"{root}/bronze", took


def stream_exact_intake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-6, SRT-3: what each bounded intake reported, and the messages that its batch holds."""
    bronze, took = _bounded(spark, sf_dir)
    held = read_batches(spark, bronze).groupBy("batch_id").agg(F.count("*").alias("n_rows"))
    told = spark.createDataFrame(list(enumerate(took)), "batch_id long, n_reported long")
    return told.join(held, "batch_id", "left").select("batch_id", "n_reported", F.coalesce("n_rows", F.lit(0)).cast("long").alias("n_rows"))


def stream_exact_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-6, SRT-3: three bounded intakes take every message once."""
    bronze, _ = _bounded(spark, sf_dir)
    return present(_micros(_micros(read_bronze(spark, bronze), "timestamp", "evento_us"), "ingestao_ts", "ingestao_us"))


def stream_redelivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-2: quarantined messages after two redeliveries (even ids are repaired for the first, multiples of three for the second) with three attempts at most."""
    paths = _intake(spark, sf_dir)
    deliveries = tv.event_deliveries(spark, sf_dir).where("malformed").withColumn("malformed", F.lit(False))
    fixed = F.from_json("value", "message_id string, data string")
    repaired = envelopes(deliveries).select(fixed.alias("m")).select("m.*")
    for by in (2, 3):
        redeliver(spark, paths["bronze"], repaired.where(F.col("message_id").cast("long") % by == 0), max_attempts=3)
    rows = read_bronze(spark, paths["bronze"]).groupBy("pubsub_message_id").agg(F.count("*").alias("n"))
    out = outcomes(spark, paths["bronze"]).withColumn("pubsub_message_id", F.substring("message", 4, 100))
    dead = dead_letters(spark, paths["bronze"]).groupBy("message").agg(F.count("*").alias("n_dead"))
    return out.join(rows, "pubsub_message_id", "left").join(dead, "message", "left").select(
        "pubsub_message_id", "outcome", "attempts", F.coalesce("n", F.lit(0)).cast("long").alias("n_bronze"),
        F.coalesce("n_dead", F.lit(0)).cast("long").alias("n_dead"))


def _gated(spark: SparkSession, sf_dir: str) -> str:
    """Bronze after three gated batches: first deliveries, the same without their states (planted, bad), redeliveries."""
    root = scratch_dir(spark, "events")
    deliveries = tv.event_deliveries(spark, sf_dir)
    first = deliveries.where("delivery = 0")
    for wave in (first, first.withColumn("sigla_uf", F.lit(None).cast("string")), deliveries.where("delivery = 1")):
        write_wave(wave, f"{root}/landing")
        ingest_events(spark, f"{root}/landing", f"{root}/bronze", f"{root}/quarantine", f"{root}/checkpoint", gate=Gate()).awaitTermination()
    return f"{root}/bronze"


def stream_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ-3, DQ-8 on the stream: the verdict of every batch."""
    number = F.regexp_extract("commit", "-([0-9]+)$", 1).cast("long")
    return verdicts(spark, _gated(spark, sf_dir)).select(number.alias("batch_id"), "rows", "malformed", "nulls", "out_of_range", "repeated", "held")


def stream_gate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ-3, DQ-8 on the stream: bronze does not hold the batch that was held."""
    return present(_micros(_micros(read_bronze(spark, _gated(spark, sf_dir)), "timestamp", "evento_us"), "ingestao_ts", "ingestao_us"))


STREAM_QUERIES = {
    "stream_ingest": stream_ingest,
    "stream_quarantine": stream_quarantine,
    "stream_dedup_melt": stream_dedup_melt,
    "stream_silver_first_wins": stream_silver_first_wins,
    "stream_late_events": stream_late_events,
    "stream_two_intakes": stream_two_intakes,
    "stream_batches": stream_batches,
    "stream_silver_state": stream_silver_state,
    "stream_exact_intake": stream_exact_intake,
    "stream_exact_rows": stream_exact_rows,
    "stream_redelivery": stream_redelivery,
    "stream_gate": stream_gate,
    "stream_gate_rows": stream_gate_rows,
}
