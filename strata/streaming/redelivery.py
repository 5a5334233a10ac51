"""Redelivery of quarantined messages, with an attempt counter and a dead-letter bound.

The first delivery of a message is attempt 1.  Every round takes the messages
still in quarantine, puts the repaired payload of those that have one in place
of the raw text, and parses again: what fits goes to bronze once, what does not
is one attempt older, and at ``max_attempts`` it is a dead letter.  Rows,
attempts and dead letters of a round are one commit of the bronze folder, so a
round that dies did nothing.

A message is its id (without one, its raw text), so several bad deliveries of
it are one.  Recovered and dead messages are settled: later bad deliveries of
them start nothing new.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.schemas import CORRUPT_COL
from strata.streaming import commits
from strata.streaming.ingest import batch_rows, parse_messages, read_batches

MAX_ATTEMPTS = 5
ROUND = "redelivery-"
OUTCOMES = T.StructType([
    T.StructField("message", T.StringType()), T.StructField("round", T.LongType()), T.StructField("attempts", T.LongType()),
    T.StructField("outcome", T.StringType())])
DEAD = T.StructType([
    T.StructField("message", T.StringType()), T.StructField("pubsub_message_id", T.StringType()), T.StructField("ingestao_ts", T.TimestampType()),
    T.StructField("raw", T.StringType()), T.StructField("attempts", T.LongType())])


def message_key():
    return F.coalesce(F.concat(F.lit("id:"), F.col("pubsub_message_id")), F.concat(F.lit("raw:"), F.sha2(F.coalesce("raw", F.lit("")), 256)))


def _rounds(spark: SparkSession, bronze_dir: str) -> list[str]:
    return [n for n in commits.names(spark, bronze_dir) if n.startswith(ROUND)]


def outcomes(spark: SparkSession, bronze_dir: str) -> DataFrame:
    """``message, round, attempts, outcome`` (pending, recovered, dead) of every message that was ever redelivered, as of its last round."""
    folders = [v for k, v in commits.lines_of(spark, bronze_dir, _rounds(spark, bronze_dir)) if k == "attempts"]
    return commits.read(spark, bronze_dir, folders, OUTCOMES).groupBy("message").agg(
        F.max("round").alias("round"), F.max("attempts").alias("attempts"), F.max_by("outcome", "round").alias("outcome"))


def dead_letters(spark: SparkSession, bronze_dir: str) -> DataFrame:
    folders = [v for k, v in commits.lines_of(spark, bronze_dir, _rounds(spark, bronze_dir)) if k == "dead"]
    return commits.read(spark, bronze_dir, folders, DEAD)


def pending(spark: SparkSession, bronze_dir: str) -> DataFrame:
    """Quarantined messages that are not settled: the latest raw text of each, and how often it was delivered in vain."""
    bad = read_batches(spark, bronze_dir).where("bad = 'true'").withColumn("message", message_key())
    last = bad.groupBy("message").agg(F.max(F.struct("ingestao_ts", "raw", "pubsub_message_id")).alias("m")).select("message", "m.*")
    known = outcomes(spark, bronze_dir).select("message", "attempts", "outcome")
    return last.join(known, "message", "left").where("outcome IS NULL OR outcome = 'pending'").select(
        "message", "pubsub_message_id", "ingestao_ts", "raw", F.coalesce("attempts", F.lit(1)).cast("long").alias("attempts"))


def redeliver(spark: SparkSession, bronze_dir: str, repaired: DataFrame | None = None, max_attempts: int = MAX_ATTEMPTS) -> dict[str, int]:
    """One round over all pending messages; ``repaired`` has ``message_id, data``.  Returns how many had which outcome."""
    number = len(_rounds(spark, bronze_dir)) + 1
    waiting = pending(spark, bronze_dir)
    if repaired is not None:
        new = repaired.groupBy(F.col("message_id").alias("id")).agg(F.max("data").alias("data"))
        waiting = waiting.join(new, waiting["pubsub_message_id"] == new["id"], "left").drop("id")
    else:
        waiting = waiting.withColumn("data", F.lit(None).cast("string"))
    envelope = waiting.select(F.col("pubsub_message_id").alias("message_id"), F.col("ingestao_ts").alias("publish_time"),
                              F.coalesce("data", "raw").alias("data"), F.lit(None).cast("string").alias(CORRUPT_COL), "message", "attempts",
                              F.col("raw").alias("old"))
    # Written once: rows, attempts and dead letters must not disagree.
    attempt = commits.attempt()
    tried = f"redelivery=r-{number:010d}/{attempt}"
    parsed = parse_messages(envelope, keep=("message", "attempts", "old"))
    judged = batch_rows(parsed, keep=("message", "attempts", "old")).withColumn(
        "outcome", F.when(F.col("bad") == "false", "recovered").when(F.col("attempts") + 1 >= max_attempts, "dead").otherwise("pending"))
    judged.write.parquet(f"{bronze_dir}/redelivered/{tried}")
    rows = spark.read.schema(judged.schema).parquet(f"{bronze_dir}/redelivered/{tried}")
    after = rows.select("message", F.lit(number).cast("long").alias("round"), (F.col("attempts") + 1).alias("attempts"), "outcome")
    after.write.parquet(f"{bronze_dir}/attempts/{tried}")
    good = f"intake=redelivery/batch_id={number}/{attempt}"
    rows.where("outcome = 'recovered'").drop("message", "attempts", "old", "outcome").write.partitionBy("bad").parquet(f"{bronze_dir}/{good}")
    rows.where("outcome = 'dead'").select("message", "pubsub_message_id", "ingestao_ts", F.col("old").alias("raw"), (F.col("attempts") + 1).alias("attempts")) \
        .write.parquet(f"{bronze_dir}/dead/{tried}")
    if not commits.add(spark, bronze_dir, f"{ROUND}{number:010d}", [("rows", good), ("attempts", f"attempts/{tried}"), ("dead", f"dead/{tried}")]):
        raise RuntimeError(f"{bronze_dir}: round {number} was committed by another writer")
    return {r["outcome"]: r["n"] for r in after.groupBy("outcome").agg(F.count("*").alias("n")).collect()}
