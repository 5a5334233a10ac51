"""Event intake as Structured Streaming.

Messages land as JSON lines ``{"message_id", "publish_time", "data"}`` where
``data`` is the event payload as JSON text.  ``ingest_events`` reads the
landing folder as a file stream, parses the payload with the declared schema
(unknown fields ignored, missing ones NULL) and, per micro-batch, appends the
well-formed rows to bronze and the rest to a quarantine table.

Delivery is at-least-once upstream: duplicates are kept in bronze and removed
in silver (latest ``ingestao_ts`` wins).  ``ingestao_ts`` is the message's
publish time, so a replay after a failure gives the same order.  Each
micro-batch is one write, partitioned into good and bad rows, into a folder of
its own attempt, and one commit (:mod:`strata.streaming.commits`) that shows
both parts at once: a reader in between sees nothing of the batch, a batch that
is replayed after its commit changes nothing, one that died before it is
written anew.  The intake id belongs to the checkpoint, so a new checkpoint
appends beside what earlier ones wrote.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from strata.operators.clean import require
from strata.operators.reshape import melt_sparse
from strata.session import hadoop_path
from strata.schemas import (CORRUPT_COL, EVENT_METRICS, EVENT_PAYLOAD, EVENT_PAYLOAD_WITH_CORRUPT,
                            MESSAGE_ENVELOPE)
from strata.streaming import commits
from strata.streaming.gate import Gate

ENVELOPE_WITH_CORRUPT = T.StructType(MESSAGE_ENVELOPE.fields + [T.StructField(CORRUPT_COL, T.StringType())])
PAYLOAD_FIELDS = [f.name for f in EVENT_PAYLOAD.fields]

BRONZE_SCHEMA = T.StructType(EVENT_PAYLOAD.fields + [
    T.StructField("pubsub_message_id", T.StringType()),
    T.StructField("ingestao_ts", T.TimestampType()),
])
QUARANTINE_SCHEMA = T.StructType([
    T.StructField("pubsub_message_id", T.StringType()),
    T.StructField("ingestao_ts", T.TimestampType()),
    T.StructField("raw", T.StringType()),
])
#: A written batch: both parts, told apart by the folder ``bad=...``.
BATCH_SCHEMA = T.StructType([*BRONZE_SCHEMA.fields, T.StructField("raw", T.StringType()),
                             T.StructField("batch_id", T.LongType()), T.StructField("bad", T.StringType())])
FILES_PER_TRIGGER = 10_000
_JSON_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COL}


def read_landing(spark: SparkSession, landing_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = (spark.readStream.schema(ENVELOPE_WITH_CORRUPT)
              .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT_COL))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(landing_dir)


def read_kafka(spark: SparkSession, bootstrap_servers: str, topic: str,
               max_offsets_per_trigger: int | None = None) -> DataFrame:
    """Broker variant of ``read_landing``: Kafka records as envelope columns.

    Needs the spark-sql-kafka connector on the classpath (not bundled here, so
    not exercised by the tests).  The record's topic/partition/offset is the
    message id, its timestamp the publish time, its value the payload.
    """
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", bootstrap_servers).option("subscribe", topic))
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return reader.load().select(
        F.concat_ws(":", "topic", F.col("partition").cast("string"), F.col("offset").cast("string"))
        .alias("message_id"),
        F.col("timestamp").alias("publish_time"),
        F.col("value").cast("string").alias("data"),
        F.lit(None).cast("string").alias(CORRUPT_COL))


def parse_messages(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Envelope rows -> message id, ingest time, raw text, parsed payload ``p``
    and a ``bad`` flag (envelope or payload not readable with the schema);
    ``keep`` names columns that stay."""
    payload = F.from_json(F.col("data"), EVENT_PAYLOAD_WITH_CORRUPT, _JSON_OPTIONS)
    parsed = raw.select(
        F.col("message_id").alias("pubsub_message_id"),
        F.coalesce(F.col("publish_time"), F.current_timestamp()).alias("ingestao_ts"),
        F.coalesce(F.col("data"), F.col(CORRUPT_COL)).alias("raw"),
        F.col(CORRUPT_COL).alias("_envelope_corrupt"),
        payload.alias("p"), *keep)
    bad = (F.col("_envelope_corrupt").isNotNull() | F.col("p").isNull()
           | F.col(f"p.{CORRUPT_COL}").isNotNull())
    return parsed.withColumn("bad", bad)


def intake_id(spark: SparkSession, checkpoint_dir: str) -> str:
    """The id of a checkpoint: the name of a marker inside it, made on first use."""
    fs, folder = hadoop_path(spark, f"{checkpoint_dir}/intake")
    fs.mkdirs(folder)
    known = sorted(s.getPath().getName() for s in fs.listStatus(folder))
    if not known:
        known = [uuid.uuid4().hex[:12]]
        fs.createNewFile(hadoop_path(spark, f"{checkpoint_dir}/intake/{known[0]}")[1])
    return known[0]


def batch_rows(parsed: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Good and bad rows of a batch in one shape: fields of good rows, raw text of bad ones."""
    good = ~F.col("bad")
    return parsed.select(*[F.when(good, F.col(f"p.{c}")).alias(c) for c in PAYLOAD_FIELDS], "pubsub_message_id", "ingestao_ts",
                         F.when(~good, F.col("raw")).alias("raw"), F.col("bad").cast("string").alias("bad"), *keep)


def commit_batch(spark: SparkSession, parsed: DataFrame, bronze_dir: str, intake: str, batch_id: int, gate: Gate | None = None) -> bool:
    """Write one parsed batch and commit it (held, if a gate says so); False if it was committed before."""
    name = f"{intake}-{batch_id:010d}"
    if commits.has(spark, bronze_dir, name):
        return False
    folder = f"intake={intake}/batch_id={batch_id}/{commits.attempt()}"
    rows = batch_rows(parsed)
    seen = Observation()
    (rows.observe(seen, *gate.counts()) if gate else rows).write.partitionBy("bad").parquet(f"{bronze_dir}/{folder}")
    if gate is None:
        return commits.add(spark, bronze_dir, name, [("rows", folder)])
    verdict = {k: int(v or 0) for k, v in seen.get.items()}
    again = read_batches(spark, bronze_dir, [folder]).where("pubsub_message_id IS NOT NULL").groupBy("pubsub_message_id").agg(F.count(F.lit(1)).alias("n"))
    verdict["repeated"] = int(again.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n")).first()["n"])
    return commits.add(spark, bronze_dir, name, [("held" if gate.holds(verdict) else "rows", folder), ("verdict", json.dumps(verdict))])


def _point(spark: SparkSession, quarantine_dir: str, bronze_dir: str) -> None:
    """Let the quarantine folder name the bronze folder whose batches hold its rows."""
    fs, folder = hadoop_path(spark, quarantine_dir)
    fs.mkdirs(folder)
    if bronze_dir not in [v for _, v in commits.lines_of(spark, quarantine_dir)]:
        commits.add(spark, quarantine_dir, f"bronze-{uuid.uuid4().hex[:12]}", [("bronze", bronze_dir)])


def ingest_events(spark: SparkSession, landing_dir: str | None, bronze_dir: str, quarantine_dir: str,
                  checkpoint_dir: str, max_files_per_trigger: int | None = FILES_PER_TRIGGER,
                  available_now: bool = True, processing_time: str | None = None,
                  source: DataFrame | None = None, gate: Gate | None = None) -> StreamingQuery:
    """Start the intake; with ``available_now`` it stops when the landing folder
    is drained (bounded intake), otherwise it runs on ``processing_time``.
    ``source`` replaces the landing folder with another envelope stream
    (e.g. ``read_kafka``).  With a ``gate``, batches that fail it are held."""
    intake = intake_id(spark, checkpoint_dir)
    _point(spark, quarantine_dir, bronze_dir)
    raw = source if source is not None else read_landing(spark, landing_dir, max_files_per_trigger)
    parsed = parse_messages(raw)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        commit_batch(batch.sparkSession, batch, bronze_dir, intake, batch_id, gate)

    writer = parsed.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint_dir)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def run_bounded(query: StreamingQuery, timeout_s: float | None = None) -> bool:
    """Wait for a query; stop it after ``timeout_s`` seconds (bounded intake).

    Returns True when the query finished on its own (landing drained).  The
    bound is in time or, through ``maxFilesPerTrigger``, in files per batch;
    Spark sources do not stop at an exact message count.
    """
    finished = query.awaitTermination(timeout_s) if timeout_s is not None else query.awaitTermination()
    if not finished and query.isActive:
        query.stop()
    return bool(finished) or finished is None


def read_batches(spark: SparkSession, bronze_dir: str, folders: list[str] | None = None) -> DataFrame:
    """Committed batches of ``BATCH_SCHEMA``: all, or those in the given folders."""
    found = [v for k, v in commits.lines_of(spark, bronze_dir) if k == "rows"] if folders is None else folders
    return commits.read(spark, bronze_dir, found, BATCH_SCHEMA)


def read_bronze(spark: SparkSession, bronze_dir: str) -> DataFrame:
    return read_batches(spark, bronze_dir).where("bad = 'false'").select(*BRONZE_SCHEMA.fieldNames())


def read_quarantine(spark: SparkSession, quarantine_dir: str) -> DataFrame:
    """The bad rows of the committed batches of every bronze folder that this quarantine belongs to."""
    out = spark.createDataFrame([], QUARANTINE_SCHEMA)
    for _, bronze_dir in commits.lines_of(spark, quarantine_dir):
        out = out.unionByName(read_batches(spark, bronze_dir).where("bad = 'true'").select(*QUARANTINE_SCHEMA.fieldNames()))
    return out


def valid_deliveries(bronze: DataFrame) -> DataFrame:
    return require(bronze, not_null=["tipo", "timestamp", "sigla_uf", "pubsub_message_id"],
                   null_or_within={"taxa_alfabetizacao": (0, 100)})


def on_commits(spark: SparkSession, bronze_dir: str, checkpoint_dir: str, step, available_now: bool = True) -> StreamingQuery:
    """Follow the committed batches of a bronze folder: ``step(good rows, name of this batch)`` for every few new commits."""
    intake = intake_id(spark, checkpoint_dir)

    def run(batch: DataFrame, batch_id: int) -> None:
        folders = [v for k, v in commits.parse([r["value"] for r in batch.collect()]) if k == "rows"]  # a line per commit
        rows = read_batches(batch.sparkSession, bronze_dir, sorted(folders)).where("bad = 'false'").select(*BRONZE_SCHEMA.fieldNames())
        step(rows, f"{intake}-{batch_id:010d}")

    writer = commits.follow(spark, bronze_dir).writeStream.foreachBatch(run).option("checkpointLocation", checkpoint_dir)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def start_versions_stream(spark: SparkSession, bronze_dir: str, versions_dir: str, checkpoint_dir: str,
                          available_now: bool = True) -> StreamingQuery:
    """Append every valid delivery in bronze to a versions table, as a stream.

    Nothing is dropped by age: an event may arrive days late.  Which delivery
    of a message counts is decided on read, where all of them are known
    (``silver.streaming_eventos_clean`` keeps the latest; :func:`first_deliveries`
    the first).  Every batch is one commit.
    """
    def step(rows: DataFrame, name: str) -> None:
        if not commits.has(rows.sparkSession, versions_dir, name):
            folder = f"batch=b-{name}/{commits.attempt()}"
            valid_deliveries(rows).write.parquet(f"{versions_dir}/{folder}")
            commits.add(rows.sparkSession, versions_dir, name, [("rows", folder)])

    return on_commits(spark, bronze_dir, checkpoint_dir, step, available_now)


def read_versions(spark: SparkSession, versions_dir: str) -> DataFrame:
    return commits.read(spark, versions_dir, [v for _, v in commits.lines_of(spark, versions_dir)], BRONZE_SCHEMA)


def first_deliveries(versions: DataFrame) -> DataFrame:
    """The first delivery of each message, unpivoted like the silver event table."""
    order = Window.partitionBy("pubsub_message_id").orderBy(
        "ingestao_ts", *[c for c in BRONZE_SCHEMA.fieldNames() if c not in ("pubsub_message_id", "ingestao_ts")])
    first = versions.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")
    ids = ["tipo", "evento_ts", "ano", "sigla_uf", "serie", "rede", "source", "pubsub_message_id", "ingestao_ts"]
    return melt_sparse(first.withColumnRenamed("timestamp", "evento_ts"), ids, EVENT_METRICS)
