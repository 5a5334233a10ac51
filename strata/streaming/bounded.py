"""Bounded intake: exactly N messages, or what came within T seconds.

Spark's file source takes whole files, so this intake keeps message offsets of
its own: for every landed file the number of its messages that were taken.
One call lists the landing folder (paths, times and sizes only), counts the
messages of as many open files as N needs, takes whole files in order of
arrival and cuts the last one at a message.  Rows and offsets are one commit of
the bronze folder (:mod:`strata.streaming.commits`), so a call that dies took
nothing, and the next one goes on behind the last commit.

The driver holds one row per file it takes from, and a file it counts has a
message, so these are at most N (plus the last, larger step of files).
Numbers within a file are only worked out for files that are taken in part: by
input split, from the splits' counts and the order inside a split.

Landed files are not changed after they are there.  Blank lines are no
messages.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.streaming import commits
from strata.streaming.ingest import (_JSON_OPTIONS, ENVELOPE_WITH_CORRUPT, _point, batch_rows, intake_id, parse_messages)

PROGRESS = T.StructType([T.StructField("path", T.StringType()), T.StructField("taken", T.LongType()), T.StructField("messages", T.LongType())])
FIRST_STEP = 64 << 20  # bytes of open files that are counted first; later steps double


@dataclass(frozen=True)
class Piece:
    """Messages ``start`` (from 0) up to ``stop`` of a file that has ``messages``."""

    path: str
    start: int
    stop: int
    messages: int


def _mine(spark: SparkSession, bronze_dir: str, intake: str) -> list[str]:
    return [n for n in commits.names(spark, bronze_dir) if n.startswith(f"{intake}-")]


def progress(spark: SparkSession, bronze_dir: str, intake: str) -> DataFrame:
    """How many messages of each file were taken."""
    folders = [v for k, v in commits.lines_of(spark, bronze_dir, _mine(spark, bronze_dir, intake)) if k == "progress"]
    return commits.read(spark, bronze_dir, folders, PROGRESS).groupBy("path").agg(F.max("taken").alias("taken"), F.max("messages").alias("messages"))


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    lines = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"))
    return lines.where(F.length(F.btrim("value", F.lit(" \t\r"))) > 0)


def _planned(spark: SparkSession, landing_dir: str, done: DataFrame, n: int) -> list[Piece]:
    """The pieces of files that hold the next ``n`` messages, in order of arrival."""
    listed = spark.read.format("binaryFile").load(landing_dir).select("path", "modificationTime", "length").where("length > 0")
    open_ = listed.join(done, "path", "left").where("messages IS NULL OR taken < messages")
    order = Window.orderBy("modificationTime", "path")
    pieces, left, at, step = [], n, None, FIRST_STEP
    while left > 0:
        # Files behind the last one counted, up to a step of bytes (one file at least).
        ahead = open_ if at is None else open_.where(
            (F.col("modificationTime") > F.lit(at[0])) | ((F.col("modificationTime") == F.lit(at[0])) & (F.col("path") > F.lit(at[1]))))
        sized = ahead.orderBy("modificationTime", "path").limit(max(1, min(left, 10_000))).withColumn("before", F.sum("length").over(order) - F.col("length"))
        files = sized.where(F.col("before") < step).orderBy("modificationTime", "path").collect()
        if not files:
            break
        counts = {r["path"]: r["n"] for r in _lines(spark, [f["path"] for f in files]).groupBy("path").agg(F.count("*").alias("n")).collect()}
        for f in files:
            start, messages = f["taken"] or 0, counts.get(f["path"], 0)
            stop = min(messages, start + left)
            if left and (stop > start or not messages):
                pieces.append(Piece(f["path"], start, stop, messages))
                left -= stop - start
        at, step = (files[-1]["modificationTime"], files[-1]["path"]), 2 * step
    return pieces


def _messages(spark: SparkSession, pieces: list[Piece]) -> DataFrame:
    """The envelopes of the pieces, with the columns of ``read_landing``."""
    whole = [p.path for p in pieces if (p.start, p.stop) == (0, p.messages) and p.messages]
    parts = [p for p in pieces if 0 < p.stop - p.start < p.messages]
    out = _lines(spark, whole).select("value") if whole else spark.createDataFrame([], "value string")
    if parts:
        lines = _lines(spark, [p.path for p in parts]).withColumn("at", F.monotonically_increasing_id())
        counts = lines.groupBy("path", "block").agg(F.count("*").alias("n"))
        before = counts.withColumn("before", F.sum("n").over(Window.partitionBy("path").orderBy("block")) - F.col("n")).drop("n")
        numbered = lines.withColumn("nth", F.row_number().over(Window.partitionBy("path", "block").orderBy("at")) - 1).join(before, ["path", "block"])
        ranges = spark.createDataFrame([(p.path, p.start, p.stop) for p in parts], "path string, start long, stop long")
        number = F.col("before") + F.col("nth")
        out = out.unionByName(numbered.join(ranges, "path").where((number >= F.col("start")) & (number < F.col("stop"))).select("value"))
    e = F.from_json("value", ENVELOPE_WITH_CORRUPT, _JSON_OPTIONS)
    return out.select(e.alias("e")).select("e.*")


def take(spark: SparkSession, landing_dir: str, bronze_dir: str, quarantine_dir: str, checkpoint_dir: str, n: int) -> int:
    """Take the next ``n`` messages that have landed, or all if there are fewer; how many were taken."""
    intake = intake_id(spark, checkpoint_dir)
    _point(spark, quarantine_dir, bronze_dir)
    batch = len(_mine(spark, bronze_dir, intake))
    pieces = _planned(spark, landing_dir, progress(spark, bronze_dir, intake), n)
    if not pieces:
        return 0
    folder = f"intake={intake}/batch_id={batch}/{commits.attempt()}"
    batch_rows(parse_messages(_messages(spark, pieces))).write.partitionBy("bad").parquet(f"{bronze_dir}/{folder}")
    moved = spark.createDataFrame([(p.path, p.stop, p.messages) for p in pieces], PROGRESS)
    moved.coalesce(1).write.parquet(f"{bronze_dir}/progress/{folder}")
    if not commits.add(spark, bronze_dir, f"{intake}-{batch:010d}", [("rows", folder), ("progress", f"progress/{folder}")]):
        raise RuntimeError(f"{checkpoint_dir}: another intake took batch {batch}")
    return sum(p.stop - p.start for p in pieces)


def take_messages(spark: SparkSession, landing_dir: str, bronze_dir: str, quarantine_dir: str, checkpoint_dir: str,
                  max_messages: int, timeout_s: float = 0.0, poll_s: float = 1.0) -> int:
    """Take messages until there are ``max_messages`` or ``timeout_s`` seconds passed; how many were taken."""
    began, taken = time.monotonic(), 0
    while True:
        taken += take(spark, landing_dir, bronze_dir, quarantine_dir, checkpoint_dir, max_messages - taken)
        left = timeout_s - (time.monotonic() - began)
        if taken >= max_messages or left <= 0:
            return taken
        time.sleep(min(poll_s, left))
