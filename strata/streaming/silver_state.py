"""The silver event table kept up to date by key: the latest valid delivery per message, in buckets.

A wave of new deliveries is merged with the stored rows of the buckets that its
messages fall in (:mod:`strata.streaming.buckets`); only these are written anew.
Keeping the latest is idempotent, and a replayed wave changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from strata.operators.clean import keep_latest
from strata.streaming import buckets as keyed
from strata.streaming.ingest import BRONZE_SCHEMA, on_commits, valid_deliveries

BUCKETS = keyed.BUCKETS
KEY = "pubsub_message_id"
written_by_version = keyed.written_by_version


def bucket_of(buckets: int) -> Column:
    return keyed.bucket_of([KEY], buckets)


def merge_wave(spark: SparkSession, deliveries: DataFrame, silver_dir: str, wave: str, buckets: int = BUCKETS, files: int = 1) -> list[int]:
    """Merge the valid ones of some deliveries; the buckets that were written anew."""
    def latest(old: DataFrame, new: DataFrame) -> DataFrame:
        return keep_latest(old.unionByName(new), ["bucket", KEY], "ingestao_ts")

    return keyed.merge(spark, silver_dir, wave, valid_deliveries(deliveries), [KEY], BRONZE_SCHEMA, latest, buckets, files)


def start_silver_stream(spark: SparkSession, bronze_dir: str, silver_dir: str, checkpoint_dir: str, buckets: int = BUCKETS,
                        available_now: bool = True) -> StreamingQuery:
    """Merge every newly committed batch of bronze, as a stream."""
    return on_commits(spark, bronze_dir, checkpoint_dir,
                      lambda rows, name: merge_wave(rows.sparkSession, rows, silver_dir, name, buckets), available_now)


def read_latest(spark: SparkSession, silver_dir: str) -> DataFrame:
    """The latest valid delivery of every message (bronze columns)."""
    return keyed.read(spark, silver_dir, BRONZE_SCHEMA).select(*BRONZE_SCHEMA.fieldNames())
