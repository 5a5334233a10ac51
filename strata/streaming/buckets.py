"""Keyed tables in hash buckets, of which a merge rewrites only those it touches.

A version is a commit (:mod:`strata.streaming.commits`) that names the folder
of every bucket, so it shares the untouched ones with the version before, and
readers see a merge whole or not at all.  The commit carries the name of what
was merged (a wave, a load): merging that again changes nothing.  The number of
buckets is fixed when the table is first written; within a bucket rows are
written in ``files`` parts, so a bucket is no single task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.session import hadoop_path
from strata.streaming import commits

BUCKETS = 64


def bucket_of(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).alias("bucket")


def state(spark: SparkSession, root: str) -> tuple[int, dict[str, str], dict[str, str]]:
    """Number of the current version, its notes (``wave``, ``buckets`` and others), and a folder per bucket."""
    known = commits.names(spark, root)
    if not known:
        return 0, {}, {}
    lines = dict(commits.lines_of(spark, root, known[-1:]))
    return int(known[-1]), {k: v for k, v in lines.items() if not k.isdigit()}, {k: v for k, v in lines.items() if k.isdigit()}


def read(spark: SparkSession, root: str, schema: T.StructType, which: list[int] | None = None) -> DataFrame:
    """The rows of the current version, or of some of its buckets, with the column ``bucket``."""
    _, _, folders = state(spark, root)
    wanted = [v for k, v in folders.items() if which is None or int(k) in which]
    return commits.read(spark, root, wanted, T.StructType([*schema.fields, T.StructField("bucket", T.LongType())]))


def merge(spark: SparkSession, root: str, wave: str, new: DataFrame, keys: list[str], schema: T.StructType,
          combine: Callable[[DataFrame, DataFrame], DataFrame], buckets: int = BUCKETS, files: int = 1,
          notes: Callable[[DataFrame, DataFrame, dict[str, str]], dict[str, str]] | None = None) -> list[int]:
    """Merge ``new`` rows: ``combine(stored rows of the touched buckets, new rows)`` becomes their content.

    Both frames, and the result, have the columns ``schema`` and ``bucket``.
    ``notes(before, after, old notes)`` may add notes, from the rows of the
    touched buckets before and after.  Returns the buckets that were written.
    """
    number, told, folders = state(spark, root)
    if told.get("wave") == wave:
        return []
    buckets = int(told.get("buckets", buckets))
    new = new.withColumn("bucket", bucket_of(keys, buckets))
    touched = sorted(r["bucket"] for r in new.select("bucket").distinct().collect())  # a row per bucket at most
    old = read(spark, root, schema, touched) if touched else new.limit(0)
    folder = f"version=v-{number + 1:010d}/{commits.attempt()}"
    more = {k: v for k, v in told.items() if k not in ("wave", "buckets")}
    if touched:
        combine(old, new).repartition(max(1, len(touched) * files), "bucket", F.pmod(F.xxhash64(*keys, F.lit(1)), F.lit(files))) \
            .write.partitionBy("bucket").parquet(f"{root}/{folder}")
        after = commits.read(spark, root, [folder], T.StructType([*schema.fields, T.StructField("bucket", T.LongType())]))
        more |= notes(old, after, more) if notes else {}
    placed = {k: v for k, v in folders.items() if int(k) not in touched} | {str(b): f"{folder}/bucket={b}" for b in _present(spark, f"{root}/{folder}", touched)}
    if not commits.add(spark, root, f"{number + 1:010d}", [("wave", wave), ("buckets", str(buckets)), *sorted(more.items()), *sorted(placed.items())]):
        raise RuntimeError(f"{root}: version {number + 1} was committed by another writer; run {wave} again")
    return touched


def _present(spark: SparkSession, folder: str, touched: list[int]) -> list[int]:
    """The touched buckets that still have rows."""
    if not touched:
        return []
    fs, where = hadoop_path(spark, folder)
    return [int(n[7:]) for s in fs.listStatus(where) if (n := s.getPath().getName()).startswith("bucket=")]


def written_by_version(spark: SparkSession, root: str) -> list[tuple[int, int, int]]:
    """``(version, buckets written, buckets in all)`` of the kept versions."""
    out, before = [], {}
    for name in commits.names(spark, root):
        now = {k: v for k, v in commits.lines_of(spark, root, [name]) if k.isdigit()}
        out.append((int(name), sum(before.get(k) != v for k, v in now.items()), len(now)))
        before = now
    return out
