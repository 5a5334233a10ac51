"""Referential integrity kept up to date: a load checks its new facts and the changed directory rows only.

Per key the table holds how many fact rows and how many directory rows have it,
in hash buckets (:mod:`strata.streaming.buckets`).  Orphans are the fact rows
of keys without a directory row.  A load changes some keys; the orphans of the
touched buckets before and after it move the totals, which are notes of the
version, so a check reads no data at all.  Deleted rows come as negative
counts.  A fact with a NULL key is an orphan, as in a LEFT JOIN.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.streaming import buckets as keyed

SCHEMA = T.StructType([T.StructField("key", T.StringType()), T.StructField("facts", T.LongType()), T.StructField("dims", T.LongType())])


def _counted(df: DataFrame | None, key: str, column: str, sign: int) -> DataFrame | None:
    if df is None:
        return None
    zero = F.lit(0).cast("long")
    n = (F.count(F.lit(1)) * sign).cast("long")
    counts = df.groupBy(F.col(key).cast("string").alias("key")).agg(n.alias("n"))
    return counts.select("key", (F.col("n") if column == "facts" else zero).alias("facts"), (F.col("n") if column == "dims" else zero).alias("dims"))


def _orphans(rows: DataFrame) -> int:
    lost = F.when((F.col("dims") <= 0) | F.col("key").isNull(), F.col("facts")).otherwise(0)
    return int(rows.agg(F.coalesce(F.sum(lost), F.lit(0)).alias("n")).first()["n"])


class References:
    """The state of one reference: fact column ``key`` to directory column ``ref_key``, both compared as text."""

    def __init__(self, spark: SparkSession, root: str, key: str, ref_key: str, buckets: int = keyed.BUCKETS) -> None:
        self.spark, self.root, self.key, self.ref_key, self.buckets = spark, root, key, ref_key, buckets

    def load(self, name: str, facts: DataFrame | None = None, directory: DataFrame | None = None,
             gone_facts: DataFrame | None = None, gone_directory: DataFrame | None = None) -> list[int]:
        """Take in the rows that came and went; the buckets that were written."""
        sides = [_counted(facts, self.key, "facts", 1), _counted(directory, self.ref_key, "dims", 1),
                 _counted(gone_facts, self.key, "facts", -1), _counted(gone_directory, self.ref_key, "dims", -1)]
        new = self.spark.createDataFrame([], SCHEMA)
        for side in sides:
            new = new if side is None else new.unionByName(side)

        def total(old: DataFrame, added: DataFrame) -> DataFrame:
            sums = old.unionByName(added).groupBy("bucket", "key").agg(F.sum("facts").alias("facts"), F.sum("dims").alias("dims"))
            return sums.where("facts <> 0 OR dims <> 0").select("key", "facts", "dims", "bucket")

        def notes(before: DataFrame, after: DataFrame, told: dict[str, str]) -> dict[str, str]:
            rows = int(told.get("rows", 0)) + sum(s * int(x.agg(F.coalesce(F.sum("facts"), F.lit(0)).alias("n")).first()["n"]) for s, x in ((1, after), (-1, before)))
            return {"orphans": str(int(told.get("orphans", 0)) + _orphans(after) - _orphans(before)), "rows": str(rows)}

        return keyed.merge(self.spark, self.root, name, new, ["key"], SCHEMA, total, self.buckets, notes=notes)

    def verdict(self) -> tuple[int, int]:
        """``(orphan rows, fact rows)`` of the current version, from its notes."""
        _, told, _ = keyed.state(self.spark, self.root)
        return int(told.get("orphans", 0)), int(told.get("rows", 0))

    def orphan_keys(self) -> DataFrame:
        """Keys of facts that have no directory row, with their fact rows."""
        return keyed.read(self.spark, self.root, SCHEMA).where("facts > 0 AND (dims <= 0 OR key IS NULL)").select("key", "facts")
