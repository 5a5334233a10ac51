"""One key holding a third of all rows: results equal a plain-SQL computation,
and the plans reduce the hot key map-side before any shuffle."""

import pytest
from pyspark.sql import functions as F

from strata.operators.clean import keep_latest
from strata.operators.measure import group_stats, latest_period, latest_period_split, rank_split


@pytest.fixture(scope="module")
def skewed(spark):
    n = 90_000
    # key 0 holds a third of the rows; the rest spread over 3,000 keys.
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 3000 + 1).alias("k"),
        (F.col("id") % 97).alias("ts"),
        ((F.col("id") * 7919) % 1000 / F.lit(10.0)).alias("v"),
        F.col("id"),
    ).repartition(6)


def _sorted(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_keep_latest_hot_key(spark, skewed):
    skewed.createOrReplaceTempView("skewed")
    ours = keep_latest(skewed, ["k"], "ts", tie_breaks=["id"])
    ref = spark.sql("SELECT k, ts, v, id FROM (SELECT *, row_number() OVER (PARTITION BY k "
                    "ORDER BY ts DESC, id DESC) AS rn FROM skewed) WHERE rn = 1")
    assert _sorted(ours, "k", "ts", "id") == _sorted(ref, "k", "ts", "id")
    plan = _plan(ours)
    # Partial limit before the exchange: the hot key leaves each map task as one row.
    assert plan.index("Partial") > plan.index("Exchange")


def test_group_stats_hot_key(spark, skewed):
    skewed.createOrReplaceTempView("skewed")
    ours = group_stats(skewed, ["k"], m=("avg", "v"), lo=("min", "v"), n=("count_distinct", "ts"),
                       sd=("stddev0", "v"))
    ref = spark.sql("SELECT k, avg(v) AS m, min(v) AS lo, count(DISTINCT ts) AS n, "
                    "coalesce(stddev_samp(v), 0) AS sd FROM skewed GROUP BY k")
    r = lambda df: sorted((a, round(b, 9), c, d, round(e, 9)) for a, b, c, d, e in
                          df.select("k", "m", "lo", "n", "sd").collect())
    assert r(ours) == r(ref)
    plan = _plan(ours)
    assert "partial_" in plan  # map-side partial aggregation


def test_rank_within_hot_group(spark, skewed):
    skewed.createOrReplaceTempView("skewed")
    grouped = skewed.withColumn("g", (F.col("k") == 0).cast("int"))
    ours = rank_split(grouped, ["g"], "v", "r")
    grouped.createOrReplaceTempView("grouped")
    ref = spark.sql("SELECT id, rank() OVER (PARTITION BY g ORDER BY v DESC) AS r FROM grouped")
    assert _sorted(ours, "id", "r") == _sorted(ref, "id", "r")


def test_latest_period_hot_key(spark, skewed):
    skewed.createOrReplaceTempView("skewed")
    ours = latest_period(skewed, "k", "ts")
    ref = spark.sql("SELECT s.* FROM skewed s JOIN (SELECT k, max(ts) AS mt FROM skewed GROUP BY k) m "
                    "ON s.k = m.k AND s.ts = m.mt")
    assert _sorted(ours, "id") == _sorted(ref, "id")


def test_latest_period_split_hot_key(spark, skewed):
    """Most rows are one key's, all of its latest period: no window, and the same rows."""
    hot = skewed.withColumn("ts", F.when(F.col("k") == 0, F.lit(None)).otherwise(F.col("ts"))).unionByName(
        skewed.withColumn("k", F.lit(0).cast("long")).withColumn("ts", F.lit(skewed.agg(F.max("ts")).first()[0])), allowMissingColumns=True)
    ours = latest_period_split(hot, "k", "ts")
    assert "Window" not in ours._jdf.queryExecution().executedPlan().toString()
    assert _sorted(ours, "id") == _sorted(latest_period(hot, "k", "ts"), "id")


def test_hot_group_of_distinct_values_is_spread(spark):
    """A third of the rows in one group, every value different: no range holds the group, the ranks are SQL's."""
    df = spark.range(60_000).select((F.col("id") % 3 == 0).cast("int").alias("g"), (F.col("id") * 7919 % 60_013).cast("double").alias("v"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ours = rank_split(df, ["g"], "v", "r")
        df.createOrReplaceTempView("spread")
        ref = spark.sql("SELECT id, rank() OVER (PARTITION BY g ORDER BY v DESC) AS r FROM spread")
        assert _sorted(ours, "id", "r") == _sorted(ref, "id", "r")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
