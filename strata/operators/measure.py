"""Measures: grouped statistics, ranks, latest period, targets and classes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions import classify as classify_expr
from strata.session import scratch_dir

def exact_mean(col) -> Column:
    """Mean of validated rates from an exact decimal sum: it does not depend on
    the order of addition, so equal means are equal values and tie in a rank."""
    return F.sum(F.col(col).cast("decimal(30,12)")).cast("double") / F.count(col)


_AGGS = {
    "avg": F.avg,
    "mean": exact_mean,
    "min": F.min,
    "max": F.max,
    "count_distinct": F.count_distinct,
    # Sample standard deviation; 0 where it is undefined (one row).
    "stddev0": lambda c: F.coalesce(F.stddev_samp(c), F.lit(0.0)),
}


def group_stats(df: DataFrame, keys: list[str], **aggs: tuple[str, str]) -> DataFrame:
    """GROUP BY ``keys`` with named aggregates, e.g. ``taxa_media=("avg", "taxa")``.

    All aggregates are partial (map-side) first, so a hot group is combined
    before the shuffle; COUNT(DISTINCT) is planned as two aggregation levels.
    """
    cols = []
    for out, (fn, col) in aggs.items():
        expr = _AGGS[fn](col)
        if fn == "count_distinct":
            expr = expr.cast("long")
        cols.append(expr.alias(out))
    return df.groupBy(*keys).agg(*cols)


def rank_within(df: DataFrame, by: list[str], order_col: str, out: str) -> DataFrame:
    """RANK() OVER (PARTITION BY by ORDER BY order_col DESC) as one window.

    For aggregated inputs, where a group is a handful of rows (states of a
    year).  Raw rows, where one group may hold a third of all, go through
    :func:`rank_split`.  NULL values rank last; ``by`` may be empty.
    """
    return df.withColumn(out, F.rank().over(
        Window.partitionBy(*by).orderBy(F.col(order_col).desc_nulls_last())).cast("long"))


def rank_split(df: DataFrame, by: list[str], order_col: str, out: str) -> DataFrame:
    """The same ranks without a task that holds a whole group.

    The rank of a row is 1 + the rows of its group with a larger value.  The
    distinct (group, value) pairs with their counts (partial aggregates) are
    range-partitioned over group and value and written, so a group of any size
    is spread over as many ranges as it needs; each range counts its rows, a
    running sum over the ranges of a group gives offsets, a window per range
    the rest, and the rank is joined back (skewed pairs are split by AQE).
    """
    value = F.col(order_col)
    counts = df.groupBy(*by, order_col).agg(F.count(F.lit(1)).alias("_n"))
    ranged = counts.repartitionByRange(*by, value.desc_nulls_last()).withColumn("_part", F.spark_partition_id())
    path = scratch_dir(df.sparkSession, "ranks")
    ranged.write.parquet(path)
    ranged = df.sparkSession.read.schema(ranged.schema).parquet(path)
    before = Window.unboundedPreceding
    offsets = ranged.groupBy(*by, "_part").agg(F.sum("_n").alias("_size")).withColumn(
        "_offset", F.coalesce(F.sum("_size").over(Window.partitionBy(*by).orderBy("_part").rowsBetween(before, -1)), F.lit(0)))
    local = Window.partitionBy(*by, "_part").orderBy(value.desc_nulls_last()).rowsBetween(before, -1)
    inside = ranged.withColumn("_inside", F.coalesce(F.sum("_n").over(local), F.lit(0)))
    left, right = inside.alias("l"), offsets.alias("r")
    same = F.col("l._part") == F.col("r._part")
    for c in by:
        same = same & F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}"))
    ranks = left.join(right, same).select(
        *[F.col(f"l.{c}").alias(f"_rb_{c}") for c in by], F.col(f"l.{order_col}").alias("_rk"),
        (F.col("_offset") + F.col("_inside") + 1).cast("long").alias(out))
    cond = value.eqNullSafe(F.col("_rk"))
    for c in by:
        cond = cond & F.col(c).eqNullSafe(F.col(f"_rb_{c}"))
    return df.join(ranks, cond, "inner").drop("_rk", *[f"_rb_{c}" for c in by])


def rank_all(df: DataFrame, order_col: str, out: str) -> DataFrame:
    """Global RANK() by ``order_col`` DESC; no partition holds all rows."""
    return rank_split(df, [], order_col, out)


def latest_period(df: DataFrame, key: str, period: str) -> DataFrame:
    """Rows of each key's own latest period (rows without key or period have none).

    For inputs where a key has few rows in its latest period (means by state
    and year): RANK() = 1 by descending period, in one scan; the limit on the
    rank is planned before the exchange as well.  Raw rows, where one key's
    latest period may hold a third of all, go through :func:`latest_period_split`.
    """
    newest = F.rank().over(Window.partitionBy(key).orderBy(F.col(period).desc_nulls_last()))
    return (df.where(F.col(key).isNotNull() & F.col(period).isNotNull())
            .withColumn("_newest", newest).where(F.col("_newest") == 1).drop("_newest"))


def latest_period_split(df: DataFrame, key: str, period: str) -> DataFrame:
    """The same rows without a task that sorts a key's rows, for one more scan.

    MAX(period) per key is a partial aggregate (a row per key leaves each task),
    joined back by key and period: AQE broadcasts the maxima by their measured
    size or splits a hot key's rows as skew.
    """
    newest = df.where(F.col(key).isNotNull() & F.col(period).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.max(period).alias("_newest"))
    return df.join(newest, (F.col(key) == F.col("_key")) & (F.col(period) == F.col("_newest")), "left_semi")


def max_target(targets: DataFrame, scope: str, key: str,
               target_col: str = "meta_alfabetizacao_2030", out: str = "meta_2030") -> DataFrame:
    """MAX(target) per key over one scope of the consolidated targets."""
    return (targets.where((F.col("escopo") == scope) & F.col(key).isNotNull())
            .groupBy(key).agg(F.max(target_col).alias(out)))


def join_targets(df: DataFrame, targets: DataFrame, key: str, cast_key: bool = False,
                 value_col: str = "taxa_media", target_col: str = "meta_2030",
                 reached_col: str | None = None) -> DataFrame:
    """INNER JOIN pre-aggregated targets (one row per key) and add the gap.

    Places without a target drop out.  ``cast_key`` compares the fact key as
    text with the (text) target key.  The targets are an aggregate of one row
    per place: AQE broadcasts them from their measured size when small.
    """
    tk = f"_target_{key}"
    t = targets.withColumnRenamed(key, tk)
    left = F.col(key).cast("string") if cast_key else F.col(key)
    out = (df.join(t, left == F.col(tk), "inner").drop(tk)
           .withColumn("gap_meta", F.col(value_col) - F.col(target_col)))
    if reached_col:
        out = out.withColumn(reached_col, F.col(value_col) >= F.col(target_col))
    return out


def classify(df: DataFrame, col: str, out: str, cuts=None, default=None) -> DataFrame:
    kwargs = {}
    if cuts is not None:
        kwargs["cuts"] = cuts
    if default is not None:
        kwargs["default"] = default
    return df.withColumn(out, classify_expr(col, **kwargs))
