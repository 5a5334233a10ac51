"""Connected components of an undirected graph by alternating large and small stars; every round is one written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges`` (``a``, ``b``): the smallest node it reaches.

    Large star: each node links its larger neighbours to its smallest one.
    Small star: each node links its smaller neighbours and itself to the
    smallest.  At the fixpoint every node points at its root.  Neighbour lists
    are never collected: minima are partial aggregates joined back.
    """
    state = written(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "cc")
    mark = _mark(state)
    while True:
        both = state.union(state.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        state = written(small.where("u <> v").distinct(), "cc")
        now = _mark(state)
        if now == mark:
            return state.select(F.col("u").alias("node"), F.col("v").alias("root")) \
                .union(state.select("v", "v").distinct())
        mark = now


def _mark(state: DataFrame):
    r = state.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return r["n"], r["h"]
