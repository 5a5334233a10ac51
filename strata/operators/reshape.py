"""Unpivot of sparse metric columns to (metric, value) rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def melt_sparse(df: DataFrame, ids: list[str], metrics: list[str],
                name: str = "metrica", value: str = "valor") -> DataFrame:
    """One row per (input row, metric) with the value as text; NULL values dropped.

    ``stack`` is a generator evaluated in the same stage as the scan (no
    shuffle) and also works on a streaming DataFrame.  Values are cast to
    string first because the metric columns mix DOUBLE and STRING.
    """
    args = [F.lit(len(metrics))]
    for m in metrics:
        args += [F.lit(m), F.col(m).cast("string")]
    melted = df.select(*[F.col(c) for c in ids], F.stack(*args).alias(name, value))
    return melted.where(F.col(value).isNotNull())
