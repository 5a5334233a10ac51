"""Cleaning: required fields, ranges, keep-latest dedup, code normalisation, bands."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions import col_sum, normalise


def require(df: DataFrame, not_null: list[str] = (), equals: dict | None = None,
            within: dict | None = None, null_or_within: dict | None = None) -> DataFrame:
    """Keep rows where every condition holds.

    ``not_null``: columns that must be set; ``equals``: column -> value;
    ``within``: column -> (lo, hi), inclusive, NULL fails;
    ``null_or_within``: column -> (lo, hi), NULL passes (sparse columns).
    """
    conds: list[Column] = [F.col(c).isNotNull() for c in not_null]
    conds += [F.col(c) == F.lit(v) for c, v in (equals or {}).items()]
    conds += [F.col(c).between(lo, hi) for c, (lo, hi) in (within or {}).items()]
    conds += [F.col(c).isNull() | F.col(c).between(lo, hi)
              for c, (lo, hi) in (null_or_within or {}).items()]
    return df.where(reduce(and_, conds)) if conds else df


def keep_latest(df: DataFrame, keys: list[str], order_col: str,
                tie_breaks: list[str] | None = None) -> DataFrame:
    """One row per key: the latest by ``order_col`` (NULLs last).

    Ties are broken by ``tie_breaks`` (default: every other column, in order),
    each descending with NULLs last, so the pick is the same on every run.
    ``row_number() = 1`` lets Catalyst add a partial WindowGroupLimit before the
    shuffle, so a hot key is cut to one row per input partition map-side.
    """
    if tie_breaks is None:
        # Map columns have no ordering; every other column breaks ties.
        tie_breaks = [f.name for f in df.schema.fields
                      if f.name not in set(keys) | {order_col} and not isinstance(f.dataType, T.MapType)]
    order = [F.col(order_col).desc_nulls_last()] + [F.col(c).desc_nulls_last() for c in tie_breaks]
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def normalise_code(df: DataFrame, col: str, out: str) -> DataFrame:
    return df.withColumn(out, normalise(col))


def band_sums(df: DataFrame, bands: dict[str, list[str]]) -> DataFrame:
    """Add one column per band: the NULL-propagating sum of its columns."""
    return df.withColumns({out: col_sum(cols) for out, cols in bands.items()})
