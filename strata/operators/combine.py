"""Stacking of scope tables with aligned columns (UNION ALL)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stack_scopes(parts: dict[str, DataFrame], columns: list[tuple[str, str]],
                 scope_col: str = "escopo") -> DataFrame:
    """UNION ALL of ``parts`` with a literal scope tag per part.

    ``columns`` is the output list (name, type); a column a part lacks becomes
    a typed NULL, one it has is cast to the declared type.  No shuffle: the
    union only concatenates partitions.
    """
    aligned = []
    for scope, part in parts.items():
        have = set(part.columns)
        cols = [(F.col(name) if name in have else F.lit(None)).cast(dtype).alias(name)
                for name, dtype in columns if name != scope_col]
        aligned.append(part.select(*cols, F.lit(scope).alias(scope_col)))
    return reduce(lambda a, b: a.unionByName(b), aligned)
