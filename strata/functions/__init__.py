"""Column expressions shared by the operators (all built-in, JVM side)."""

from __future__ import annotations

from functools import reduce
from operator import add, and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

LEVELS = [f"proporcao_aluno_nivel_{k}" for k in range(9)]
TARGET_YEARS = list(range(2024, 2031))
TARGETS = [f"meta_alfabetizacao_{y}" for y in TARGET_YEARS]

# Level bands: any NULL level gives a NULL band (plain '+', no coalesce).
BANDS = {
    "proporcao_abaixo_basico": LEVELS[0:2],
    "proporcao_basico": LEVELS[2:4],
    "proporcao_adequado_avancado": LEVELS[4:9],
}
TOP_SHARE = {"proporcao_topo": LEVELS[6:9]}

# Classification cut-offs and labels of the state ranking.
CLASS_CUTS = [(90.0, "Alto"), (75.0, "Médio")]
CLASS_DEFAULT = "Requer atenção"

# The 27 valid state codes, in alphabetical order.
VALID_STATES = [
    "AC", "AL", "AM", "AP", "BA", "CE", "DF", "ES", "GO",
    "MA", "MG", "MS", "MT", "PA", "PB", "PE", "PI", "PR",
    "RJ", "RN", "RO", "RR", "RS", "SC", "SE", "SP", "TO",
]


def col_sum(cols: list[str]) -> Column:
    """Null-propagating sum of columns."""
    return reduce(add, [F.col(c) for c in cols])


def all_not_null(cols: list[str]) -> Column:
    return reduce(and_, [F.col(c).isNotNull() for c in cols])


def any_null(cols: list[str]) -> Column:
    return reduce(or_, [F.col(c).isNull() for c in cols])


def normalise(c: str | Column) -> Column:
    """UPPER(TRIM(x)); trim strips blanks only, as in SQL."""
    return F.upper(F.trim(F.col(c) if isinstance(c, str) else c))


def classify(c: str | Column, cuts=CLASS_CUTS, default=CLASS_DEFAULT) -> Column:
    """First cut whose lower bound (inclusive) the value reaches, else default."""
    value = F.col(c) if isinstance(c, str) else c
    expr = None
    for limit, label in cuts:
        cond = value >= F.lit(limit)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(default))
