"""Quality rules both ways: a clean frame passes, one planted defect fails
exactly that rule; reports never fail; enforce raises on a failed check."""

import pytest
from pyspark.sql import functions as F

from strata.functions import LEVELS
from strata.plans.quality import DataQualityError, Rule, enforce, evaluate

KEYS = ["ano", "sigla_uf", "serie", "rede"]
SCHEMA = ("ano long, sigla_uf string, serie string, rede string, taxa_alfabetizacao double, "
          + ", ".join(f"{c} double" for c in LEVELS))


def _row(ano, uf, taxa, levels=None):
    levels = levels if levels is not None else [100.0 / 9] * 9
    return (ano, uf, "s", "r", taxa, *levels)


RULES = [
    Rule("non_empty", "bronze", "t"),
    Rule("duplicates", "bronze", "t", {"keys": KEYS}),
    Rule("range", "bronze", "t", {"col": "taxa_alfabetizacao", "lo": 0, "hi": 100}),
    Rule("domain", "bronze", "t", {"col": "sigla_uf", "domain": ["SP", "RJ"]}),
    Rule("nulls", "bronze", "t", {"cols": ["ano", "sigla_uf"]}),
    Rule("level_sum", "bronze", "t", {"cols": LEVELS, "target": 100, "tol": 1}),
    Rule("missing", "bronze", "t", {"col": LEVELS[0]}),
]


def _failed(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    res = evaluate(spark, {("bronze", "t"): df}, RULES)
    return sorted(r.rule for r in res.where(~F.col("passed")).collect()), res


def test_clean_table_passes(spark):
    failed, res = _failed(spark, [_row(2023, "SP", 90.0), _row(2023, "RJ", 80.0), _row(2022, "SP", None)])
    assert failed == []
    assert res.count() == len(RULES)
    enforce(res)


@pytest.mark.parametrize("bad_row, rule", [
    (_row(2023, "SP", 70.0), "no_duplicate_keys(ano,sigla_uf,serie,rede)"),
    (_row(2021, "SP", 100.5), "taxa_alfabetizacao_within_0_100"),
    (_row(2021, "XX", 50.0), "sigla_uf_in_domain"),
    (_row(None, "SP", 50.0), "no_nulls(ano,sigla_uf)"),
    (_row(2021, "SP", 50.0, [11.3] * 9), "levels_sum_to_100_within_1"),
])
def test_one_defect_fails_one_rule(spark, bad_row, rule):
    failed, res = _failed(spark, [_row(2023, "SP", 90.0), _row(2023, "RJ", 80.0), bad_row])
    assert failed == [rule]
    with pytest.raises(DataQualityError):
        enforce(res)


def test_level_sum_tolerance_edges(spark):
    def levels(total):
        return [total - 8.0] + [1.0] * 8
    data = [_row(2020 + i, "SP", 50.0, levels(t)) for i, t in enumerate([98.9, 99.0, 101.0, 101.1])]
    df = spark.createDataFrame(data, SCHEMA)
    res = evaluate(spark, {("bronze", "t"): df}, [RULES[5]]).collect()[0]
    assert res.violations == 2


def test_null_domain_code_passes_and_missing_is_report(spark):
    data = [_row(2023, None, 50.0, [None] * 9), _row(2023, "SP", 50.0)]
    df = spark.createDataFrame(data, SCHEMA)
    res = {r.rule: r for r in evaluate(spark, {("bronze", "t"): df}, RULES[3:4] + RULES[6:]).collect()}
    assert res["sigla_uf_in_domain"].violations == 0
    missing = res[f"missing_{LEVELS[0]}"]
    assert (missing.violations, missing.total, missing.passed, missing.kind) == (1, 2, True, "report")


def test_missing_table_fails_existence_and_skips_others(spark):
    res = evaluate(spark, {}, RULES).collect()
    assert [(r.rule, r.passed, r.total) for r in res] == [("exists_and_non_empty", False, 0)]


def test_references_and_coverage(spark):
    gold = spark.createDataFrame([("SP",), ("RJ",), ("RJ",)], "sigla_uf string")
    metas = spark.createDataFrame([("uf", "SP"), ("municipio", "RJ")], "escopo string, sigla_uf string")
    rules = [
        Rule("references", "gold", "g", {"key": "sigla_uf", "ref": ("silver", "m"), "ref_key": "sigla_uf",
                                         "ref_filter_sql": "escopo = 'uf'"}),
        Rule("coverage", "gold", "g", {"key": "sigla_uf", "ref": ("silver", "m"), "ref_key": "sigla_uf",
                                       "ref_filter_sql": "escopo = 'uf'"}),
    ]
    res = {r.rule: r.violations for r in evaluate(
        spark, {("gold", "g"): gold, ("silver", "m"): metas}, rules).collect()}
    # Orphans count rows, not keys.
    assert res == {"sigla_uf_references_silver.m": 2, "covers_silver.m.sigla_uf": 1}


def test_row_ratio(spark):
    small = spark.range(3)
    big = spark.range(5)
    rule = Rule("row_ratio", "silver", "s", {"other": ("bronze", "b")})
    ok = evaluate(spark, {("silver", "s"): small, ("bronze", "b"): big}, [rule]).collect()[0]
    bad = evaluate(spark, {("silver", "s"): big, ("bronze", "b"): small}, [rule]).collect()[0]
    assert (ok.passed, bad.passed) == (True, False)


def test_sql_side_stands_alone():
    """The SQL package imports nothing of the Spark side."""
    import subprocess
    import sys
    code = ("import sys; sys.path.insert(0, '.'); import strata.oracle.layers, strata.oracle.stream; "
            "assert not [m for m in sys.modules if m.startswith(('strata.', 'pyspark')) and not m.startswith('strata.oracle')]")
    subprocess.run([sys.executable, "-c", code], check=True, timeout=120)
