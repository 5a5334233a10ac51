"""Merged states equal one aggregation over all rows, whatever the loads; parts are replaced, distinct counts are exact."""

import random

import pytest
from pyspark.sql import functions as F

from strata.operators.measure import group_stats
from strata.operators.states import StateTable, mean, stddev0

KEYS = ["g", "h"]


def rows(spark, seed, n):
    rng = random.Random(seed)
    return spark.createDataFrame(
        [(rng.choice(["a", "b", None]), rng.randrange(2), rng.choice([None, 0.0, 100.0, rng.uniform(0, 100), 79.123456789012]), f"v{rng.randrange(40)}" if rng.random() < 0.9 else None, rng.randrange(9))
         for _ in range(n)], "g string, h int, x double, s string, k long")


def whole(df):
    out = group_stats(df, KEYS, m=("avg", "x"), lo=("min", "x"), hi=("max", "x"), sd=("stddev0", "x"), s=("count_distinct", "s"), k=("count_distinct", "k"))
    return {(r["g"], r["h"]): (r["m"], r["lo"], r["hi"], r["sd"], r["s"], r["k"]) for r in out.collect()}


def merged(table):
    out = table.merged().select(*KEYS, mean("x").alias("m"), "min_x", "max_x", stddev0("x").alias("sd"), "distinct_s", "distinct_k")
    return {(r[0], r[1]): tuple(r[2:]) for r in out.collect()}


def check(got, want):
    assert set(got) == set(want)
    for key, values in want.items():
        for a, b in zip(got[key], values, strict=True):
            assert a == b if a is None or b is None else a == pytest.approx(b, abs=1e-9), key


def test_loads_merge_and_parts_are_replaced(spark, tmp_root):
    table = StateTable(spark, tmp_root, KEYS, ["x"], ["s", "k"], buckets=4)
    assert table.merged() is None and table.parts() == {}
    loads = {f"p{i}": rows(spark, i, n) for i, n in enumerate([50, 1, 200, 0])}
    for part, df in loads.items():
        table.load(part, df)
    union = loads["p0"].unionByName(loads["p1"]).unionByName(loads["p2"])
    check(merged(table), whole(union))
    # The same part again, with other rows: what it held before is gone.
    other = rows(spark, 77, 30)
    table.load("p2", other)
    check(merged(table), whole(loads["p0"].unionByName(loads["p1"]).unionByName(other)))
    # Ids are unique, and dense up to the buckets.
    ids = table.dictionary().groupBy("name").agg(F.count("*").alias("n"), F.count_distinct("id").alias("d"), F.count_distinct("value").alias("v"), F.max("id").alias("top")).collect()
    assert all(r["n"] == r["d"] == r["v"] and r["top"] < 4 * 40 for r in ids)


def test_equal_values_have_no_deviation(spark, tmp_root):
    table = StateTable(spark, tmp_root, ["g"], ["x"], ["g"])
    for i in range(3):
        table.load(f"l{i}", spark.range(1000).select(F.lit("a").alias("g"), F.lit(79.1234567890123).alias("x")))
    (r,) = table.merged().select(stddev0("x").alias("sd"), "n_x", "distinct_g").collect()
    assert r["sd"] < 1e-9 and r["n_x"] == 3000 and r["distinct_g"] == 1


def test_a_load_that_dies_changes_nothing(spark, tmp_root, monkeypatch):
    from strata.streaming import commits
    table = StateTable(spark, tmp_root, KEYS, ["x"], ["s", "k"])
    table.load("a", rows(spark, 1, 20))
    before = merged(table)
    with monkeypatch.context() as m:
        m.setattr(commits, "add", lambda *a: False)
        with pytest.raises(RuntimeError, match="load a again"):
            table.load("a", rows(spark, 2, 20))
    assert merged(table) == before
