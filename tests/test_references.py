"""References kept by key counts: inserts and deletes on both sides, only touched buckets, equal to a LEFT JOIN."""

import random

from pyspark.sql import functions as F

from strata.operators.references import References
from strata.streaming import buckets as keyed


def frame(spark, keys, name):
    return spark.createDataFrame([(k,) for k in keys], f"{name} string")


def joined(facts, dims):
    have = {d for d in dims if d is not None}
    return sum(f not in have for f in facts), len(facts)


def test_loads_equal_the_join(spark, tmp_root):
    rng = random.Random(4)
    refs = References(spark, tmp_root, "k", "d", buckets=32)
    assert refs.verdict() == (0, 0)
    facts, dims = [], []
    names = [f"n{i}" for i in range(40)] + [None]
    for step in range(4):
        new_f, new_d = rng.choices(names, k=30), rng.choices(names, k=6)
        old_f = rng.sample(facts, min(len(facts), 5 * (step > 1)))
        old_d = rng.sample(dims, min(len(dims), 3 * (step > 0)))
        facts += new_f
        dims += new_d
        for x in old_f:
            facts.remove(x)
        for x in old_d:
            dims.remove(x)
        refs.load(f"step{step}", frame(spark, new_f, "k"), frame(spark, new_d, "d"), frame(spark, old_f, "k"), frame(spark, old_d, "d"))
        assert refs.verdict() == joined(facts, dims), step
    assert refs.load("step3", frame(spark, ["n1"], "k")) == []  # the load before, again
    got = {r["key"]: r["facts"] for r in refs.orphan_keys().collect()}
    assert got == {k: facts.count(k) for k in set(facts) if k is None or k not in dims}


def test_a_directory_delete_touches_its_bucket_only(spark, tmp_root):
    refs = References(spark, tmp_root, "id", "id", buckets=16)
    all_keys = spark.range(500).select(F.col("id"))
    refs.load("all", all_keys, all_keys)
    assert refs.verdict() == (0, 500)
    assert len(refs.load("delete", gone_directory=all_keys.where("id = 7"))) == 1
    assert refs.verdict() == (1, 500)
    assert len(refs.load("back", directory=all_keys.where("id = 7"))) == 1
    assert refs.verdict() == (0, 500)
    assert [n for _, n, _ in keyed.written_by_version(spark, tmp_root)] == [16, 1, 1]
    # Everything goes: no bucket has a row left.
    refs.load("none", gone_facts=all_keys, gone_directory=all_keys)
    assert refs.verdict() == (0, 0) and refs.orphan_keys().collect() == []
