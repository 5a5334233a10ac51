"""The mix against its joined slots: drawn counts, whole blocks, repeated rows, NULL ids, hot copies."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import mixing
from tests.llm import brute
from tests.llm.test_operators import SCHEMA, rows


def test_counts_are_drawn_per_shard_with_exact_totals():
    slots = np.array([5000, 0, 1200, 37])
    whole = list(mixing.shard_counts(slots, 64, 0, 10 ** 9))
    assert [s for s, *_ in whole] == list(range(-(-6237 // 64)))
    total, seen = np.zeros(4, np.int64), Counter()
    for shard, src, counts, first in whole:
        assert counts.sum() == (64 if shard < len(whole) - 1 else 6237 % 64)
        assert (first == total[src]).all()  # numbers of a source follow each other over the shards
        total[src] += counts
        seen[tuple(counts[src == 0])] += 1
    assert (total == slots).all() and len(seen) > 5
    # A part of the shards, as another task draws them, is the same.
    part = {s: (src.tolist(), c.tolist(), f.tolist()) for s, src, c, f in mixing.shard_counts(slots, 64, 31, 40)}
    assert part == {s: (src.tolist(), c.tolist(), f.tolist()) for s, src, c, f in whole if 31 <= s < 40}
    # The share of a source varies like a draw: its mean is the share, its spread that of a draw without replacement.
    n = np.array([c[src == 0].sum() for s, src, c, _ in whole[:-1]])
    share = 5000 / 6237
    assert abs(n.mean() - 64 * share) < 1 and 0.5 < n.var() / (64 * share * (1 - share)) < 1.6
    assert list(mixing.shard_counts(np.array([0]), 64, 0, 5)) == []
    assert mixing._drawn(np.random.default_rng(1), np.array([3 * 10 ** 9, 10 ** 9]), 10 ** 9).sum() == 10 ** 9


def texts(rng, n):
    return [" ".join(f"d{i}w{j}" for j in range(rng.choice([0, 1, 3, 40, 130, 500]))) for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_taken_words_are_those_of_the_mixed_texts(spark, seed):
    rng = random.Random(seed)
    body = texts(rng, 60)
    ids = [None if i % 9 == 0 else i // 2 if i % 5 == 0 else i for i in range(len(body))]
    data = rows(body, ids)
    data += [data[3]] * 7 + [data[9]] * 4 + [(None, None, None, None, 0, 1, "x", "y", "z", "q", 5)] * 3
    df = spark.createDataFrame(data, SCHEMA).repartition(4)
    cut, slots, plan = mixing.mix_sources(df, block=32)
    out = mixing.taken_words(cut, slots).collect()
    assert len(out) == len(data)
    assert Counter((r["doc_id"], r["size"]) for r in out) == Counter((d[0], len(brute.WORD.findall(d[1] or ""))) for d in data)
    mixed = mixing.mixed_texts(df, cut, slots, block=32).collect()
    assert sorted(r["slot"] for r in mixed) == list(range(sum(plan.slots)))
    words = Counter(w for r in mixed for w in r["text"].split(" "))
    by_text = Counter()
    for r, d in [(r, None) for r in out]:
        by_text[r["doc_id"], r["size"]] += r["taken"]
    want = Counter()
    owners = {w: (d[0], len(d[1].split())) for d in data if d[1] for w in d[1].split()}
    for w, n in words.items():
        want[owners[w]] += n
    assert {k: v for k, v in by_text.items() if v} == dict(want)
    assert sum(words.values()) == sum(plan.words) and all(r["taken"] <= 2 * r["size"] for r in out)
    again = mixing.taken_words(*mixing.mix_sources(df.repartition(7), block=32)[:2]).collect()
    assert sorted(map(str, again)) == sorted(map(str, out))


def test_a_third_of_all_rows_is_one_row_and_one_text_is_very_long(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SPREAD", 10)
    copies = spark.range(300).select(F.lit(7).cast("long").alias("doc_id"), F.lit("the same row").alias("text"), F.lit("hot").alias("source"))
    other = spark.range(100, 700).select(F.col("id").alias("doc_id"), F.concat(F.lit("word "), F.col("id").cast("string")).alias("text"), F.when(F.col("id") % 2 == 0, "hot").otherwise("b").alias("source"))
    long = spark.range(1).select(F.lit(1).cast("long").alias("doc_id"), F.repeat(F.lit("w "), 200_000).alias("text"), F.lit("c").alias("source"))
    df = copies.unionByName(other).unionByName(long)
    cut, slots, plan = mixing.mix_sources(df)
    out = mixing.taken_words(cut, slots)
    assert out.count() == 901
    sums = {r["target"]: r["n"] for r in out.groupBy("target").agg(F.sum("taken").alias("n")).collect()}
    assert all(abs(t - n) <= 1 for t, n in sums.items())
    assert out.where("taken > 2 * size").count() == 0 and out.where("doc_id = 7").count() == 300
