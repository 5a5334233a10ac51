"""Very long texts, repeated rows and clashing column names on tables that are not empty."""

import random

import corpus_pipeline
from pyspark.sql import functions as F

from strata.llm import pu_quality, quality_rules, simhash
from tests.conftest import SMOKE
from tests.llm import brute
from tests.llm.test_operators import SCHEMA, got, rows

LONG = "the long text goes on and on without an end in sight \n" * 60_000  # 3 million characters


def test_long_texts(spark):
    texts = [LONG, LONG + "once more", "short text of five words", None]
    df = spark.createDataFrame(rows(texts), SCHEMA).repartition(3)
    out = simhash.near_duplicates(df, shingle=3, threshold=2)
    assert got(out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("f"), "component_id"), "f", "component_id") == brute.simhash(dict(enumerate(texts)))
    labels = spark.read.parquet(f"{SMOKE}/labels.parquet")
    statistics, learned = quality_rules.learned_rules(df, labels)
    n = {r["doc_id"]: r["n_words"] for r in quality_rules.apply_rules(statistics, learned).collect()}
    assert n == {i: len(brute.WORD.findall(t or "")) for i, t in enumerate(texts)}
    assert all(0 <= r["score"] <= 1 for r in pu_quality.quality_scores(df, labels).collect())


def test_repeated_rows_do_not_move_the_classifier(spark):
    docs, labels = (spark.read.parquet(f"{SMOKE}/{n}.parquet") for n in ("documents", "labels"))
    once = {r["doc_id"]: round(r["score"], 9) for r in pu_quality.quality_scores(docs, labels).collect()}
    first = docs.where("doc_id < 40")
    many = docs.unionByName(first).unionByName(first).unionByName(first).repartition(7)
    for _ in range(2):
        assert {r["doc_id"]: round(r["score"], 9) for r in pu_quality.quality_scores(many, labels).collect()} == once


def test_stages_keep_clashing_columns(spark):
    rng = random.Random(1)
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet").limit(60)
    named = docs.select("*", *(F.lit(rng.randrange(9)).alias(c) for c in ("row", "_doc", "_hash", "fp", "root", "key", "size", "block", "at", "src")))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, named, SMOKE)
        assert out.columns == named.columns, name
        assert {r["doc_id"] for r in out.collect()} <= {r["doc_id"] for r in docs.collect()}
    last = corpus_pipeline.STAGES[-1][1](spark, named, SMOKE)
    assert last.count() == docs.count() and last.columns == ["doc_id", "size", "source_size", "target", "taken"]
