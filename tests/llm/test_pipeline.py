"""The pipeline: stages on their own input, columns kept, and the last stage's contract."""

import corpus_pipeline
from pyspark.sql import functions as F

from tests.conftest import SMOKE
from tests.llm import brute


def test_stages(spark):
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet")
    cols = docs.columns
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SMOKE}/labels.parquet").collect()}
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{SMOKE}/benchmark.parquet").collect()}
    stages = dict(corpus_pipeline.STAGES)
    assert len(stages) == 5
    good, one, clean, masked, mixed = stages.values()
    df = good(spark, docs, SMOKE)
    kept = {r["doc_id"]: r["text"] for r in df.collect()}
    assert df.columns == cols and kept.items() <= before.items()
    known = [d for d in before if d in labels]
    assert sum((d in kept) == (labels[d] == 1) for d in known) >= 0.95 * len(known)
    df = one(spark, docs, SMOKE)
    assert df.columns == cols and {r["doc_id"] for r in df.collect()} == {c for _, c in brute.simhash(before).values()}
    df = clean(spark, docs, SMOKE)
    assert df.columns == cols and {r["doc_id"] for r in df.collect()} == {d for d, w in brute.contamination(before, items).items() if not w[4]}
    df = masked(spark, docs, SMOKE)
    assert df.columns == cols
    for r in df.collect():
        assert sum(brute.secrets(r["text"])[:3]) == 0 and r["n_chars"] == len(r["text"])
        assert r["text"] == before[r["doc_id"]] or sum(brute.secrets(before[r["doc_id"]])[:3])
    df = mixed(spark, docs, SMOKE)
    assert {r["doc_id"]: r["size"] for r in df.collect()} == {d: len(brute.WORD.findall(t or "")) for d, t in before.items()}


def test_run_and_empty(spark):
    out = corpus_pipeline.run(spark, SMOKE).collect()
    assert out and all(0 <= r["taken"] <= 2 * r["size"] for r in out)
    nothing = spark.read.parquet(f"{SMOKE}/documents.parquet").withColumn("row", F.lit(1)).withColumn("_doc", F.lit("x")).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, SMOKE).count() == 0
