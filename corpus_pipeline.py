"""A training corpus from ``documents``: stages that each call one operator of ``strata.llm``.

Every function takes ``(spark, docs, sf_dir)`` and returns a DataFrame; each
result is written and read again as the next stage's input.  All but the last
return the columns of ``documents``.

Defined cases: a stage on an empty table returns an empty table; NULL texts
are empty texts, NULL ids and sources are kept; of repeated rows the
near-duplicate stage keeps one; extra columns are carried unchanged up to the
last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import decontaminate, mixing, pu_quality, secret_scan, simhash
from strata.llm.common import table, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return pu_quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays."""
    return simhash.keep_one(docs, shingle=3, threshold=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked, and ``n_chars`` follows the text."""
    masked = secret_scan.mask_secrets(docs)
    return masked.withColumn("n_chars", F.length("text").cast("long"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the remaining documents: how many words it takes of each."""
    cut, slots, _ = mixing.mix_sources(docs)
    return mixing.taken_words(cut, slots).select("doc_id", "size", "source_size", "target", "taken")


STAGES = [
    ("quality classifier", quality),
    ("simhash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("secret scans", secrets),
    ("mixing sources to target weights", mix),
]

#: Classifier, hashes and permutations have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, f"stage-{i}")
    return docs
