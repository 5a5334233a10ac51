"""Helpers shared by the operators: tables, written intermediates, row identity, digests."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import checkpoint_root

#: Separators of the word rule ``[^\x20\x09-\x0D]+``.
SPACES = " \t\n\x0b\f\r"
SPACE_CLASS = "[ \\t\\n\\x0B\\f\\r]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back; ``options`` go to the Parquet writer.

    This cuts the lineage: later jobs read files every executor can reach,
    so a lost executor repeats only its own tasks.  The folder goes when the
    driver's JVM ends.
    """
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/llm/{name}-{uuid.uuid4().hex[:12]}"
    df.write.options(**options).parquet(path)
    jvm, sc = spark.sparkContext._jvm, spark.sparkContext
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(sc._jsc.hadoopConfiguration()).deleteOnExit(where)
    return spark.read.schema(df.schema).parquet(path)


#: Columns that identify a row: rows that agree in both are copies of each
#: other and get the same result, so joins on them never multiply rows.
KEY = ["_doc", "_hash"]


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(_doc, _hash, text)``: id (NULL as the lowest long) and content hash."""
    doc = F.coalesce(F.col(id_col).cast("long"), F.lit(-(2 ** 63)))
    return docs.select(doc.alias("_doc"), F.xxhash64(F.col(text_col)).alias("_hash"),
                       F.col(text_col).alias("text"))


def doc_id() -> Column:
    """The public id back from ``_doc``."""
    return F.when(F.col("_doc") != -(2 ** 63), F.col("_doc")).alias("doc_id")


def words(text: Column) -> Column:
    """Words of a text as an array; empty for NULL and blank texts."""
    inner = F.btrim(text, F.lit(SPACES))
    return F.when(F.coalesce(F.length(inner), F.lit(0)) == 0, F.array().cast("array<string>")) \
            .otherwise(F.split(inner, SPACE_CLASS + "+"))


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit("[^ \\t\\n\\x0B\\f\\r]+")), F.lit(0)).cast("long")


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
