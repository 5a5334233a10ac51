"""A file-skipping index of written tables: per file the range of a column and a Bloom filter of its values.

Parquet's own statistics are read file by file once a scan is planned over all
of them; this index is one small table, so a lookup plans a scan of the few
files that can hold the value, also for columns the table is not clustered by.

An index has a row per file, and files never change, so indexing a new version
reads only the files that no earlier version had.  Files that are not indexed
are always kept: results are the same with an index of any age or none.

A filter has slots of 32,768 bits, about ``BITS`` bits per distinct value of the
file, and ``len(SEEDS)`` bits set per value.  It is kept as its 64-bit words that
are not zero, a row each: words are numbers that a task of the scan ORs together
in a hash table, so neither values nor bits are sorted or shuffled, and files go
by a number meanwhile.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.plans.run import read_table
from strata.streaming import commits

SLOT = 32768
WORD = 64
BITS = 12
SEEDS = (1, 2, 3)


def _root(root: str, layer: str, name: str, column: str) -> str:
    return f"{root}/{layer}/{name}/_index/words/{column}"  # not where filters of another form were kept


def _plain(path: Column) -> Column:
    """One spelling of a path, whichever part of Spark names it."""
    return F.regexp_replace(path, "^([A-Za-z0-9]+):/+", "$1:/")


def _positions(value: Column, slots: Column) -> Column:
    """The bits of a value: array of positions in a filter of so many slots."""
    return F.array(*(F.pmod(F.xxhash64(value, F.lit(s)), slots * SLOT) for s in SEEDS))


def _word(at: Column) -> Column:
    return F.floor(at / WORD).cast("long")


def _bit(at: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(at, F.lit(WORD)).cast("int"))


def _stored(spark: SparkSession, where: str, kind: str, schema: T.StructType) -> DataFrame:
    return commits.read(spark, where, [v for k, v in commits.lines_of(spark, where) if k == kind], schema)


def _schemas(kind: T.DataType) -> tuple[T.StructType, T.StructType]:
    files = T.StructType([T.StructField("file", T.StringType()), T.StructField("lo", kind), T.StructField("hi", kind), T.StructField("slots", T.LongType())])
    return files, T.StructType([T.StructField("file", T.StringType()), T.StructField("word", T.LongType()), T.StructField("bits", T.LongType())])


def _files(spark: SparkSession, df: DataFrame) -> DataFrame:
    paths = spark.createDataFrame([(p,) for p in df.inputFiles()], "path string")
    return paths.select("path", _plain(F.col("path")).alias("file"))


def _ranges(rows: DataFrame) -> DataFrame:
    """Per file the least and the largest value and the slots of its filter."""
    # A sketch among the aggregates makes Spark hash the files; minima of texts alone would sort all rows.
    distinct = F.hll_sketch_estimate(F.hll_sketch_agg(F.when(F.col("value").isNotNull(), F.xxhash64("value"))))
    slots = F.greatest(F.lit(1), F.ceil(distinct * BITS / SLOT)).cast("long")
    return rows.groupBy("file").agg(F.min("value").alias("lo"), F.max("value").alias("hi"), slots.alias("slots"))


def _words(rows: DataFrame, files: DataFrame) -> DataFrame:
    """The filters' words that are not zero, by the files' numbers."""
    at = rows.where("value IS NOT NULL").join(files.select("file", "no", "slots"), "file").select(
        "no", F.explode(_positions(F.col("value"), F.col("slots"))).alias("at"))
    return at.groupBy("no", _word(F.col("at")).alias("word")).agg(F.bit_or(_bit(F.col("at"))).alias("bits"))


def index_column(spark: SparkSession, root: str, layer: str, name: str, column: str) -> int:
    """Index the files of the current version that no index row names yet; how many these were."""
    df, where = read_table(spark, root, layer, name), _root(root, layer, name, column)
    known, _ = _schemas(df.schema[column].dataType)
    new = [r["path"] for r in _files(spark, df).join(_stored(spark, where, "files", known), "file", "left_anti").collect()]
    if not new:
        return 0
    rows = spark.read.parquet(*new).select(F.col(column).alias("value"), _plain(F.input_file_name()).alias("file"))
    folder = f"batch=b-{len(commits.names(spark, where)):010d}/{commits.attempt()}"
    numbers = spark.createDataFrame(list(enumerate(new)), "no long, path string").select("no", _plain(F.col("path")).alias("file"))
    _ranges(rows).join(numbers, "file").write.parquet(f"{where}/{folder}/files")
    files = spark.read.schema(T.StructType([*known, T.StructField("no", T.LongType())])).parquet(f"{where}/{folder}/files")
    _words(rows, files).join(files.select("no", "file"), "no").select("file", "word", "bits").write.parquet(f"{where}/{folder}/words")
    if not commits.add(spark, where, f"{len(commits.names(spark, where)):010d}", [("files", f"{folder}/files"), ("words", f"{folder}/words")]):
        raise RuntimeError(f"{where}: another index batch was committed meanwhile; index again")
    return len(new)


def files_for(spark: SparkSession, root: str, layer: str, name: str, column: str, values: list) -> tuple[list[str], int]:
    """``(files that may hold one of the values, files of the version)``."""
    df, where = read_table(spark, root, layer, name), _root(root, layer, name, column)
    kind = df.schema[column].dataType
    known, bloom = _schemas(kind)
    current = _files(spark, df)
    ranges = _stored(spark, where, "files", known).join(current, "file")
    wanted = spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField("value", kind)])).distinct()
    near = ranges.join(wanted, (F.col("value") >= F.col("lo")) & (F.col("value") <= F.col("hi")))
    at = near.select("file", "path", "value", F.explode(_positions(F.col("value"), F.col("slots"))).alias("at")).withColumn("word", _word(F.col("at")))
    tested = at.join(_stored(spark, where, "words", bloom), ["file", "word"])
    hits = F.count_if(F.col("bits").bitwiseAND(_bit(F.col("at"))) != 0)
    kept = tested.groupBy("path", "value").agg(hits.alias("hits")).where(F.col("hits") == len(SEEDS)).select("path")
    unknown = current.join(ranges.select("file"), "file", "left_anti").select("path")
    return sorted({r["path"] for r in kept.unionByName(unknown).collect()}), len(df.inputFiles())


def lookup(spark: SparkSession, root: str, layer: str, name: str, column: str, values: list) -> DataFrame:
    """The rows with one of the values, read from the files that may hold them."""
    df = read_table(spark, root, layer, name)
    files, _ = files_for(spark, root, layer, name, column, values)
    if not files:
        return df.limit(0)
    base = f"{root}/{layer}/{name}"
    return spark.read.option("basePath", base).parquet(*files).select(*df.columns).where(F.col(column).isin(*values))
