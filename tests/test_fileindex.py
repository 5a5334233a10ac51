"""The file index: same rows as a scan, few files, old and missing indexes, values of several types."""

import pytest
from pyspark.sql import functions as F

from strata.plans.fileindex import files_for, index_column, lookup
from strata.plans.run import read_table, write_table, write_years

TABLE = ("bronze", "alunos")


def frame(spark, lo, hi, years=(2020, 2021)):
    ids = spark.range(lo, hi).select(F.col("id").alias("id_aluno"), (F.col("id") % 97).alias("id_municipio"), F.lit(1).alias("serie"),
                                     F.when(F.col("id") % 50 == 0, None).otherwise(F.concat(F.lit("k"), F.sha1(F.col("id").cast("string")))).alias("name"))
    return ids.crossJoin(spark.createDataFrame([(y,) for y in years], "ano long"))


@pytest.mark.parametrize("column", ["id_aluno", "name"])
def test_lookup_equals_scan_and_prunes(spark, tmp_root, column):
    write_table(spark, frame(spark, 0, 4000), tmp_root, *TABLE, "r1", max_records=100)
    whole = read_table(spark, tmp_root, *TABLE)
    n = len(whole.inputFiles())
    assert files_for(spark, tmp_root, *TABLE, column, [whole.first()[column]])[0] == sorted(whole.inputFiles())  # no index yet
    assert index_column(spark, tmp_root, *TABLE, column) == n and index_column(spark, tmp_root, *TABLE, column) == 0
    values = [r[column] for r in whole.where(f"{column} IS NOT NULL").orderBy(F.xxhash64("id_aluno")).limit(3).collect()]
    got = lookup(spark, tmp_root, *TABLE, column, values)
    want = whole.where(F.col(column).isin(*values))
    assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect())) and got.count() >= 2
    kept, total = files_for(spark, tmp_root, *TABLE, column, values[:1])
    assert total == n >= 60 and len(kept) <= 0.1 * n
    missing = 10_000 if column == "id_aluno" else "nobody"
    assert len(files_for(spark, tmp_root, *TABLE, column, [missing])[0]) <= 0.02 * n
    assert lookup(spark, tmp_root, *TABLE, column, [missing]).collect() == []


def test_new_files_are_kept_until_they_are_indexed(spark, tmp_root):
    write_table(spark, frame(spark, 0, 500), tmp_root, *TABLE, "r1", max_records=50)
    index_column(spark, tmp_root, *TABLE, "id_aluno")
    write_years(spark, frame(spark, 400, 900), tmp_root, *TABLE, "r2", [2021])
    assert sorted(r["ano"] for r in lookup(spark, tmp_root, *TABLE, "id_aluno", [450]).collect()) == [2020, 2021]
    assert [r["ano"] for r in lookup(spark, tmp_root, *TABLE, "id_aluno", [30]).collect()] == [2020]
    new = index_column(spark, tmp_root, *TABLE, "id_aluno")
    assert 0 < new < len(read_table(spark, tmp_root, *TABLE).inputFiles())
    assert sorted(r["ano"] for r in lookup(spark, tmp_root, *TABLE, "id_aluno", [450]).collect()) == [2020, 2021]
    assert [r["ano"] for r in lookup(spark, tmp_root, *TABLE, "id_aluno", [30]).collect()] == [2020]


def test_an_index_is_built_without_sorting_rows(spark):
    """Ranges and filter words are hash aggregates, for text columns too: a task holds no sorted copy of its rows."""
    from strata.plans import fileindex
    rows = spark.range(1000).select(F.sha1(F.col("id").cast("string")).alias("value"), (F.col("id") % 7).cast("string").alias("file"))
    ranges = fileindex._ranges(rows)
    files = ranges.withColumn("no", F.col("file").cast("long"))
    for df in (ranges, fileindex._words(rows, F.broadcast(files))):
        p = df._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate" not in p and "Sort [" not in p and "HashAggregate" in p
    want = {r["file"]: (r["lo"], r["hi"]) for r in rows.groupBy("file").agg(F.min("value").alias("lo"), F.max("value").alias("hi")).collect()}
    assert {r["file"]: (r["lo"], r["hi"]) for r in ranges.collect()} == want
    bits = fileindex._words(rows, files).agg(F.sum(F.bit_count("bits"))).first()[0]
    assert 0.97 * 3000 < bits <= 3000


def test_a_value_looked_up_twice(spark, tmp_root):
    write_table(spark, frame(spark, 0, 500), tmp_root, *TABLE, "r1", max_records=50)
    index_column(spark, tmp_root, *TABLE, "id_aluno")
    assert sorted(r["ano"] for r in lookup(spark, tmp_root, *TABLE, "id_aluno", [450, 450]).collect()) == [2020, 2021]
