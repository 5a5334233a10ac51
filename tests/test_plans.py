"""Plan checks: broadcast dimensions, no Python UDF, pushed filters, partial
window limit, partition pruning on written tables."""

from pyspark.sql import functions as F

from strata.catalog import QUERIES, Layers
from strata.plans import bronze
from strata.plans.run import read_table, write_table
from tests.conftest import SMOKE


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_dimensions_are_broadcast(spark):
    L = Layers(spark, SMOKE)
    p = plan(bronze.alunos(L.src))
    assert p.count("BroadcastHashJoin") == 6  # directory + five decodes
    assert "SortMergeJoin" not in p


def test_no_python_udf_in_any_query(spark):
    from strata.quality_catalog import QUALITY_QUERIES
    for name, q in {**QUERIES, **QUALITY_QUERIES}.items():
        p = plan(q(spark, SMOKE))
        for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
                     "PythonUDF"):
            assert node not in p, (name, node)


def test_filters_reach_the_scan(spark):
    L = Layers(spark, SMOKE)
    df = L.src["alunos"].where(F.col("ano") == 1998).select("id_aluno")
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_shipdate)" in p
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_shipdate" in p


def test_keep_latest_uses_window_group_limit(spark):
    p = plan(QUERIES["keep_latest_state"](spark, SMOKE))
    assert "WindowGroupLimit" in p


def test_written_table_prunes_partitions(spark, tmp_root):
    L = Layers(spark, SMOKE)
    rows = write_table(spark, L.bronze_alunos, tmp_root, "bronze", "alunos", "t1")
    assert rows == L.src["alunos"].count()
    df = read_table(spark, tmp_root, "bronze", "alunos").where(F.col("ano") == 1998)
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ano" in p and "(ano#" in p
    assert df.count() == L.src["alunos"].where(F.col("ano") == 1998).count()


def test_bucketed_tables_join_without_shuffle(spark, tmp_root):
    from strata.plans.run import save_bucketed
    left = spark.range(2000).select((F.col("id") % 97).alias("id_municipio"), F.col("id").alias("v"))
    right = spark.range(97).select(F.col("id").alias("id_municipio"), (F.col("id") * 2).alias("meta"))
    save_bucketed(left, "strata_test_left", f"{tmp_root}/left", 8, ["id_municipio"])
    save_bucketed(right, "strata_test_right", f"{tmp_root}/right", 8, ["id_municipio"])
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("strata_test_left").join(spark.table("strata_test_right"), "id_municipio")
        p = plan(joined)
        assert "SortMergeJoin" in p and "Exchange" not in p
        assert joined.count() == 2000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_latest_period_scans_once(spark):
    for name in ("latest_period", "gold_state_ranking"):
        p = plan(QUERIES[name](spark, SMOKE))
        assert p.count("orders.parquet") == 1, name


def test_no_nested_loop_join_in_rules(spark):
    from strata.quality_catalog import QUALITY_QUERIES
    for name, q in QUALITY_QUERIES.items():
        assert "NestedLoop" not in plan(q(spark, SMOKE)), name


def test_clustered_files_are_narrow_and_split_a_hot_id(spark, tmp_root):
    """Half of the rows have one id: files of other ids have disjoint ranges, the hot id is in several files."""
    df = spark.range(40_000).select(F.lit(2023).alias("ano"), F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).alias("id_municipio"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_table(spark, df, tmp_root, "bronze", "alfabetizacao_municipio", "t1")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = read_table(spark, tmp_root, "bronze", "alfabetizacao_municipio").groupBy(F.input_file_name()).agg(
        F.min("id_municipio").alias("lo"), F.max("id_municipio").alias("hi")).collect()
    ranges = sorted((r["lo"], r["hi"]) for r in files)
    assert len(ranges) > 3 and all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))
    assert sum(lo <= 7 <= hi for lo, hi in ranges) >= 2


def test_large_tables_are_laid_out_with_one_evaluation(spark):
    """The pupil table's layout reads the microdata twice, once for two columns only, and never samples the whole rows."""
    from strata.plans.run import clustered_once
    out = clustered_once(Layers(spark, SMOKE).bronze_alunos, ["ano", "id_municipio", "serie"])
    p = plan(out)
    assert p.count("lineitem.parquet") == 1 and "rangepartitioning" not in p
    assert out.count() == Layers(spark, SMOKE).src["alunos"].count()


def test_layout_of_null_and_hot_keys(spark):
    from strata.plans.run import clustered_once
    df = spark.range(5000).select(F.when(F.col("id") % 5 == 0, None).otherwise(2020 + F.col("id") % 2).alias("ano"),
                                  F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 3 == 1, 1).otherwise(F.col("id")).alias("k"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = clustered_once(df, ["ano", "k"]).withColumn("p", F.spark_partition_id())
        assert sorted(r["id"] for r in out.collect()) == list(range(5000))
        ranges = out.groupBy("p").agg(F.min(F.struct(F.coalesce("ano", F.lit(0)).alias("a"), F.coalesce("k", F.lit(-1)).alias("k"))).alias("lo"),
                                      F.max(F.struct(F.coalesce("ano", F.lit(0)).alias("a"), F.coalesce("k", F.lit(-1)).alias("k"))).alias("hi"), F.count("*").alias("n")).orderBy("p").collect()
        assert len(ranges) >= 7 and max(r["n"] for r in ranges) < 1500
        assert all(a["hi"] <= b["lo"] for a, b in zip(ranges, ranges[1:]))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert clustered_once(df.limit(0), ["ano", "k"]).collect() == []


def test_both_layouts_write_the_same_table(spark, tmp_root, monkeypatch):
    from strata.plans import run
    rows = Layers(spark, SMOKE).bronze_alunos.drop("ingestao_ts")
    assert 0 < run.scanned_bytes(rows) < 1 << 30
    tables = []
    for place, least in (("small", 1 << 60), ("large", 0)):
        monkeypatch.setattr(run, "ONCE_FROM_BYTES", least)
        assert write_table(spark, rows, f"{tmp_root}/{place}", "bronze", "alunos", "t1") == rows.count()
        tables.append(read_table(spark, f"{tmp_root}/{place}", "bronze", "alunos"))
    assert tables[0].exceptAll(tables[1].select(tables[0].columns)).count() == 0 == tables[1].select(tables[0].columns).exceptAll(tables[0]).count()


def test_ranges_follow_the_rows_not_the_shuffle_partitions(spark, tmp_root, monkeypatch):
    """Larger inputs get more ranges, so a task sorts as much as before; the session has 8 shuffle partitions."""
    from strata.plans import run
    rows = Layers(spark, SMOKE).bronze_alunos
    monkeypatch.setattr(run, "BYTES_PER_RANGE", run.scanned_bytes(rows) // 20)
    n = write_table(spark, rows, f"{tmp_root}/sampled", "bronze", "alunos", "t1")
    table = read_table(spark, f"{tmp_root}/sampled", "bronze", "alunos")
    tasks = table.groupBy(F.regexp_extract(F.input_file_name(), "part-([0-9]+)", 1).alias("task")).agg(F.count("*").alias("n")).collect()
    assert len(tasks) > 12 and sum(r["n"] for r in tasks) == n and max(r["n"] for r in tasks) < n / 5
    monkeypatch.setattr(run, "ROWS_PER_RANGE", 100)
    df = spark.range(5000).select((F.col("id") % 2).alias("ano"), (F.col("id") % 400).alias("k"), "id")
    for keys in (1000, 100):  # by counts, and sampled since there are more values
        monkeypatch.setattr(run, "MOST_KEYS", keys)
        out = run.clustered_once(df, ["ano", "k"]).withColumn("p", F.spark_partition_id())
        assert out.groupBy("p").count().count() >= 45 and out.select("id").distinct().count() == 5000


def test_municipality_rows_are_dealt_out_before_they_are_summed_up(spark):
    """One exchange, below both aggregates: no scan task holds partial sums of nearly as many groups as it has rows."""
    src = Layers(spark, SMOKE).src["municipio"]
    p = plan(src)
    assert p.count("Exchange") == 1 and "REPARTITION_BY_COL" in p
    assert max(p.index("HashAggregate"), p.rindex("HashAggregate")) < p.index("Exchange")
