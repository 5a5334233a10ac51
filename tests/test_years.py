"""Runs for some years: one year's files are written, reads give all, versions mix folders of many runs."""

import os

import pytest
from pyspark.sql import functions as F

from strata.plans.run import ConcurrentWrite, expire, parts, read_table, run, versions, write_table, write_years
from strata.sources import testviews as tv
from tests.conftest import SMOKE

TABLE = ("bronze", "alunos")


def frame(spark, years, tag, n=4):
    return spark.range(n).crossJoin(spark.createDataFrame([(y,) for y in years], "ano long")).select(
        "ano", F.col("id").alias("id_municipio"), F.lit(1).alias("serie"), F.lit(tag).alias("tag"))


def held(spark, root):
    return sorted((r["ano"], r["tag"], r["n"]) for r in read_table(spark, root, *TABLE).groupBy("ano", "tag").agg(F.count("*").alias("n")).collect())


def test_one_year_is_written_and_all_are_read(spark, tmp_root):
    write_table(spark, frame(spark, [2020, 2021, 2022], "a"), tmp_root, *TABLE, "r1")
    assert write_years(spark, frame(spark, [2020, 2021, 2022], "b"), tmp_root, *TABLE, "r2", [2021]) == 4
    assert [d for d in os.listdir(f"{tmp_root}/bronze/alunos/run=r2") if "=" in d] == ["ano=2021"]
    assert held(spark, tmp_root) == [(2020, "a", 4), (2021, "b", 4), (2022, "a", 4)]
    # On top of a mixed version: a year that is new, and one that has no rows any more.
    write_years(spark, frame(spark, [2023], "c"), tmp_root, *TABLE, "r3", [2020, 2023])
    assert held(spark, tmp_root) == [(2021, "b", 4), (2022, "a", 4), (2023, "c", 4)]
    assert parts(spark, tmp_root, *TABLE) == {"ano=2021": "r2", "ano=2022": "r1", "ano=2023": "r3"}
    plan = read_table(spark, tmp_root, *TABLE).where("ano = 2022")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ano" in plan
    assert len(read_table(spark, tmp_root, *TABLE).where("ano = 2022").inputFiles()) >= 1
    # A whole write ends the mixture.
    write_table(spark, frame(spark, [2030], "d"), tmp_root, *TABLE, "r4")
    assert held(spark, tmp_root) == [(2030, "d", 4)]


def test_years_of_a_table_that_was_never_written_and_of_no_rows(spark, tmp_root):
    assert parts(spark, tmp_root, *TABLE) == {}
    assert write_years(spark, frame(spark, [2020], "a"), tmp_root, *TABLE, "r1", [1999]) == 0
    empty = read_table(spark, tmp_root, *TABLE)
    assert empty.count() == 0 and "tag" in empty.columns
    write_years(spark, frame(spark, [2020], "a"), tmp_root, *TABLE, "r2", [2020])
    assert held(spark, tmp_root) == [(2020, "a", 4)]


def test_expire_keeps_what_a_version_names(spark, tmp_root):
    write_table(spark, frame(spark, [2020, 2021], "a"), tmp_root, *TABLE, "r1")
    write_table(spark, frame(spark, [2020, 2021], "b"), tmp_root, *TABLE, "r2")
    write_years(spark, frame(spark, [2021], "c"), tmp_root, *TABLE, "r3", [2021])
    assert expire(spark, tmp_root, *TABLE, 1) == ["r1", "r2"]
    assert versions(spark, tmp_root, *TABLE) == ["r3"]
    assert sorted(d for d in os.listdir(f"{tmp_root}/bronze/alunos") if d.startswith("run=")) == ["run=r2", "run=r3"]
    assert held(spark, tmp_root) == [(2020, "b", 4), (2021, "c", 4)]


def test_another_version_meanwhile_is_an_error(spark, tmp_root, monkeypatch):
    from strata.plans import run as module
    write_table(spark, frame(spark, [2020], "a"), tmp_root, *TABLE, "r1")
    plain = module._write_rows

    def slow(df, root, layer, name, run_id):
        n = plain(df, root, layer, name, run_id)
        monkeypatch.setattr(module, "_write_rows", plain)
        write_table(spark, frame(spark, [2020, 2021], "other"), tmp_root, *TABLE, "r2")
        return n

    monkeypatch.setattr(module, "_write_rows", slow)
    with pytest.raises(ConcurrentWrite):
        write_years(spark, frame(spark, [2020], "mine"), tmp_root, *TABLE, "r3", [2020])
    assert held(spark, tmp_root) == [(2020, "other", 4), (2021, "other", 4)]


def test_run_for_one_year(spark, tmp_root):
    src = tv.sources(spark, SMOKE)
    damaged = dict(src)
    damaged["alunos"] = src["alunos"].where("ano <> 1996 OR serie = 65")
    damaged["municipio"] = src["municipio"].where("ano <> 1996")
    run(spark, damaged, tmp_root, layers=("bronze", "silver"))
    one = run(spark, src, tmp_root, layers=("bronze", "silver", "gold"), years=[1996])
    assert one["bronze"]["alunos"]["rows"] == src["alunos"].where("ano = 1996").count()
    other = f"{tmp_root}-whole"
    run(spark, src, other, layers=("bronze", "silver", "gold"))
    for layer, name in [("bronze", "alunos"), ("bronze", "alfabetizacao_municipio"), ("silver", "alunos_clean"), ("silver", "alfabetizacao_municipio_clean"), ("gold", "painel_municipios")]:
        a, b = (read_table(spark, r, layer, name).drop("ingestao_ts", "silver_processado_ts") for r in (tmp_root, other))
        # Means of doubles depend on the order of addition in their last places.
        a, b = (df.select(*[F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in a.dtypes]) for df in (a, b))
        assert a.exceptAll(b.select(a.columns)).count() == 0 and a.count() == b.count(), name
    written = {v for v in parts(spark, tmp_root, "silver", "alunos_clean").values()}
    assert len(written) == 2
