"""Operator unit tests on small literal frames with the edge rows of FIXTURES.md."""

from datetime import datetime

from pyspark.sql import functions as F

from strata.functions import LEVELS
from strata.operators.clean import band_sums, keep_latest, normalise_code, require
from strata.operators.combine import stack_scopes
from strata.operators.enrich import decode_columns, lookup_name
from strata.operators.measure import (classify, group_stats, join_targets, latest_period,
                                      rank_all, rank_within)
from strata.operators.reshape import melt_sparse


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_rate_range_inclusive(spark):
    df = spark.createDataFrame([(1, None), (2, -0.01), (3, 0.0), (4, 100.0), (5, 100.01)],
                               "id int, taxa double")
    out = require(df, not_null=["taxa"], within={"taxa": (0, 100)})
    assert rows(out, "id") == [(3,), (4,)]


def test_sparse_rate_null_passes(spark):
    df = spark.createDataFrame([(1, None), (2, 250.0), (3, 50.0)], "id int, taxa double")
    out = require(df, null_or_within={"taxa": (0, 100)})
    assert rows(out, "id") == [(1,), (3,)]


def test_filter_before_keep_latest(spark):
    t1, t2 = datetime(2024, 1, 1), datetime(2024, 1, 2)
    df = spark.createDataFrame([("k", t1, 50.0), ("k", t2, 150.0)], "k string, ts timestamp, taxa double")
    out = keep_latest(require(df, within={"taxa": (0, 100)}), ["k"], "ts")
    assert rows(out, "taxa") == [(50.0,)]


def test_keep_latest_later_wins_and_ties_are_stable(spark):
    t1, t2 = datetime(2024, 1, 1), datetime(2024, 1, 2)
    df = spark.createDataFrame(
        [("m", t1, 1.0), ("m", t2, 2.0), ("n", t1, 5.0), ("n", t1, 7.0), ("n", t1, None)],
        "k string, ts timestamp, v double")
    out = keep_latest(df, ["k"], "ts")
    assert rows(out, "k", "v") == [("m", 2.0), ("n", 7.0)]


def test_keep_latest_plans_partial_group_limit(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("ts"))
    plan = keep_latest(df, ["k"], "ts")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_decode_missing_code_and_doubled_key(spark):
    facts = spark.createDataFrame([(1, 10), (2, 20), (3, 30)], "id int, serie int")
    dictionary = spark.createDataFrame(
        [("t", "serie", "10", "ten"), ("t", "serie", "20", "twenty"), ("t", "serie", "20", "vinte"),
         ("x", "serie", "30", "other table")],
        "id_tabela string, nome_coluna string, chave string, valor string")
    out = decode_columns(facts, dictionary, "t", ["serie"])
    assert rows(out, "id", "serie_codigo", "serie") == [
        (1, 10, "ten"), (2, 20, "twenty"), (2, 20, "vinte"), (3, 30, None)]


def test_lookup_distinct_directory_and_text_keys(spark):
    facts = spark.createDataFrame([(12,), (7,), (5,)], "id long")
    directory = spark.createDataFrame(
        [("0012", "padded"), ("7", "seven"), ("7", "seven"), ("5", "five"), ("5", "cinco")],
        "code string, nome string")
    out = lookup_name(facts, directory, "id", "code", "nome", "name", cast_key=True)
    assert rows(out, "id", "name") == [(5, "cinco"), (5, "five"), (7, "seven"), (12, None)]


def test_band_null_propagates(spark):
    vals = [10.0] * 9
    vals[4] = None
    df = spark.createDataFrame([tuple(vals)], ", ".join(f"{c} double" for c in LEVELS))
    out = band_sums(df, {"low": LEVELS[0:2], "high": LEVELS[4:9]}).collect()[0]
    assert out["low"] == 20.0 and out["high"] is None


def test_normalise_trims_blanks_only(spark):
    df = spark.createDataFrame([(" sp ",), ("\tsp",)], "c string")
    out = normalise_code(df, "c", "n")
    assert rows(out, "n") == [("\tSP",), ("SP",)]


def test_classify_cut_offs(spark):
    df = spark.createDataFrame([(89.99,), (90.0,), (74.99,), (75.0,)], "m double")
    out = {r.m: r.c for r in classify(df, "m", "c").collect()}
    assert out == {89.99: "Médio", 90.0: "Alto", 74.99: "Requer atenção", 75.0: "Médio"}


def test_stddev_single_row_is_zero(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 1.0), ("b", 3.0)], "g string, v double")
    out = group_stats(df, ["g"], sd=("stddev0", "v"), n=("count_distinct", "v"))
    got = {r.g: (round(r.sd, 6), r.n) for r in out.collect()}
    assert got == {"a": (0.0, 1), "b": (round(2 ** 0.5, 6), 2)}


def test_rank_ties_share_and_skip(spark):
    df = spark.createDataFrame([("x", "a", 90.0), ("x", "b", 90.0), ("x", "c", 80.0), ("y", "d", 1.0)],
                               "p string, s string, m double")
    out = rank_within(df, ["p"], "m", "r")
    assert rows(out, "s", "r") == [("a", 1), ("b", 1), ("c", 3), ("d", 1)]


def test_rank_all_small_and_distributed_agree(spark):
    data = [(f"s{i}", float(i % 7) if i % 11 else None) for i in range(60)]
    df = spark.createDataFrame(data, "s string, m double")
    small = rows(rank_within(df, [], "m", "r"), "s", "r")
    spread = rows(rank_all(df.repartition(4), "m", "r"), "s", "r")
    assert small == spread
    ranks = dict(small)
    # 6 is the largest value (8 rows hold it): rank 1; NULLs rank last.
    assert ranks["s6"] == 1 and ranks["s11"] == 55


def test_latest_period_is_per_key(spark):
    df = spark.createDataFrame([("A", 2021, 1.0), ("A", 2023, 2.0), ("B", 2022, 3.0), ("B", 2021, 4.0)],
                               "k string, ano int, v double")
    assert rows(latest_period(df, "k", "ano"), "k", "ano") == [("A", 2023), ("B", 2022)]


def test_targets_gap_and_reached(spark):
    facts = spark.createDataFrame([("1", 80.0), ("2", 70.0), ("3", 60.0)], "id string, taxa_media double")
    targets = spark.createDataFrame([("1", 80.0), ("2", 75.0)], "id string, meta_2030 double")
    out = join_targets(facts, targets, "id", reached_col="ok")
    assert rows(out, "id", "gap_meta", "ok") == [("1", 0.0, True), ("2", -5.0, False)]


def test_stack_scopes_typed_nulls(spark):
    a = spark.createDataFrame([(2023, "x")], "ano long, rede string")
    b = spark.createDataFrame([(2024, "y", 5)], "ano long, rede string, id_municipio long")
    out = stack_scopes({"brasil": a, "municipio": b},
                       [("ano", "long"), ("rede", "string"), ("id_municipio", "string"), ("escopo", "string")])
    assert dict(out.dtypes)["id_municipio"] == "string"
    assert rows(out, "escopo", "id_municipio") == [("brasil", None), ("municipio", "5")]


def test_melt_drops_null_metrics(spark):
    df = spark.createDataFrame([("e1", 1.5, None, "why"), ("e2", None, None, None)],
                               "id string, a double, b double, c string")
    out = melt_sparse(df, ["id"], ["a", "b", "c"])
    assert rows(out, "id", "metrica", "valor") == [("e1", "a", "1.5"), ("e1", "c", "why")]


def test_gold_rank_before_and_after_target_join(spark):
    from strata.plans import gold
    silver_uf = spark.createDataFrame(
        [(2023, "AA", "Na", "s", "r", 95.0, 700.0), (2023, "BB", "Nb", "s", "r", 80.0, 700.0)],
        "ano long, sigla_uf string, nome_uf string, serie string, rede string, "
        "taxa_alfabetizacao double, media_portugues double")
    metas = spark.createDataFrame([("uf", "BB", 85.0)], "escopo string, sigla_uf string, meta_alfabetizacao_2030 double")
    ind = gold.indicador_por_uf_ano(silver_uf, metas).collect()
    assert [(r.sigla_uf, r.ranking_nacional) for r in ind] == [("BB", 2)]
    rk = gold.ranking_estados(silver_uf, metas).collect()
    assert [(r.sigla_uf, r.posicao, r.classificacao) for r in rk] == [("BB", 1, "Médio")]


def test_rank_within_matches_window_rank(spark):
    from pyspark.sql import Window
    data = [(f"g{i % 3}" if i % 17 else None, float((i * 7) % 5) if i % 13 else None, i) for i in range(200)]
    df = spark.createDataFrame(data, "g string, v double, id int")
    ours = rows(rank_within(df, ["g"], "v", "r"), "id", "r")
    w = Window.partitionBy("g").orderBy(F.col("v").desc_nulls_last())
    ref = rows(df.withColumn("r", F.rank().over(w)), "id", "r")
    assert ours == ref


def test_keep_latest_skips_map_columns(spark):
    df = spark.createDataFrame([("k", 1, {"a": 1}), ("k", 1, {"b": 2})], "k string, ts int, m map<string,int>")
    assert keep_latest(df, ["k"], "ts").count() == 1


def test_present_pupils_only(spark):
    df = spark.createDataFrame([(1, "Presente"), (2, "Ausente"), (3, None)], "id int, presenca string")
    assert rows(require(df, equals={"presenca": "Presente"}), "id") == [(1,)]


def test_ranks_use_the_value_not_a_rounding(spark):
    from strata.operators.measure import rank_all, rank_within
    df = spark.createDataFrame([("a", 50.0000000001), ("b", 50.0), ("c", 50.0), ("d", None)], "s string, m double")
    for out in (rank_within(df, [], "m", "r"), rank_all(df, "m", "r")):
        assert {r.s: r.r for r in out.collect()} == {"a": 1, "b": 2, "c": 2, "d": 4}


def test_whole_number_codes_are_joined_as_numbers(spark):
    """Codes match the dictionary's text exactly, for every kind of number, and no text is made of a whole number to be joined."""
    keys = ["1", "01", "+1", " 1", "1.0", "-0", "0", "-7", "7", "7", "x", None, "9223372036854775807", "9223372036854775808"]
    dictionary = spark.createDataFrame([("t", "c", k, f"{i}:{k}") for i, k in enumerate(keys)], "id_tabela string, nome_coluna string, chave string, valor string")
    codes = [1, 0, -7, 7, 5, None, 9223372036854775807]
    want = [(-7, "7:-7"), (0, "6:0"), (1, "0:1"), (5, None), (7, "8:7"), (7, "9:7"), (9223372036854775807, "12:9223372036854775807")]
    directory = dictionary.select(F.col("chave").alias("k"), F.col("valor").alias("name"))
    for kind in ("long", "int", "string"):
        df = spark.createDataFrame([(None if c is None else str(c),) for c in codes], "c string").select(F.col("c").try_cast(kind).alias("c"))
        rows = [r for r in want if kind != "int" or r[0] < 2 ** 31] + [(None, None)] * (2 if kind == "int" else 1)
        decoded, named = decode_columns(df, dictionary, "t", ["c"]), lookup_name(df, directory, "c", "k", "name", "label", cast_key=True)
        for out, label in ((decoded.select(F.col("c_codigo").cast("string").alias("c"), F.col("c").alias("label")), "decoded"), (named.select(F.col("c").cast("string").alias("c"), "label"), "named")):
            assert sorted(map(str, map(tuple, out.collect()))) == sorted(str((None if a is None else str(a), b)) for a, b in rows), (kind, label)
        if kind != "string":
            for out in (decoded, named):
                joins = [x for x in out._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Join LeftOuter" in x]
                assert joins and not any("as string" in x for x in joins)
