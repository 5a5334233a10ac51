"""Gold: indicators, rankings, profiles and panels built from silver."""

from __future__ import annotations

from pyspark.sql import DataFrame

from strata.functions import BANDS, LEVELS, TOP_SHARE
from strata.operators.clean import band_sums
from strata.operators.measure import (classify, group_stats, join_targets, latest_period,
                                      max_target, rank_within)


def indicador_por_uf_ano(silver_uf: DataFrame, metas: DataFrame) -> DataFrame:
    """Per state, year and grade; ranked per (year, grade) BEFORE places without
    a target are dropped, so ranks may have gaps."""
    base = group_stats(silver_uf, ["ano", "sigla_uf", "nome_uf", "serie"],
                       taxa_media=("mean", "taxa_alfabetizacao"),
                       taxa_min_rede=("min", "taxa_alfabetizacao"),
                       taxa_max_rede=("max", "taxa_alfabetizacao"),
                       media_portugues=("avg", "media_portugues"),
                       qtd_redes=("count_distinct", "rede"))
    ranked = rank_within(base, ["ano", "serie"], "taxa_media", "ranking_nacional")
    return join_targets(ranked, max_target(metas, "uf", "sigla_uf"), "sigla_uf")


def evolucao_temporal_brasil(silver_uf: DataFrame) -> DataFrame:
    out = group_stats(silver_uf, ["ano", "serie"],
                      taxa_media_brasil=("avg", "taxa_alfabetizacao"),
                      taxa_min_estado=("min", "taxa_alfabetizacao"),
                      taxa_max_estado=("max", "taxa_alfabetizacao"),
                      desvio_padrao=("stddev0", "taxa_alfabetizacao"),
                      qtd_estados=("count_distinct", "sigla_uf"))
    return out.orderBy("ano", "serie")


def ranking_estados(silver_uf: DataFrame, metas: DataFrame) -> DataFrame:
    """Each state's own latest year, mean rate, joined with its target, THEN
    ranked (no gaps from places without a target) and classified."""
    # One scan: the latest year is picked among the (few) state and year means.
    means = group_stats(silver_uf, ["sigla_uf", "nome_uf", "ano"], taxa_media=("mean", "taxa_alfabetizacao"))
    base = latest_period(means, "sigla_uf", "ano").drop("ano")
    joined = join_targets(base, max_target(metas, "uf", "sigla_uf"), "sigla_uf")
    ranked = rank_within(joined, [], "taxa_media", "posicao")
    out = classify(ranked, "taxa_media", "classificacao")
    return out.select("posicao", "sigla_uf", "nome_uf", "taxa_media", "meta_2030", "gap_meta",
                      "classificacao").orderBy("posicao")


def perfil_desempenho_uf(silver_uf: DataFrame) -> DataFrame:
    """Silver grain kept; adds the top-level share."""
    out = band_sums(silver_uf, TOP_SHARE)
    return out.select("ano", "sigla_uf", "nome_uf", "serie", "rede", "taxa_alfabetizacao",
                      *LEVELS, *BANDS, *TOP_SHARE)


def painel_municipios(silver_mun: DataFrame, metas: DataFrame) -> DataFrame:
    base = group_stats(silver_mun, ["id_municipio", "nome_municipio", "ano"],
                       taxa_media=("avg", "taxa_alfabetizacao"))
    out = join_targets(base, max_target(metas, "municipio", "id_municipio"), "id_municipio",
                       cast_key=True, reached_col="atingiu_meta")
    return out.select("id_municipio", "nome_municipio", "ano", "taxa_media", "meta_2030",
                      "gap_meta", "atingiu_meta")
