"""Registered queries: one per operator / table of the inventory.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
test tables.  ``present`` is the last step of every entry: it drops the
run-time audit timestamps (not comparable between runs), rounds DOUBLE
columns to 6 places and writes TIMESTAMP_NTZ columns as fixed-format text, so
that results compare across engines.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions import BANDS, TOP_SHARE
from strata.operators.clean import band_sums, keep_latest, normalise_code, require
from strata.operators.combine import stack_scopes
from strata.operators.enrich import decode_columns, lookup_name
from strata.operators.measure import (classify, group_stats, join_targets, latest_period, latest_period_split,
                                      max_target, rank_all, rank_within)
from strata.operators.reshape import melt_sparse
from strata.plans import bronze, gold, silver
from strata.schemas import EVENT_METRICS
from strata.sources import testviews as tv

RUNTIME_COLUMNS = ("ingestao_ts", "silver_processado_ts")
TS_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def present(df: DataFrame, drop=RUNTIME_COLUMNS) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if f.name in drop:
            continue
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.round(F.col(f.name), 6).alias(f.name))
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            cols.append(F.col(f.name).cast("long").alias(f.name))
        elif isinstance(f.dataType, T.TimestampNTZType):
            # Wall-clock text: same in every engine and client, whatever the
            # session time zone or the client's time unit.
            cols.append(F.date_format(F.col(f.name), TS_TEXT).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


class Layers:
    """Lazily built sources and layer tables for one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    @cached_property
    def src(self) -> dict[str, DataFrame]:
        return tv.sources(self.spark, self.sf_dir)

    @cached_property
    def bronze_uf(self):
        return bronze.alfabetizacao_uf(self.src)

    @cached_property
    def bronze_municipio(self):
        return bronze.alfabetizacao_municipio(self.src)

    @cached_property
    def bronze_alunos(self):
        return bronze.alunos(self.src)

    @cached_property
    def bronze_meta_brasil(self):
        return bronze.meta_brasil(self.src)

    @cached_property
    def bronze_meta_uf(self):
        return bronze.meta_uf(self.src)

    @cached_property
    def bronze_meta_municipio(self):
        return bronze.meta_municipio(self.src)

    @cached_property
    def bronze_events(self):
        return tv.bronze_events_view(self.spark, self.sf_dir)

    @cached_property
    def silver_uf(self):
        return silver.alfabetizacao_uf_clean(self.bronze_uf)

    @cached_property
    def silver_municipio(self):
        return silver.alfabetizacao_municipio_clean(self.bronze_municipio)

    @cached_property
    def silver_metas(self):
        return silver.metas_consolidadas(self.bronze_meta_brasil, self.bronze_meta_uf,
                                         self.bronze_meta_municipio)

    @cached_property
    def silver_alunos(self):
        return silver.alunos_clean(self.bronze_alunos)

    @cached_property
    def silver_events(self):
        return silver.streaming_eventos_clean(self.bronze_events)

    def metas_max(self, scope: str, key: str) -> DataFrame:
        return max_target(self.silver_metas, scope, key)


def _q(build):
    """Wrap ``build(layers) -> DataFrame`` as a ``(spark, sf_dir) -> DataFrame`` entry."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return present(build(Layers(spark, sf_dir)))
    run.__name__ = build.__name__
    run.__doc__ = build.__doc__
    return run


_EVENT_VALID = dict(not_null=["tipo", "timestamp", "sigla_uf", "pubsub_message_id"],
                    null_or_within={"taxa_alfabetizacao": silver.RATE_RANGE})


def _state_means(L: Layers, keys: list[str]) -> DataFrame:
    return group_stats(L.silver_uf, keys, taxa_media=("mean", "taxa_alfabetizacao"))


def _municipality_targets(L: Layers, keys: list[str], reached: str | None = None) -> DataFrame:
    base = group_stats(L.silver_municipio, keys, taxa_media=("avg", "taxa_alfabetizacao"))
    return join_targets(base, L.metas_max("municipio", "id_municipio"), "id_municipio",
                        cast_key=True, reached_col=reached)


BUILDS = {
    # ---- enrich ----
    "decode_two_columns": lambda L: decode_columns(
        L.src["municipio"], L.src["dicionario"], "municipio", ["serie", "rede"]).select(
        "ano", "id_municipio", "serie_codigo", "rede_codigo", "serie", "rede", "taxa_alfabetizacao"),
    "decode_five_columns": lambda L: decode_columns(
        L.src["alunos"], L.src["dicionario"], "alunos", bronze.PUPIL_CODES).select(
        "id_aluno", "ano", *[c + "_codigo" for c in bronze.PUPIL_CODES], *bronze.PUPIL_CODES),
    "lookup_state_name": lambda L: lookup_name(
        L.src["meta_uf"], L.src["dir_uf"], "sigla_uf", "sigla", "nome", "nome_uf").select(
        "ano", "sigla_uf", "rede", "nome_uf"),
    "lookup_municipality_cast": lambda L: lookup_name(
        L.src["municipio"], L.src["dir_municipio"], "id_municipio", "id_municipio", "nome",
        "nome_municipio", cast_key=True).select("ano", "id_municipio", "serie", "rede", "nome_municipio"),
    "rename_codes": lambda L: L.bronze_uf.select(
        "ano", "sigla_uf", "nome_uf", "serie_codigo", "rede_codigo", "serie", "rede"),
    # ---- clean ----
    "require_not_null": lambda L: require(
        L.bronze_meta_uf, not_null=["sigla_uf", "nome_uf", *silver.COMPLETE_TARGET_COLUMNS]).select(
        "ano", "sigla_uf", "nome_uf", "rede", "meta_alfabetizacao_2030"),
    "rate_in_range": lambda L: require(
        L.bronze_municipio, not_null=["taxa_alfabetizacao"],
        within={"taxa_alfabetizacao": silver.RATE_RANGE}).select(
        "ano", "id_municipio", "serie_codigo", "rede_codigo", "taxa_alfabetizacao"),
    "sparse_rate_range": lambda L: require(
        L.bronze_events, null_or_within={"taxa_alfabetizacao": silver.RATE_RANGE}).select(
        "pubsub_message_id", "tipo", "taxa_alfabetizacao", "taxa_revisada"),
    "present_pupils": lambda L: require(L.bronze_alunos, equals={"presenca": "Presente"}).select(
        "id_aluno", "ano", "id_municipio", "presenca", "proficiencia"),
    "keep_latest_state": lambda L: L.silver_uf.select(
        "ano", "sigla_uf", "serie", "rede", "taxa_alfabetizacao", "media_portugues"),
    "keep_latest_event": lambda L: keep_latest(
        require(L.bronze_events, **_EVENT_VALID), ["pubsub_message_id"], "ingestao_ts").select(
        "pubsub_message_id", "tipo", "sigla_uf", "taxa_alfabetizacao", "meta_2030",
        "taxa_anterior", "taxa_revisada", "motivo_revisao"),
    "normalise_code": lambda L: normalise_code(L.bronze_uf, "sigla_uf", "sigla_uf_norm").select(
        "sigla_uf", "sigla_uf_norm").distinct(),
    "level_bands": lambda L: L.silver_municipio.select("ano", "id_municipio", "serie", "rede", *BANDS),
    # ---- combine ----
    "stack_scopes": lambda L: stack_scopes(
        {s: L.src[f"meta_{s}"] for s in ("brasil", "uf", "municipio")},
        [("ano", "long"), ("sigla_uf", "string"), ("id_municipio", "string"), ("rede", "string"),
         ("meta_alfabetizacao_2030", "double"), ("escopo", "string")]),
    "melt_event_metrics": lambda L: melt_sparse(
        tv.event_deliveries(L.spark, L.sf_dir), ["pubsub_message_id", "tipo", "delivery"], EVENT_METRICS),
    # ---- aggregate ----
    "group_avg_min_max": lambda L: group_stats(
        L.silver_uf, ["ano", "sigla_uf", "nome_uf", "serie"],
        taxa_media=("avg", "taxa_alfabetizacao"), taxa_min_rede=("min", "taxa_alfabetizacao"),
        taxa_max_rede=("max", "taxa_alfabetizacao")),
    "distinct_count": lambda L: group_stats(
        L.silver_uf, ["ano", "serie"], qtd_estados=("count_distinct", "sigla_uf"),
        qtd_redes=("count_distinct", "rede")),
    "stddev_or_zero": lambda L: group_stats(
        L.silver_uf, ["ano", "sigla_uf", "serie"], desvio_padrao=("stddev0", "taxa_alfabetizacao")),
    "max_target": lambda L: L.metas_max("uf", "sigla_uf"),
    "distinct_dimension": lambda L: tv.doubled(tv.table(L.spark, L.sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("id_municipio"), F.col("s_name").alias("nome"))).distinct(),
    # ---- join ----
    "inner_targets": lambda L: join_targets(
        _state_means(L, ["sigla_uf", "ano"]), L.metas_max("uf", "sigla_uf"), "sigla_uf"),
    "inner_targets_cast": lambda L: _municipality_targets(L, ["id_municipio", "serie"]),
    "latest_period": lambda L: latest_period(L.silver_uf, "sigla_uf", "ano").select(
        "sigla_uf", "ano", "serie", "rede", "taxa_alfabetizacao"),
    "latest_period_split": lambda L: latest_period_split(L.silver_uf, "sigla_uf", "ano").select(
        "sigla_uf", "ano", "serie", "rede", "taxa_alfabetizacao"),
    "orphan_keys": lambda L: L.silver_uf.join(
        L.silver_metas.where(F.col("escopo") == "uf").select("sigla_uf").distinct(),
        "sigla_uf", "left_anti").select("ano", "sigla_uf", "serie", "rede"),
    # ---- window ----
    "rank_within_year": lambda L: rank_within(
        _state_means(L, ["ano", "serie", "sigla_uf", "nome_uf"]), ["ano", "serie"], "taxa_media",
        "ranking_nacional"),
    "rank_all": lambda L: rank_all(_state_means(L, ["sigla_uf"]), "taxa_media", "posicao"),
    # ---- scalar ----
    "target_gap": lambda L: _municipality_targets(L, ["id_municipio", "ano"]).select(
        "id_municipio", "ano", "gap_meta"),
    "target_reached": lambda L: _municipality_targets(L, ["id_municipio", "ano"], "atingiu_meta").select(
        "id_municipio", "ano", "atingiu_meta"),
    "classify_rate": lambda L: classify(L.silver_uf, "taxa_alfabetizacao", "classificacao").select(
        "ano", "sigla_uf", "serie", "rede", "taxa_alfabetizacao", "classificacao"),
    "top_share": lambda L: band_sums(L.silver_uf, TOP_SHARE).select(
        "ano", "sigla_uf", "serie", "rede", *TOP_SHARE),
    # ---- tables ----
    "silver_state": lambda L: L.silver_uf,
    "silver_targets": lambda L: L.silver_metas,
    "silver_municipality": lambda L: L.silver_municipio,
    "silver_pupils": lambda L: L.silver_alunos,
    "silver_events": lambda L: L.silver_events,
    "gold_state_year": lambda L: gold.indicador_por_uf_ano(L.silver_uf, L.silver_metas),
    "gold_evolution": lambda L: gold.evolucao_temporal_brasil(L.silver_uf),
    "gold_state_ranking": lambda L: gold.ranking_estados(L.silver_uf, L.silver_metas),
    "gold_profile": lambda L: gold.perfil_desempenho_uf(L.silver_uf),
    "gold_municipality": lambda L: gold.painel_municipios(L.silver_municipio, L.silver_metas),
    "bronze_state": lambda L: L.bronze_uf,
    "bronze_municipality": lambda L: L.bronze_municipio,
    "bronze_pupils": lambda L: L.bronze_alunos,
    "bronze_target_country": lambda L: L.bronze_meta_brasil,
    "bronze_target_state": lambda L: L.bronze_meta_uf,
    "bronze_target_municipality": lambda L: L.bronze_meta_municipio,
}


def _named(name, fn):
    fn.__name__ = name
    return _q(fn)


QUERIES = {name: _named(name, fn) for name, fn in BUILDS.items()}
