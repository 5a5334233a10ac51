"""Registered data-quality queries: rule subsets evaluated over the layers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from strata.catalog import Layers, present
from strata.plans import gold, silver
from strata.plans.quality import Rule, evaluate, rules_for
from strata.session import scratch_dir


class LayerTables(Mapping):
    """(layer, table) -> DataFrame, built on first use.

    With ``materialize`` every table is written under the session's checkpoint
    directory when first built, and rules and later layers read that copy:
    each table is computed once however many rules read it.  (The layer runner
    writes real tables; this is for one-off reports over the views.)
    """

    def __init__(self, L: Layers, materialize: bool = False):
        self.materialize = materialize
        self.spark = L.spark
        t = self.__getitem__
        self._builders = {
            ("source", "dicionario"): lambda: L.src["dicionario"],
            ("bronze", "alfabetizacao_uf"): lambda: L.bronze_uf,
            ("bronze", "meta_brasil"): lambda: L.bronze_meta_brasil,
            ("bronze", "meta_uf"): lambda: L.bronze_meta_uf,
            ("bronze", "meta_municipio"): lambda: L.bronze_meta_municipio,
            ("bronze", "alfabetizacao_municipio"): lambda: L.bronze_municipio,
            ("bronze", "alunos"): lambda: L.bronze_alunos,
            ("silver", "alfabetizacao_uf_clean"): lambda: silver.alfabetizacao_uf_clean(
                t(("bronze", "alfabetizacao_uf"))),
            ("silver", "metas_consolidadas"): lambda: silver.metas_consolidadas(
                t(("bronze", "meta_brasil")), t(("bronze", "meta_uf")), t(("bronze", "meta_municipio"))),
            ("silver", "alfabetizacao_municipio_clean"): lambda: silver.alfabetizacao_municipio_clean(
                t(("bronze", "alfabetizacao_municipio"))),
            ("silver", "alunos_clean"): lambda: silver.alunos_clean(t(("bronze", "alunos"))),
            ("silver", "streaming_eventos_clean"): lambda: silver.streaming_eventos_clean(L.bronze_events),
            ("gold", "indicador_por_uf_ano"): lambda: gold.indicador_por_uf_ano(
                t(("silver", "alfabetizacao_uf_clean")), t(("silver", "metas_consolidadas"))),
            ("gold", "evolucao_temporal_brasil"): lambda: gold.evolucao_temporal_brasil(
                t(("silver", "alfabetizacao_uf_clean"))),
            ("gold", "ranking_estados"): lambda: gold.ranking_estados(
                t(("silver", "alfabetizacao_uf_clean")), t(("silver", "metas_consolidadas"))),
            ("gold", "perfil_desempenho_uf"): lambda: gold.perfil_desempenho_uf(
                t(("silver", "alfabetizacao_uf_clean"))),
            ("gold", "painel_municipios"): lambda: gold.painel_municipios(
                t(("silver", "alfabetizacao_municipio_clean")), t(("silver", "metas_consolidadas"))),
        }
        self._built: dict = {}

    def __getitem__(self, key):
        if key not in self._built:
            df = self._builders[key]()
            if self.materialize:
                path = scratch_dir(self.spark, "-".join(key))
                df.write.parquet(path)
                df = self.spark.read.schema(df.schema).parquet(path)
            self._built[key] = df
        return self._built[key]

    def __iter__(self):
        return iter(self._builders)

    def __len__(self):
        return len(self._builders)

    def __contains__(self, key):
        return key in self._builders


def _select(kinds: set[str], layers: set[str] | None = None) -> list[Rule]:
    return [r for r in rules_for("all") if r.kind in kinds and (layers is None or r.layer in layers)]


RULE_SETS = {
    "dq_duplicates": lambda: _select({"duplicates"}),
    "dq_range": lambda: _select({"range"}),
    "dq_domain": lambda: _select({"domain"}),
    "dq_row_ratio": lambda: _select({"row_ratio"}),
    "dq_nulls": lambda: _select({"nulls"}),
    "dq_level_sum": lambda: _select({"level_sum"}),
    "dq_coverage": lambda: _select({"coverage"}),
    "dq_references": lambda: _select({"references"}),
    "dq_missing_report": lambda: _select({"missing"}),
    "dq_all": lambda: rules_for("all"),
}


#: Rules that read a table more than once, or many tables: over written layers.
WRITTEN = {"dq_all"}


def _entry(name: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return present(evaluate(spark, LayerTables(Layers(spark, sf_dir), materialize=name in WRITTEN), RULE_SETS[name]()))
    run.__name__ = name
    return run


QUALITY_QUERIES = {name: _entry(name) for name in RULE_SETS}
