"""Physical layout per table: partition folders and clustering columns.

Only the large tables are partitioned by year (small tables would only gain
folders and metadata).  Clustering sorts rows inside each written file so
that parquet row-group min/max statistics let a reader skip row groups when
it filters on those columns.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class TableSpec:
    layer: str
    name: str
    partition_by: tuple[str, ...] = ()
    cluster_by: tuple[str, ...] = ()


SPECS = {
    ("bronze", "alfabetizacao_uf"): TableSpec("bronze", "alfabetizacao_uf"),
    ("bronze", "meta_brasil"): TableSpec("bronze", "meta_brasil"),
    ("bronze", "meta_uf"): TableSpec("bronze", "meta_uf"),
    ("bronze", "meta_municipio"): TableSpec("bronze", "meta_municipio", (), ("id_municipio",)),
    ("bronze", "alfabetizacao_municipio"): TableSpec(
        "bronze", "alfabetizacao_municipio", ("ano",), ("id_municipio",)),
    ("bronze", "alunos"): TableSpec("bronze", "alunos", ("ano",), ("id_municipio", "serie")),
    ("bronze", "streaming_eventos"): TableSpec("bronze", "streaming_eventos"),
    ("silver", "alfabetizacao_uf_clean"): TableSpec("silver", "alfabetizacao_uf_clean"),
    ("silver", "metas_consolidadas"): TableSpec("silver", "metas_consolidadas", (), ("escopo",)),
    ("silver", "alfabetizacao_municipio_clean"): TableSpec(
        "silver", "alfabetizacao_municipio_clean", ("ano",), ("id_municipio",)),
    ("silver", "alunos_clean"): TableSpec("silver", "alunos_clean", ("ano",), ("id_municipio", "serie")),
    ("silver", "streaming_eventos_clean"): TableSpec("silver", "streaming_eventos_clean"),
    ("gold", "indicador_por_uf_ano"): TableSpec("gold", "indicador_por_uf_ano"),
    ("gold", "evolucao_temporal_brasil"): TableSpec("gold", "evolucao_temporal_brasil"),
    ("gold", "ranking_estados"): TableSpec("gold", "ranking_estados"),
    ("gold", "perfil_desempenho_uf"): TableSpec("gold", "perfil_desempenho_uf"),
    ("gold", "painel_municipios"): TableSpec("gold", "painel_municipios"),
}


def spec(layer: str, name: str) -> TableSpec:
    return SPECS.get((layer, name), TableSpec(layer, name))
