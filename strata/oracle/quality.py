"""DuckDB SQL of the quality rules, written as statements of their own: each gives the violations ``v`` and the total ``t``.

Nothing here comes from the rules of the Spark side; names of rules are those
of its result rows.
"""

from __future__ import annotations

import re

from strata.oracle.views import with_views

CTE = {
    ("source", "dicionario"): "dicionario",
    ("bronze", "alfabetizacao_uf"): "bronze_uf",
    ("bronze", "meta_brasil"): "bronze_meta_brasil",
    ("bronze", "meta_uf"): "bronze_meta_uf",
    ("bronze", "meta_municipio"): "bronze_meta_municipio",
    ("bronze", "alfabetizacao_municipio"): "bronze_municipio",
    ("bronze", "alunos"): "bronze_alunos",
    ("silver", "alfabetizacao_uf_clean"): "silver_uf",
    ("silver", "metas_consolidadas"): "silver_metas",
    ("silver", "alfabetizacao_municipio_clean"): "silver_municipio",
    ("silver", "alunos_clean"): "silver_alunos",
    ("silver", "streaming_eventos_clean"): "silver_events",
    ("gold", "indicador_por_uf_ano"): "gold_indicador",
    ("gold", "evolucao_temporal_brasil"): "gold_evolucao",
    ("gold", "ranking_estados"): "gold_ranking",
    ("gold", "perfil_desempenho_uf"): "gold_perfil",
    ("gold", "painel_municipios"): "gold_painel",
}

# The 27 state codes.
STATES = """('AC', 'AL', 'AM', 'AP', 'BA', 'CE', 'DF', 'ES', 'GO', 'MA', 'MG', 'MS', 'MT', 'PA', 'PB', 'PE', 'PI', 'PR',
 'RJ', 'RN', 'RO', 'RR', 'RS', 'SC', 'SE', 'SP', 'TO')"""
_LEVELS = " + ".join(f"proporcao_aluno_nivel_{i}" for i in range(9))


def _empty(view: str) -> str:
    return f"SELECT CASE WHEN EXISTS (SELECT 1 FROM {view}) THEN 0 ELSE 1 END AS v, (SELECT count(*) FROM {view}) AS t"


def _rows(view: str, condition: str) -> str:
    return f"SELECT (SELECT count(*) FROM {view} WHERE {condition}) AS v, (SELECT count(*) FROM {view}) AS t"


def _nulls(view: str, columns: str) -> tuple[str, str]:
    names = columns.split()
    return f"no_nulls({','.join(names)})", _rows(view, " OR ".join(f"{c} IS NULL" for c in names))


def _twice(view: str, columns: str) -> tuple[str, str]:
    keys = columns.replace(" ", ", ")
    return (f"no_duplicate_keys({columns.replace(' ', ',')})",
            f"SELECT (SELECT count(*) FROM (SELECT {keys} FROM {view} GROUP BY {keys} HAVING count(*) > 1)) AS v, (SELECT count(*) FROM {view}) AS t")


def _strangers(view: str) -> str:
    return f"SELECT count(*) AS v, (SELECT count(*) FROM {view}) AS t FROM (SELECT DISTINCT sigla_uf FROM {view} WHERE sigla_uf NOT IN {STATES})"


def _orphans(view: str, key: str, known: str) -> str:
    return (f"SELECT count(*) FILTER (WHERE NOT found) AS v, count(*) AS t FROM "
            f"(SELECT coalesce({key} IN (SELECT k FROM ({known}) WHERE k IS NOT NULL), false) AS found FROM {view})")


#: ``(kind, layer, table, rule, SQL)``; rules of the kind "missing" are reports and never fail.
CHECKS: list[tuple[str, str, str, str, str]] = [
    ("non_empty", layer, table, "exists_and_non_empty", _empty(view)) for (layer, table), view in CTE.items()
    if layer != "source" and not table.startswith("streaming_")
] + [
    ("duplicates", "bronze", "alfabetizacao_uf", *_twice("bronze_uf", "ano sigla_uf serie rede")),
    ("duplicates", "source", "dicionario", *_twice("dicionario", "id_tabela nome_coluna chave")),
    ("duplicates", "silver", "streaming_eventos_clean", *_twice("silver_events", "pubsub_message_id metrica")),
    ("range", "bronze", "alfabetizacao_uf", "taxa_alfabetizacao_within_0_100", _rows("bronze_uf", "taxa_alfabetizacao NOT BETWEEN 0 AND 100")),
    ("domain", "bronze", "alfabetizacao_uf", "sigla_uf_in_domain", _strangers("bronze_uf")),
    ("domain", "silver", "alfabetizacao_uf_clean", "sigla_uf_in_domain", _strangers("silver_uf")),
    ("row_ratio", "silver", "alfabetizacao_uf_clean", "rows_at_most_bronze.alfabetizacao_uf",
     "SELECT (a > b AND a > 0 AND b > 0)::INT AS v, b AS t FROM (SELECT (SELECT count(*) FROM silver_uf) AS a, (SELECT count(*) FROM bronze_uf) AS b)"),
    ("nulls", "silver", "alfabetizacao_uf_clean", *_nulls("silver_uf", "ano sigla_uf nome_uf serie rede taxa_alfabetizacao")),
    ("nulls", "silver", "metas_consolidadas", *_nulls("silver_metas", "ano rede taxa_alfabetizacao meta_alfabetizacao_2030 percentual_participacao escopo")),
    ("nulls", "silver", "alfabetizacao_municipio_clean", *_nulls("silver_municipio", "ano id_municipio nome_municipio serie rede taxa_alfabetizacao")),
    ("nulls", "silver", "alunos_clean", *_nulls(
        "silver_alunos", "ano id_municipio nome_municipio serie rede presenca preenchimento_caderno alfabetizado proficiencia peso_aluno")),
    ("nulls", "silver", "streaming_eventos_clean", *_nulls("silver_events", "tipo evento_ts sigla_uf metrica valor pubsub_message_id")),
    ("nulls", "gold", "indicador_por_uf_ano", *_nulls("gold_indicador", "ano sigla_uf taxa_media meta_2030 gap_meta")),
    ("nulls", "gold", "evolucao_temporal_brasil", *_nulls("gold_evolucao", "ano serie taxa_media_brasil desvio_padrao qtd_estados")),
    ("nulls", "gold", "ranking_estados", *_nulls("gold_ranking", "posicao sigla_uf taxa_media meta_2030 gap_meta classificacao")),
    ("nulls", "gold", "perfil_desempenho_uf", *_nulls("gold_perfil", "ano sigla_uf serie rede taxa_alfabetizacao")),
    ("nulls", "gold", "painel_municipios", *_nulls("gold_painel", "id_municipio nome_municipio ano taxa_media meta_2030 gap_meta atingiu_meta")),
    ("missing", "silver", "alfabetizacao_uf_clean", "missing_proporcao_aluno_nivel_0", _rows("silver_uf", "proporcao_aluno_nivel_0 IS NULL")),
    ("missing", "silver", "alfabetizacao_municipio_clean", "missing_proporcao_aluno_nivel_0", _rows("silver_municipio", "proporcao_aluno_nivel_0 IS NULL")),
    ("missing", "gold", "perfil_desempenho_uf", "missing_proporcao_topo", _rows("gold_perfil", "proporcao_topo IS NULL")),
    # A missing first level is reported, not judged; any other missing level makes the sum unknown.
    ("level_sum", "silver", "alfabetizacao_uf_clean", "levels_sum_to_100_within_1",
     _rows("silver_uf", f"proporcao_aluno_nivel_0 IS NOT NULL AND ({_LEVELS} < 99 OR {_LEVELS} > 101)")),
    ("level_sum", "silver", "alfabetizacao_municipio_clean", "levels_sum_to_100_within_1",
     _rows("silver_municipio", f"proporcao_aluno_nivel_0 IS NOT NULL AND ({_LEVELS} < 99 OR {_LEVELS} > 101)")),
    ("coverage", "gold", "ranking_estados", "covers_silver.metas_consolidadas.sigla_uf",
     "SELECT greatest(a, b) - least(a, b) AS v, b AS t FROM (SELECT (SELECT count(DISTINCT sigla_uf) FROM gold_ranking) AS a, "
     "(SELECT count(*) FROM (SELECT sigla_uf FROM silver_metas WHERE escopo = 'uf' AND sigla_uf IS NOT NULL GROUP BY sigla_uf)) AS b)"),
    ("references", "gold", "indicador_por_uf_ano", "sigla_uf_references_silver.metas_consolidadas",
     _orphans("gold_indicador", "sigla_uf", "SELECT sigla_uf AS k FROM silver_metas WHERE escopo = 'uf'")),
    ("references", "gold", "painel_municipios", "id_municipio_references_silver.metas_consolidadas",
     _orphans("gold_painel", "id_municipio::VARCHAR", "SELECT id_municipio AS k FROM silver_metas WHERE escopo = 'municipio'")),
    ("references", "gold", "ranking_estados", "sigla_uf_references_silver.alfabetizacao_uf_clean",
     _orphans("gold_ranking", "sigla_uf", "SELECT sigla_uf AS k FROM silver_uf")),
]


def _sql(kinds: set[str] | None = None) -> str:
    parts, views = [], []
    for kind, layer, table, rule, body in CHECKS:
        if kinds is not None and kind not in kinds:
            continue
        report = kind == "missing"
        views += [v for v in CTE.values() if re.search(rf"\b{v}\b", body)]
        parts.append(
            f"SELECT '{layer}' AS layer, '{table}' AS table_name, '{rule}' AS rule, '{'report' if report else 'check'}' AS kind, "
            f"'{'INFO' if report else 'ERROR'}' AS severity, v::BIGINT AS violations, t::BIGINT AS total, "
            f"{'true' if report else 'v = 0'} AS passed, round(CASE WHEN t > 0 THEN 100.0 * v / t END, 6) AS share_pct FROM ({body})")
    return with_views(*dict.fromkeys(views)) + "\n" + "\nUNION ALL\n".join(parts)


QUALITY_SQL = {"dq_all": _sql()} | {
    f"dq_{name}": _sql({kind}) for name, kind in (
        ("duplicates", "duplicates"), ("range", "range"), ("domain", "domain"), ("row_ratio", "row_ratio"), ("nulls", "nulls"),
        ("level_sum", "level_sum"), ("coverage", "coverage"), ("references", "references"), ("missing_report", "missing"))}
