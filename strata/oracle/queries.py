"""DuckDB SQL for every registered query (same names and columns as
``strata.catalog.QUERIES``)."""

from __future__ import annotations

from strata.oracle.fixed import LEVELS, TARGETS
from strata.oracle.views import _METRICS, VIEWS, classify_sql, with_views

# DOUBLE outputs are rounded to 6 places, as ``strata.catalog.present`` does.
DOUBLE_COLUMNS = {
    "taxa_alfabetizacao", "media_portugues", *LEVELS, "proporcao_abaixo_basico",
    "proporcao_basico", "proporcao_adequado_avancado", "proporcao_topo", *TARGETS,
    "percentual_participacao", "taxa_media", "taxa_min_rede", "taxa_max_rede",
    "taxa_media_brasil", "taxa_min_estado", "taxa_max_estado", "desvio_padrao", "meta_2030",
    "gap_meta", "proficiencia", "peso_aluno", "percentual_atingido", "taxa_anterior",
    "taxa_revisada", "share_pct",
}
RUNTIME_COLUMNS = {"ingestao_ts", "silver_processado_ts"}
# TIMESTAMP outputs are written as fixed-format text, as ``present`` does.
TIMESTAMP_COLUMNS = {"evento_ts"}


def _out(c: str) -> str:
    if c in DOUBLE_COLUMNS:
        return f"round({c}, 6) AS {c}"
    if c in TIMESTAMP_COLUMNS:
        return f"strftime({c}, '%Y-%m-%d %H:%M:%S.%f') AS {c}"
    return c


def select(cols: list[str], body: str, views: list[str]) -> str:
    out = ", ".join(_out(c) for c in cols if c not in RUNTIME_COLUMNS)
    return f"{with_views(*views)}\nSELECT {out} FROM (\n{body}\n) AS q"


def _decode(table_id: str, col: str) -> str:
    return (f"LEFT JOIN (SELECT chave AS _ch_{col}, valor AS _lb_{col} FROM dicionario "
            f"WHERE nome_coluna = '{col}' AND id_tabela = '{table_id}') "
            f"ON CAST(s.{col} AS VARCHAR) = _ch_{col}")


PUPIL_CODES = ["serie", "rede", "presenca", "preenchimento_caderno", "alfabetizado"]
BANDS = ["proporcao_abaixo_basico", "proporcao_basico", "proporcao_adequado_avancado"]

S_UF = ["ano", "sigla_uf", "sigla_uf_norm", "nome_uf", "serie", "rede", "taxa_alfabetizacao",
        "media_portugues", *LEVELS, *BANDS]
S_MUN = ["ano", "id_municipio", "nome_municipio", "serie", "rede", "taxa_alfabetizacao",
         "media_portugues", *LEVELS, *BANDS]
S_METAS = ["ano", "sigla_uf", "nome_uf", "id_municipio", "nome_municipio", "rede",
           "taxa_alfabetizacao", *TARGETS, "percentual_participacao", "nivel_alfabetizacao", "escopo"]
S_ALUNOS = ["ano", "id_municipio", "nome_municipio", "id_escola", "id_aluno", "caderno", "serie",
            "rede", "presenca", "preenchimento_caderno", "alfabetizado", "proficiencia", "peso_aluno"]
S_EVENTS = ["tipo", "evento_ts", "ano", "sigla_uf", "serie", "rede", "source", "metrica", "valor",
            "pubsub_message_id"]
G_IND = ["ano", "sigla_uf", "nome_uf", "serie", "taxa_media", "taxa_min_rede", "taxa_max_rede",
         "media_portugues", "qtd_redes", "ranking_nacional", "meta_2030", "gap_meta"]
G_EVO = ["ano", "serie", "taxa_media_brasil", "taxa_min_estado", "taxa_max_estado", "desvio_padrao",
         "qtd_estados"]
G_RANK = ["posicao", "sigla_uf", "nome_uf", "taxa_media", "meta_2030", "gap_meta", "classificacao"]
G_PERFIL = ["ano", "sigla_uf", "nome_uf", "serie", "rede", "taxa_alfabetizacao", *LEVELS, *BANDS,
            "proporcao_topo"]
G_PAINEL = ["id_municipio", "nome_municipio", "ano", "taxa_media", "meta_2030", "gap_meta", "atingiu_meta"]
B_UF = ["ano", "sigla_uf", "nome_uf", "serie_codigo", "rede_codigo", "serie", "rede",
        "taxa_alfabetizacao", "media_portugues", *LEVELS]
B_MUN = ["ano", "id_municipio", "nome_municipio", "serie_codigo", "rede_codigo", "serie", "rede",
         "taxa_alfabetizacao", "media_portugues", *LEVELS]
B_ALUNOS = ["ano", "id_municipio", "nome_municipio", "id_escola", "id_aluno", "caderno",
            *[c + "_codigo" for c in PUPIL_CODES], *PUPIL_CODES, "proficiencia", "peso_aluno"]
B_META_BR = ["ano", "rede", "taxa_alfabetizacao", *TARGETS, "percentual_participacao"]
B_META_UF = ["ano", "sigla_uf", "nome_uf", "rede", "taxa_alfabetizacao", *TARGETS,
             "percentual_participacao"]
B_META_MUN = ["ano", "id_municipio", "nome_municipio", "rede", "taxa_alfabetizacao", *TARGETS,
              "nivel_alfabetizacao", "percentual_participacao"]

_COMPLETE = ("rede IS NOT NULL AND taxa_alfabetizacao IS NOT NULL AND "
             + " AND ".join(f"{t} IS NOT NULL" for t in TARGETS)
             + " AND percentual_participacao IS NOT NULL")


def _mun_targets(keys: list[str], extra: str = "") -> str:
    """Means by ``keys`` beside their place's target; places without one drop out."""
    return (f"SELECT t.*, taxa_media - meta_2030 AS gap_meta{extra} FROM (SELECT {', '.join(keys)}, "
            "sum(taxa_alfabetizacao) / count(taxa_alfabetizacao) AS taxa_media, "
            "(SELECT meta_2030 FROM metas_mun_max g WHERE g.id_municipio = s.id_municipio::VARCHAR) AS meta_2030 "
            "FROM silver_municipio s SEMI JOIN metas_mun_max g ON s.id_municipio::VARCHAR = g.id_municipio GROUP BY ALL) t")


SQL: dict[str, str] = {
    # ---- enrich ----
    "decode_two_columns": select(
        ["ano", "id_municipio", "serie_codigo", "rede_codigo", "serie", "rede", "taxa_alfabetizacao"],
        f"""SELECT s.ano, s.id_municipio, s.serie AS serie_codigo, s.rede AS rede_codigo,
          _lb_serie AS serie, _lb_rede AS rede, s.taxa_alfabetizacao
        FROM src_municipio s {_decode('municipio', 'serie')} {_decode('municipio', 'rede')}""",
        ["src_municipio", "dicionario"]),
    "decode_five_columns": select(
        ["id_aluno", "ano", *[c + "_codigo" for c in PUPIL_CODES], *PUPIL_CODES],
        "SELECT s.id_aluno, s.ano, " + ", ".join(f"s.{c} AS {c}_codigo" for c in PUPIL_CODES) + ", "
        + ", ".join(f"_lb_{c} AS {c}" for c in PUPIL_CODES)
        + " FROM src_alunos s " + " ".join(_decode("alunos", c) for c in PUPIL_CODES),
        ["src_alunos", "dicionario"]),
    "lookup_state_name": select(
        ["ano", "sigla_uf", "rede", "nome_uf"],
        """SELECT s.ano, s.sigla_uf, s.rede, d.nome AS nome_uf FROM src_meta_uf s
        LEFT JOIN (SELECT DISTINCT sigla, nome FROM dir_uf) d ON s.sigla_uf = d.sigla""",
        ["src_meta_uf", "dir_uf"]),
    "lookup_municipality_cast": select(
        ["ano", "id_municipio", "serie", "rede", "nome_municipio"],
        """SELECT s.ano, s.id_municipio, s.serie, s.rede, d.nome AS nome_municipio FROM src_municipio s
        LEFT JOIN (SELECT DISTINCT id_municipio, nome FROM dir_municipio) d
          ON CAST(s.id_municipio AS VARCHAR) = CAST(d.id_municipio AS VARCHAR)""",
        ["src_municipio", "dir_municipio"]),
    "rename_codes": select(
        ["ano", "sigla_uf", "nome_uf", "serie_codigo", "rede_codigo", "serie", "rede"],
        "SELECT * FROM bronze_uf", ["bronze_uf"]),
    # ---- clean ----
    "require_not_null": select(
        ["ano", "sigla_uf", "nome_uf", "rede", "meta_alfabetizacao_2030"],
        f"SELECT * FROM bronze_meta_uf WHERE sigla_uf IS NOT NULL AND nome_uf IS NOT NULL AND {_COMPLETE}",
        ["bronze_meta_uf"]),
    "rate_in_range": select(
        ["ano", "id_municipio", "serie_codigo", "rede_codigo", "taxa_alfabetizacao"],
        "SELECT * FROM bronze_municipio WHERE taxa_alfabetizacao IS NOT NULL "
        "AND taxa_alfabetizacao BETWEEN 0 AND 100", ["bronze_municipio"]),
    "sparse_rate_range": select(
        ["pubsub_message_id", "tipo", "taxa_alfabetizacao", "taxa_revisada"],
        "SELECT * FROM bronze_events WHERE taxa_alfabetizacao IS NULL "
        "OR taxa_alfabetizacao BETWEEN 0 AND 100", ["bronze_events"]),
    "present_pupils": select(
        ["id_aluno", "ano", "id_municipio", "presenca", "proficiencia"],
        "SELECT * FROM bronze_alunos WHERE presenca = 'Presente'", ["bronze_alunos"]),
    "keep_latest_state": select(
        ["ano", "sigla_uf", "serie", "rede", "taxa_alfabetizacao", "media_portugues"],
        "SELECT * FROM silver_uf", ["silver_uf"]),
    "keep_latest_event": select(
        ["pubsub_message_id", "tipo", "sigla_uf", "taxa_alfabetizacao", "meta_2030", "taxa_anterior",
         "taxa_revisada", "motivo_revisao"],
        "SELECT * FROM events_latest", ["events_latest"]),
    "normalise_code": select(
        ["sigla_uf", "sigla_uf_norm"],
        "SELECT DISTINCT sigla_uf, upper(trim(sigla_uf)) AS sigla_uf_norm FROM bronze_uf", ["bronze_uf"]),
    "level_bands": select(
        ["ano", "id_municipio", "serie", "rede", *BANDS], "SELECT * FROM silver_municipio",
        ["silver_municipio"]),
    # ---- combine ----
    "stack_scopes": select(
        ["ano", "sigla_uf", "id_municipio", "rede", "meta_alfabetizacao_2030", "escopo"],
        """SELECT ano, NULL AS sigla_uf, NULL AS id_municipio, rede, meta_alfabetizacao_2030, 'brasil' AS escopo FROM src_meta_brasil
        UNION ALL SELECT ano, sigla_uf, NULL, rede, meta_alfabetizacao_2030, 'uf' FROM src_meta_uf
        UNION ALL SELECT ano, NULL, id_municipio::VARCHAR, rede, meta_alfabetizacao_2030, 'municipio' FROM src_meta_municipio""",
        ["src_meta_brasil", "src_meta_uf", "src_meta_municipio"]),
    "melt_event_metrics": select(
        ["pubsub_message_id", "tipo", "delivery", "metrica", "valor"],
        """SELECT pubsub_message_id, tipo, CAST(delivery AS BIGINT) AS delivery, k.metrica, k.valor FROM (SELECT *, unnest(["""
        + ", ".join(f"{{'metrica': '{m}', 'valor': {m}::VARCHAR}}" for m in _METRICS)
        + """]) AS k FROM event_deliveries) WHERE k.valor IS NOT NULL""", ["event_deliveries"]),
    # ---- aggregate ----
    "group_avg_min_max": select(
        ["ano", "sigla_uf", "nome_uf", "serie", "taxa_media", "taxa_min_rede", "taxa_max_rede"],
        """SELECT ano, sigla_uf, nome_uf, serie, avg(taxa_alfabetizacao) AS taxa_media,
          min(taxa_alfabetizacao) AS taxa_min_rede, max(taxa_alfabetizacao) AS taxa_max_rede
        FROM silver_uf GROUP BY ano, sigla_uf, nome_uf, serie""", ["silver_uf"]),
    "distinct_count": select(
        ["ano", "serie", "qtd_estados", "qtd_redes"],
        """SELECT ano, serie, count(DISTINCT sigla_uf) AS qtd_estados, count(DISTINCT rede) AS qtd_redes
        FROM silver_uf GROUP BY ano, serie""", ["silver_uf"]),
    "stddev_or_zero": select(
        ["ano", "sigla_uf", "serie", "desvio_padrao"],
        """SELECT ano, sigla_uf, serie, coalesce(stddev_samp(taxa_alfabetizacao), 0) AS desvio_padrao
        FROM silver_uf GROUP BY ano, sigla_uf, serie""", ["silver_uf"]),
    "max_target": select(["sigla_uf", "meta_2030"], "SELECT * FROM metas_uf_max", ["metas_uf_max"]),
    "distinct_dimension": select(
        ["id_municipio", "nome"], "SELECT s_suppkey::VARCHAR AS id_municipio, any_value(s_name) AS nome FROM supplier GROUP BY ALL",
        ["dir_municipio"]),
    # ---- join ----
    "inner_targets": select(
        ["sigla_uf", "ano", "taxa_media", "meta_2030", "gap_meta"],
        """SELECT b.*, m.meta_2030, b.taxa_media - m.meta_2030 AS gap_meta
        FROM (SELECT sigla_uf, ano, avg(taxa_alfabetizacao) AS taxa_media FROM silver_uf
              GROUP BY sigla_uf, ano) b JOIN metas_uf_max m ON b.sigla_uf = m.sigla_uf""",
        ["silver_uf", "metas_uf_max"]),
    "inner_targets_cast": select(
        ["id_municipio", "serie", "taxa_media", "meta_2030", "gap_meta"],
        _mun_targets(["id_municipio", "serie"]), ["silver_municipio", "metas_mun_max"]),
    "latest_period": select(
        ["sigla_uf", "ano", "serie", "rede", "taxa_alfabetizacao"],
        "SELECT r.* FROM state_last_year", ["state_last_year"]),
    "orphan_keys": select(
        ["ano", "sigla_uf", "serie", "rede"],
        """SELECT u.* FROM silver_uf u LEFT JOIN (SELECT DISTINCT sigla_uf FROM silver_metas
          WHERE escopo = 'uf') m ON u.sigla_uf = m.sigla_uf WHERE m.sigla_uf IS NULL""",
        ["silver_uf", "silver_metas"]),
    # ---- window ----
    "rank_within_year": select(
        ["ano", "serie", "sigla_uf", "nome_uf", "taxa_media", "ranking_nacional"],
        "SELECT *, rank() OVER (PARTITION BY ano, serie ORDER BY taxa_media DESC) AS ranking_nacional FROM state_means",
        ["state_means"]),
    "rank_all": select(
        ["sigla_uf", "taxa_media", "posicao"],
        """SELECT *, rank() OVER (ORDER BY taxa_media DESC NULLS LAST) AS posicao
        FROM (SELECT sigla_uf, sum(taxa_alfabetizacao::DECIMAL(30, 12))::DOUBLE / count(*) AS taxa_media FROM silver_uf GROUP BY sigla_uf)""",
        ["silver_uf"]),
    # ---- scalar ----
    "target_gap": select(
        ["id_municipio", "ano", "gap_meta"], _mun_targets(["id_municipio", "ano"]),
        ["silver_municipio", "metas_mun_max"]),
    "target_reached": select(
        ["id_municipio", "ano", "atingiu_meta"],
        _mun_targets(["id_municipio", "ano"], ", NOT taxa_media < meta_2030 AS atingiu_meta"),
        ["silver_municipio", "metas_mun_max"]),
    "classify_rate": select(
        ["ano", "sigla_uf", "serie", "rede", "taxa_alfabetizacao", "classificacao"],
        f"SELECT *, {classify_sql('taxa_alfabetizacao')} AS classificacao FROM silver_uf", ["silver_uf"]),
    "top_share": select(
        ["ano", "sigla_uf", "serie", "rede", "proporcao_topo"],
        "SELECT *, proporcao_aluno_nivel_6 + proporcao_aluno_nivel_7 + proporcao_aluno_nivel_8 "
        "AS proporcao_topo FROM silver_uf", ["silver_uf"]),
    # ---- tables ----
    "silver_state": select(S_UF, "SELECT * FROM silver_uf", ["silver_uf"]),
    "silver_targets": select(S_METAS, "SELECT * FROM silver_metas", ["silver_metas"]),
    "silver_municipality": select(S_MUN, "SELECT * FROM silver_municipio", ["silver_municipio"]),
    "silver_pupils": select(S_ALUNOS, "SELECT * FROM silver_alunos", ["silver_alunos"]),
    "silver_events": select(S_EVENTS, "SELECT * FROM silver_events", ["silver_events"]),
    "gold_state_year": select(G_IND, "SELECT * FROM gold_indicador", ["gold_indicador"]),
    "gold_evolution": select(G_EVO, "SELECT * FROM gold_evolucao", ["gold_evolucao"]),
    "gold_state_ranking": select(G_RANK, "SELECT * FROM gold_ranking", ["gold_ranking"]),
    "gold_profile": select(G_PERFIL, "SELECT * FROM gold_perfil", ["gold_perfil"]),
    "gold_municipality": select(G_PAINEL, "SELECT * FROM gold_painel", ["gold_painel"]),
    "bronze_state": select(B_UF, "SELECT * FROM bronze_uf", ["bronze_uf"]),
    "bronze_municipality": select(B_MUN, "SELECT * FROM bronze_municipio", ["bronze_municipio"]),
    "bronze_pupils": select(B_ALUNOS, "SELECT * FROM bronze_alunos", ["bronze_alunos"]),
    "bronze_target_country": select(B_META_BR, "SELECT * FROM bronze_meta_brasil", ["bronze_meta_brasil"]),
    "bronze_target_state": select(B_META_UF, "SELECT * FROM bronze_meta_uf", ["bronze_meta_uf"]),
    "bronze_target_municipality": select(B_META_MUN, "SELECT * FROM bronze_meta_municipio",
                                         ["bronze_meta_municipio"]),
}

assert all(v in VIEWS for v in ["silver_uf", "gold_painel"])
SQL["latest_period_split"] = SQL["latest_period"]
