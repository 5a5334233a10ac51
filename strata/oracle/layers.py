"""DuckDB SQL of the queries over written layers: what the views hold is what must be read back."""

from __future__ import annotations

from strata.oracle.quality import CTE, QUALITY_SQL
from strata.oracle.queries import SQL
from strata.oracle.views import with_views

_TABLES = {k: v for k, v in CTE.items() if k[0] != "source"} | {("bronze", "streaming_eventos"): "bronze_events"}
_BATCH_STAMPED = [(lay, n) for lay, n in _TABLES if lay == "silver" or (lay == "bronze" and n != "streaming_eventos")]

LAYER_SQL = {
    "layer_receipts": with_views(*_TABLES.values()) + "\n" + "\nUNION ALL\n".join(
        f"SELECT '{lay}' AS layer, '{n}' AS table_name, true AS found, count(*) AS rows_reported, count(*) AS rows_read FROM {v}"
        for (lay, n), v in _TABLES.items()) + "\nUNION ALL SELECT 'gold', 'never_written', false, 0, 0",
    "layer_bronze_municipality": SQL["bronze_municipality"],
    "layer_silver_state": SQL["silver_state"],
    "layer_gold_panel": SQL["gold_municipality"],
    "layer_partitions": with_views("bronze_alunos") + "\nSELECT ano::VARCHAR AS folder, ano::BIGINT AS ano, count(*) AS n_rows FROM bronze_alunos GROUP BY ano",
    "gold_evolution_states": SQL["gold_evolution"],
    "distinct_count_states": SQL["distinct_count"],
    "dq_coverage_states": QUALITY_SQL["dq_coverage"],
    "dq_references_kept": QUALITY_SQL["dq_references"],
    "layer_file_lookup": f"SELECT * FROM ({SQL['bronze_pupils']}) WHERE id_aluno IN (SELECT min(id_aluno) FROM ({SQL['bronze_pupils']}) "
                         f"UNION SELECT max(id_aluno) FROM ({SQL['bronze_pupils']}))",
    "layer_file_pruning": "SELECT unnest(['first', 'last', 'none']) AS lookup, true AS pruned",
    "layer_years_rewritten": SQL["bronze_pupils"],
    "layer_year_folders": with_views("bronze_alunos")
    + "\nSELECT ano::BIGINT AS ano, CASE WHEN ano IN (1996, 1998) THEN 'run-2' ELSE 'run-1' END AS run, count(*) AS n_rows FROM bronze_alunos GROUP BY ano",
    "layer_clustering": with_views("bronze_municipio")
    + "\nSELECT ano::BIGINT AS ano, count(*) AS n_rows, 0::BIGINT AS files_overlapping FROM bronze_municipio GROUP BY ano",
    "layer_audit": "\nUNION ALL\n".join(
        f"SELECT '{lay}' AS layer, '{n}' AS table_name, 0::BIGINT AS nulls, 1::BIGINT AS n_values" for lay, n in _BATCH_STAMPED),
    "layer_gate": f"SELECT layer, count(*) AS n_rules, count(*) FILTER (NOT passed) AS n_failed, bool_and(passed) AS gate_open "
                  f"FROM ({QUALITY_SQL['dq_all']}) GROUP BY layer",
    "order_evolution": with_views("gold_evolucao") + "\nSELECT row_number() OVER (ORDER BY ano, serie) AS position, ano, serie FROM gold_evolucao",
    "order_ranking": with_views("gold_ranking") + "\nSELECT posicao, posicao AS first_position, count(*) AS n_rows FROM gold_ranking GROUP BY posicao",
}
