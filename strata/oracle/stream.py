"""DuckDB SQL of the stream queries: the batch result the stream must equal."""

from __future__ import annotations

from strata.oracle.queries import select
from strata.oracle.views import _METRICS, _latest

_PAYLOAD = ["tipo", "ano", "sigla_uf", "serie", "rede", "source", "taxa_alfabetizacao",
            "media_portugues", "meta_2030", "percentual_atingido", "taxa_anterior", "taxa_revisada",
            "motivo_revisao"]
_MELT = ", ".join(f"{{'metrica': '{m}', 'valor': CAST({m} AS VARCHAR)}}" for m in _METRICS)
_SILVER_COLS = ["tipo", "evento_us", "ano", "sigla_uf", "serie", "rede", "source", "metrica", "valor",
                "pubsub_message_id"]
_VALID = ("tipo IS NOT NULL AND timestamp IS NOT NULL AND sigla_uf IS NOT NULL "
          "AND pubsub_message_id IS NOT NULL "
          "AND (taxa_alfabetizacao IS NULL OR taxa_alfabetizacao BETWEEN 0 AND 100)")


def _melted(source: str) -> str:
    return (f"SELECT tipo, epoch_us(timestamp) AS evento_us, ano, sigla_uf, serie, rede, source, "
            f"_m.metrica AS metrica, _m.valor AS valor, pubsub_message_id "
            f"FROM (SELECT *, unnest([{_MELT}]) AS _m FROM ({source})) WHERE _m.valor IS NOT NULL")


_BRONZE = select(
    [*_PAYLOAD, "pubsub_message_id", "evento_us", "ingestao_us"],
    "SELECT *, epoch_us(timestamp) AS evento_us, epoch_us(ingestao_ts) AS ingestao_us "
    "FROM event_deliveries WHERE NOT malformed", ["event_deliveries"])
_LATEST = select(_SILVER_COLS, _melted("SELECT * FROM landed_latest"), ["landed_latest"])

STREAM_SQL = {
    "stream_ingest": _BRONZE,
    "stream_two_intakes": _BRONZE,
    "stream_quarantine": select(
        ["pubsub_message_id", "ingestao_us", "raw"],
        "SELECT pubsub_message_id, epoch_us(ingestao_ts) AS ingestao_us, "
        "'{\"tipo\": \"' || coalesce(tipo, '') || '\", \"ano\": ' || "
        "CASE WHEN CAST(pubsub_message_id AS BIGINT) % 2 = 0 THEN '' ELSE '\"x\"}' END AS raw "
        "FROM event_deliveries WHERE malformed", ["event_deliveries"]),
    "stream_dedup_melt": _LATEST,
    "stream_late_events": _LATEST,
    "stream_silver_state": _LATEST,
    "stream_silver_first_wins": select(
        _SILVER_COLS,
        _melted(_latest("event_deliveries", ["pubsub_message_id"], "delivery", [], f"NOT malformed AND {_VALID}")
                .replace("delivery DESC NULLS LAST", "delivery ASC")),
        ["event_deliveries"]),
    "stream_exact_rows": _BRONZE,
    "stream_exact_intake": select(
        ["batch_id", "n_reported", "n_rows"],
        "SELECT batch_id, n AS n_reported, n AS n_rows FROM (SELECT 0::BIGINT AS batch_id, least(7, count(*)) AS n FROM event_deliveries "
        "UNION ALL SELECT 1, least(1000, count(*) - 7) FROM event_deliveries UNION ALL SELECT 2, greatest(0, count(*) - 1007) FROM event_deliveries)",
        ["event_deliveries"]),
    "stream_gate_rows": _BRONZE,
    "stream_gate": select(
        ["batch_id", "rows", "malformed", "nulls", "out_of_range", "repeated", "held"],
        "SELECT wave AS batch_id, count(*) AS rows, count(*) FILTER (malformed) AS malformed, count(*) FILTER (NOT malformed AND "
        "(tipo IS NULL OR timestamp IS NULL OR sigla_uf IS NULL OR wave = 1 OR pubsub_message_id IS NULL)) AS nulls, "
        "count(*) FILTER (NOT malformed AND (taxa_alfabetizacao < 0 OR taxa_alfabetizacao > 100)) AS out_of_range, "
        "count(pubsub_message_id) - count(DISTINCT pubsub_message_id) AS repeated, wave = 1 AS held "
        "FROM event_deliveries JOIN (VALUES (0::BIGINT, 0), (1, 0), (2, 1)) AS w(wave, d) ON d = delivery GROUP BY wave", ["event_deliveries"]),
    "stream_redelivery": select(
        ["pubsub_message_id", "outcome", "attempts", "n_bronze", "n_dead"],
        "SELECT pubsub_message_id, CASE WHEN id % 2 = 0 OR id % 3 = 0 THEN 'recovered' ELSE 'dead' END AS outcome, "
        "CASE WHEN id % 2 = 0 THEN 2 ELSE 3 END::BIGINT AS attempts, (id % 2 = 0 OR id % 3 = 0)::BIGINT AS n_bronze, "
        "(id % 2 <> 0 AND id % 3 <> 0)::BIGINT AS n_dead "
        "FROM (SELECT DISTINCT pubsub_message_id, pubsub_message_id::BIGINT AS id FROM event_deliveries WHERE malformed)", ["event_deliveries"]),
    "stream_batches": select(
        ["batch_id", "n_rows"],
        "SELECT CAST(delivery AS BIGINT) AS batch_id, count(*) AS n_rows FROM event_deliveries WHERE NOT malformed GROUP BY delivery",
        ["event_deliveries"]),
}
