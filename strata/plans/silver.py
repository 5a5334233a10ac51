"""Silver: validated, de-duplicated and consolidated tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions import BANDS, LEVELS, TARGETS
from strata.operators.clean import band_sums, keep_latest, normalise_code, require
from strata.operators.combine import stack_scopes
from strata.operators.reshape import melt_sparse
from strata.schemas import EVENT_METRICS

RATE_RANGE = (0, 100)


def _processed(df: DataFrame) -> DataFrame:
    return df.withColumn("silver_processado_ts", F.current_timestamp())


def alfabetizacao_uf_clean(bronze_uf: DataFrame) -> DataFrame:
    # Validity filters run before keep-latest: an older valid row beats a
    # newer invalid one.
    valid = require(bronze_uf, not_null=["taxa_alfabetizacao", "nome_uf", "serie", "rede"],
                    within={"taxa_alfabetizacao": RATE_RANGE})
    latest = keep_latest(valid, ["ano", "sigla_uf", "serie", "rede"], "ingestao_ts")
    out = normalise_code(latest, "sigla_uf", "sigla_uf_norm")
    out = band_sums(out, BANDS)
    return _processed(out.select(
        "ano", "sigla_uf", "sigla_uf_norm", "nome_uf", "serie", "rede",
        "taxa_alfabetizacao", "media_portugues", *LEVELS, *BANDS, "ingestao_ts"))


def alfabetizacao_municipio_clean(bronze_mun: DataFrame) -> DataFrame:
    valid = require(bronze_mun, not_null=["taxa_alfabetizacao", "nome_municipio", "serie", "rede"],
                    within={"taxa_alfabetizacao": RATE_RANGE})
    latest = keep_latest(valid, ["ano", "id_municipio", "serie", "rede"], "ingestao_ts")
    out = band_sums(latest, BANDS)
    return _processed(out.select(
        "ano", "id_municipio", "nome_municipio", "serie", "rede",
        "taxa_alfabetizacao", "media_portugues", *LEVELS, *BANDS, "ingestao_ts"))


TARGET_COLUMNS = [
    ("ano", "long"), ("sigla_uf", "string"), ("nome_uf", "string"),
    ("id_municipio", "string"), ("nome_municipio", "string"), ("rede", "string"),
    ("taxa_alfabetizacao", "double"), *[(t, "double") for t in TARGETS],
    ("percentual_participacao", "double"), ("nivel_alfabetizacao", "string"), ("escopo", "string"),
]
COMPLETE_TARGET_COLUMNS = ["rede", "taxa_alfabetizacao", *TARGETS, "percentual_participacao"]


def metas_consolidadas(meta_brasil: DataFrame, meta_uf: DataFrame,
                       meta_municipio: DataFrame) -> DataFrame:
    """Country, state and municipality targets in one table; only complete rows."""
    parts = {
        "brasil": require(meta_brasil, not_null=COMPLETE_TARGET_COLUMNS),
        "uf": require(meta_uf, not_null=["sigla_uf", "nome_uf", *COMPLETE_TARGET_COLUMNS]),
        "municipio": require(meta_municipio, not_null=["id_municipio", "nome_municipio", *COMPLETE_TARGET_COLUMNS]),
    }
    return _processed(stack_scopes(parts, TARGET_COLUMNS))


def alunos_clean(bronze_alunos: DataFrame) -> DataFrame:
    valid = require(bronze_alunos, equals={"presenca": "Presente"},
                    not_null=["proficiencia", "nome_municipio", "serie", "rede",
                              "preenchimento_caderno", "alfabetizado", "peso_aluno", "caderno"])
    return _processed(valid.select(
        "ano", "id_municipio", "nome_municipio", "id_escola", "id_aluno", "caderno",
        "serie", "rede", "presenca", "preenchimento_caderno", "alfabetizado",
        "proficiencia", "peso_aluno", "ingestao_ts"))


EVENT_IDS = ["tipo", "evento_ts", "ano", "sigla_uf", "serie", "rede", "source",
             "pubsub_message_id", "ingestao_ts"]


def streaming_eventos_clean(bronze_events: DataFrame) -> DataFrame:
    """Validate, keep the latest delivery per message, unpivot the sparse metrics.

    An out-of-range rate drops the whole event (all its metrics); a NULL rate
    (other event kinds) passes.
    """
    valid = require(bronze_events, not_null=["tipo", "timestamp", "sigla_uf", "pubsub_message_id"],
                    null_or_within={"taxa_alfabetizacao": RATE_RANGE})
    return melted_events(keep_latest(valid, ["pubsub_message_id"], "ingestao_ts"))


def melted_events(latest: DataFrame) -> DataFrame:
    """One valid delivery per message -> one row per message and metric."""
    long = melt_sparse(latest.withColumnRenamed("timestamp", "evento_ts"), EVENT_IDS, EVENT_METRICS)
    return _processed(long.select(
        "tipo", "evento_ts", "ano", "sigla_uf", "serie", "rede", "source", "metrica", "valor",
        "pubsub_message_id", "ingestao_ts"))
