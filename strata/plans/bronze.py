"""Bronze: sources enriched with names and decoded labels, stamped with the
ingest time.  Pure DataFrame -> DataFrame builders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions import LEVELS, TARGETS
from strata.operators.enrich import decode_columns, lookup_name

INDICATOR_VALUES = ["taxa_alfabetizacao", "media_portugues", *LEVELS]


def _stamp(df: DataFrame) -> DataFrame:
    # One CURRENT_TIMESTAMP per query, as every row of a load shares it.
    return df.withColumn("ingestao_ts", F.current_timestamp())


def alfabetizacao_uf(src: dict[str, DataFrame]) -> DataFrame:
    df = lookup_name(src["uf"], src["dir_uf"], "sigla_uf", "sigla", "nome", "nome_uf")
    df = decode_columns(df, src["dicionario"], "uf", ["serie", "rede"])
    return _stamp(df.select("ano", "sigla_uf", "nome_uf", "serie_codigo", "rede_codigo",
                            "serie", "rede", *INDICATOR_VALUES))


def alfabetizacao_municipio(src: dict[str, DataFrame]) -> DataFrame:
    df = lookup_name(src["municipio"], src["dir_municipio"], "id_municipio", "id_municipio",
                     "nome", "nome_municipio", cast_key=True)
    df = decode_columns(df, src["dicionario"], "municipio", ["serie", "rede"])
    return _stamp(df.select("ano", "id_municipio", "nome_municipio", "serie_codigo", "rede_codigo",
                            "serie", "rede", *INDICATOR_VALUES))


PUPIL_CODES = ["serie", "rede", "presenca", "preenchimento_caderno", "alfabetizado"]


def alunos(src: dict[str, DataFrame]) -> DataFrame:
    df = lookup_name(src["alunos"], src["dir_municipio"], "id_municipio", "id_municipio",
                     "nome", "nome_municipio", cast_key=True)
    df = decode_columns(df, src["dicionario"], "alunos", PUPIL_CODES)
    return _stamp(df.select(
        "ano", "id_municipio", "nome_municipio", "id_escola", "id_aluno", "caderno",
        *[c + "_codigo" for c in PUPIL_CODES], *PUPIL_CODES, "proficiencia", "peso_aluno"))


def meta_brasil(src: dict[str, DataFrame]) -> DataFrame:
    return _stamp(src["meta_brasil"].select(
        "ano", "rede", "taxa_alfabetizacao", *TARGETS, "percentual_participacao"))


def meta_uf(src: dict[str, DataFrame]) -> DataFrame:
    df = lookup_name(src["meta_uf"], src["dir_uf"], "sigla_uf", "sigla", "nome", "nome_uf")
    return _stamp(df.select("ano", "sigla_uf", "nome_uf", "rede", "taxa_alfabetizacao",
                            *TARGETS, "percentual_participacao"))


def meta_municipio(src: dict[str, DataFrame]) -> DataFrame:
    df = lookup_name(src["meta_municipio"], src["dir_municipio"], "id_municipio", "id_municipio",
                     "nome", "nome_municipio", cast_key=True)
    return _stamp(df.select("ano", "id_municipio", "nome_municipio", "rede", "taxa_alfabetizacao",
                            *TARGETS, "nivel_alfabetizacao", "percentual_participacao"))


BUILDERS = {
    "alfabetizacao_uf": alfabetizacao_uf,
    "meta_brasil": meta_brasil,
    "meta_uf": meta_uf,
    "meta_municipio": meta_municipio,
    "alfabetizacao_municipio": alfabetizacao_municipio,
    "alunos": alunos,
}


#: The source with the rows (and years) of the tables that are written by year.
FACTS = {"alfabetizacao_municipio": "municipio", "alunos": "alunos"}


def build_all(src: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: fn(src) for name, fn in BUILDERS.items()}
