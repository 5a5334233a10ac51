"""The pipeline's own sources: names mapped to parquet folders or catalog tables, with a check of their columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.functions import LEVELS, TARGETS

# The columns each source must have.
_INDICATOR = ["serie", "rede", "taxa_alfabetizacao", "media_portugues", *LEVELS]
_GOAL = ["rede", "taxa_alfabetizacao", *TARGETS, "percentual_participacao"]
REQUIRED = {
    "uf": ["ano", "sigla_uf", *_INDICATOR],
    "municipio": ["ano", "id_municipio", *_INDICATOR],
    "alunos": ["ano", "id_municipio", "id_escola", "id_aluno", "caderno", "serie", "rede", "presenca",
               "preenchimento_caderno", "alfabetizado", "proficiencia", "peso_aluno"],
    "meta_brasil": ["ano", *_GOAL],
    "meta_uf": ["ano", "sigla_uf", *_GOAL],
    "meta_municipio": ["ano", "id_municipio", *_GOAL, "nivel_alfabetizacao"],
    "dicionario": ["id_tabela", "nome_coluna", "chave", "valor"],
    "dir_uf": ["sigla", "nome"],
    "dir_municipio": ["id_municipio", "nome"],
}
TABLE = "table:"


def read_source(spark: SparkSession, name: str, where: str) -> DataFrame:
    """One source from a parquet folder or, as ``table:<name>``, from the catalog; a missing column is an error."""
    df = spark.table(where[len(TABLE):]) if where.startswith(TABLE) else spark.read.parquet(where)
    missing = [c for c in REQUIRED[name] if c not in df.columns]
    if missing:
        raise ValueError(f"source {name} ({where}) lacks columns {', '.join(missing)}")
    return df


def read_sources(spark: SparkSession, places: dict[str, str]) -> dict[str, DataFrame]:
    """All nine sources by name; ``places`` maps each to its folder or table."""
    unknown, absent = sorted(set(places) - set(REQUIRED)), sorted(set(REQUIRED) - set(places))
    if unknown or absent:
        raise ValueError(f"unknown sources: {unknown}; missing sources: {absent}")
    return {name: read_source(spark, name, where) for name, where in places.items()}


def folder_sources(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The nine sources as parquet folders ``<root>/<name>``."""
    return read_sources(spark, {name: f"{root}/{name}" for name in REQUIRED})
