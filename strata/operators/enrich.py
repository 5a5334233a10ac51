"""Enrichment: name lookup in a directory and code decode with a dictionary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def join_as_text(df: DataFrame, key: str, table: DataFrame, table_key: str) -> DataFrame:
    """LEFT JOIN ``table`` where both keys are the same text; ``table_key`` goes.

    A whole number has one text, so such keys are compared as numbers with
    those of the table's keys that are written as a number is ('0012' and '+12'
    are not): its join neither makes nor hashes a text for each row.
    """
    whole = isinstance(df.schema[key].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    kind = "long" if whole else "string"
    text = F.col(table_key).cast("string")
    if whole:
        table = table.where(text.try_cast("long").cast("string") == text)
    table = table.withColumn(table_key, text.try_cast(kind))
    return df.join(table, df[key].cast(kind) == table[table_key], "left").drop(table_key)


def lookup_name(df: DataFrame, directory: DataFrame, key: str, dir_key: str,
                name_col: str, out_col: str, cast_key: bool = False) -> DataFrame:
    """LEFT JOIN a DISTINCT (code, name) directory and add the name as ``out_col``.

    Repeated directory rows are collapsed by the DISTINCT; a code with two
    names keeps both and doubles the row, as a plain join does.  With
    ``cast_key`` both sides are compared as text ('0012' does not match 12).  No
    broadcast hint: the planner knows the directory's file size, AQE its size
    at run time, and both broadcast it only within their byte thresholds.
    """
    tmp = f"_dir_{out_col}"
    names = directory.select(F.col(dir_key).alias(tmp), F.col(name_col).alias(out_col)).distinct()
    if cast_key:
        return join_as_text(df, key, names, tmp)
    return df.join(names, F.col(key) == names[tmp], "left").drop(tmp)


def decode_columns(df: DataFrame, dictionary: DataFrame, table_id: str,
                   columns: list[str], code_suffix: str = "_codigo") -> DataFrame:
    """Decode coded columns with (id_tabela, nome_coluna, chave, valor) rows.

    Each column ``c`` is renamed to ``c + code_suffix`` and its label becomes
    ``c``: one LEFT JOIN per column on ``CAST(code AS STRING) = chave``.  A code
    missing from the dictionary gives a NULL label; a key listed twice doubles
    the row (the dictionary is not made unique, a quality rule reports it).
    """
    out = df.withColumnsRenamed({c: c + code_suffix for c in columns})
    for c in columns:
        key = f"_chave_{c}"
        labels = (dictionary
                  .where((F.col("nome_coluna") == c) & (F.col("id_tabela") == table_id))
                  .select(F.col("chave").alias(key), F.col("valor").alias(c)))
        out = join_as_text(out, c + code_suffix, labels, key)
    return out
