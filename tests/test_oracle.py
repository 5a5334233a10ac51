"""Differential test: registered queries against their DuckDB SQL on sf0.001."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SMOKE

NAMES = ["gold_state_ranking", "gold_state_year", "silver_state", "silver_events", "stack_scopes",
         "decode_five_columns", "rank_all", "dq_all", "orphan_keys", "stream_dedup_melt",
         "stream_silver_first_wins", "stream_quarantine"]


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(round(v, 6))
    return str(v)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ["region", "nation", "customer", "supplier", "orders", "lineitem", "events"]:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    # The optional operators have SQL only where SQL can express them; their own tests cover the rest.
    assert set(entry.queries()) - set(entry.LLM_QUERIES) == set(entry.oracle_sql()) - set(entry.LLM_SQL)
    assert set(entry.LLM_SQL) <= set(entry.LLM_QUERIES)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SMOKE)
    cols = df.columns
    got = sorted(tuple(_norm(r[c]) for c in sorted(cols)) for r in df.collect())
    cur = con.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(dcols) == sorted(cols)
    want = sorted(tuple(_norm(r[dcols.index(c)]) for c in sorted(cols)) for r in cur.fetchall())
    assert got == want


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["posicao", "sigla_uf", "nome_uf", "taxa_media", "meta_2030", "gap_meta",
                          "classificacao"]
    assert df.count() > 0


def test_contract_needs_no_session():
    """queries() and oracle_sql() are plain data: callable before any session exists."""
    import subprocess
    import sys
    code = ("import sys; sys.path.insert(0, '.'); import __spark_entry__ as e; "
            "from pyspark import SparkContext; assert SparkContext._active_spark_context is None; "
            "assert len(e.queries()) >= len(e.oracle_sql()) >= 73")
    subprocess.run([sys.executable, "-c", code], check=True, timeout=300)
