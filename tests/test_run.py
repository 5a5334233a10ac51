"""Layer runner end to end on the smallest test data."""

import pytest

from strata.plans.quality import DataQualityError
from strata.plans.run import LayerError, expire, read_table, run, table_path, table_state, versions
from strata.sources import testviews as tv
from tests.conftest import SMOKE


def test_run_all_layers_then_gate(spark, tmp_root):
    src = tv.sources(spark, SMOKE)
    report = run(spark, src, tmp_root, events=tv.bronze_events_view(spark, SMOKE), gate=False)
    for layer, n in [("bronze", 7), ("silver", 5), ("gold", 5)]:
        assert len(report[layer]) == n and all("rows" in r for r in report[layer].values()), report[layer]
    assert report["bronze"]["alunos"]["rows"] == src["alunos"].count()
    exists, rows = table_state(spark, tmp_root, "gold", "ranking_estados")
    assert exists and rows == report["gold"]["ranking_estados"]["rows"]
    assert table_state(spark, tmp_root, "gold", "nope") == (False, 0)
    results = {(q["table_name"], q["rule"]): q for q in report["quality"]}
    assert len(results) == 41
    # Planted defects: out-of-range rates, duplicates and codes outside the domain.
    assert not results[("alfabetizacao_uf", "taxa_alfabetizacao_within_0_100")]["passed"]
    assert not results[("alfabetizacao_uf", "sigla_uf_in_domain")]["passed"]
    assert results[("ranking_estados", "exists_and_non_empty")]["passed"]
    # Re-run gold only with the gate on: reads silver of the first run, fails the gate.
    with pytest.raises(DataQualityError):
        run(spark, src, tmp_root, layers=("gold", "quality"), gate=True)
    assert read_table(spark, tmp_root, "quality", "results").count() == 41


def test_audit_times_are_filled_and_single(spark, tmp_root):
    run(spark, tv.sources(spark, SMOKE), tmp_root, layers=("bronze", "silver"))
    for layer, name, col in [("bronze", "alunos", "ingestao_ts"), ("silver", "alunos_clean", "silver_processado_ts")]:
        values = [r[0] for r in read_table(spark, tmp_root, layer, name).select(col).distinct().collect()]
        assert len(values) == 1 and values[0] is not None


def test_failed_table_ends_the_run(spark, tmp_root):
    src = dict(tv.sources(spark, SMOKE))
    src["uf"] = src["uf"].drop("serie")
    with pytest.raises(LayerError) as e:
        run(spark, src, tmp_root)
    assert "error" in e.value.report["bronze"]["alfabetizacao_uf"] and "silver" not in e.value.report
    assert table_path(spark, tmp_root, "bronze", "alfabetizacao_uf") is None


def test_gate_stops_before_the_next_layer(spark, tmp_root):
    with pytest.raises(DataQualityError):
        run(spark, tv.sources(spark, SMOKE), tmp_root)
    assert table_path(spark, tmp_root, "bronze", "alunos") and table_path(spark, tmp_root, "silver", "alunos_clean") is None
    assert {r["layer"] for r in read_table(spark, tmp_root, "quality", "results").collect()} == {"bronze", "source"}


def test_only_a_missing_folder_means_absent(spark, tmp_root):
    import os
    from strata.plans.run import write_table
    os.makedirs(f"{tmp_root}/gold/broken")
    with open(f"{tmp_root}/gold/broken/_runs", "w"):
        pass  # a file where the folder of markers should be
    assert table_path(spark, tmp_root, "gold", "absent") is None
    df = spark.range(3)
    for run_id in ("20240101", "20240102", "20240103"):
        write_table(spark, df, tmp_root, "gold", "kept", run_id)
    assert expire(spark, tmp_root, "gold", "kept", 2) == ["20240101"]
    assert versions(spark, tmp_root, "gold", "kept") == ["20240102", "20240103"]
    assert read_table(spark, tmp_root, "gold", "kept").count() == 3
    # A committed version whose data is gone is an error, not an absent table.
    fs_path = f"{tmp_root}/gold/kept/run=20240103"
    os.rename(fs_path, fs_path + "-moved")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_table(spark, tmp_root, "gold", "kept")
