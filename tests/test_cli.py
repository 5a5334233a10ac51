"""Command line: run writes every layer; validate exits 1 on the planted defects."""

from strata.__main__ import main
from strata.plans.run import table_state
from tests.conftest import SMOKE


def test_cli_run_and_validate(spark, tmp_root, capsys):
    assert main(["run", "--source-dir", SMOKE, "--root", tmp_root, "--no-gate"]) == 0
    assert table_state(spark, tmp_root, "gold", "painel_municipios")[0]
    assert table_state(spark, tmp_root, "silver", "streaming_eventos_clean")[0]
    assert main(["validate", "--root", tmp_root, "--layer", "gold"]) == 0
    assert main(["validate", "--root", tmp_root, "--layer", "bronze"]) == 1


def test_cli_ingest(spark, tmp_root):
    import json
    import os
    landing = f"{tmp_root}/landing"
    os.makedirs(landing)
    payload = {"tipo": "atualizacao_meta", "timestamp": "2024-05-01T12:00:00+00:00", "ano": 2023,
               "sigla_uf": "RJ", "meta_2030": 91.5}
    with open(f"{landing}/m.json", "w", encoding="utf-8") as fh:
        fh.write(json.dumps({"message_id": "m1", "publish_time": "2024-05-01T12:00:01+00:00",
                             "data": json.dumps(payload)}) + "\n")
    args = ["ingest", "--landing", landing, "--bronze", f"{tmp_root}/b", "--quarantine", f"{tmp_root}/q",
            "--checkpoint", f"{tmp_root}/c", "--timeout", "120"]
    assert main(args) == 0
    from strata.streaming.ingest import read_bronze
    rows = read_bronze(spark, f"{tmp_root}/b").collect()
    assert [(r.pubsub_message_id, r.meta_2030) for r in rows] == [("m1", 91.5)]


def test_cli_real_sources_with_stream(spark, tmp_root):
    """ingest, then run on nine parquet folders with the ingested events, then validate."""
    from strata.sources import testviews as tv
    for name, df in tv.sources(spark, SMOKE).items():
        df.write.parquet(f"{tmp_root}/src/{name}")
    test_cli_ingest(spark, tmp_root)
    args = ["run", "--sources", f"{tmp_root}/src", "--root", f"{tmp_root}/lake", "--events", f"{tmp_root}/b"]
    assert main([*args, "--no-gate"]) == 0
    assert table_state(spark, f"{tmp_root}/lake", "silver", "streaming_eventos_clean") == (True, 1)
    assert main(["validate", "--root", f"{tmp_root}/lake", "--layer", "gold"]) == 0
    assert main([*args[:3], "--root", f"{tmp_root}/lake2"]) == 1  # the gate fails
    spark.range(1).write.parquet(f"{tmp_root}/odd")
    import pytest
    with pytest.raises(ValueError, match="lacks columns"):
        main([*args, "--source", f"uf={tmp_root}/odd"])


def test_scratch_needs_a_shared_folder_on_a_cluster():
    from types import SimpleNamespace
    import pytest
    from strata.session import checkpoint_root
    conf = SimpleNamespace(get=lambda *a: None)
    sc = SimpleNamespace(getCheckpointDir=lambda: None, getConf=lambda: conf, master="spark://host:7077")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(SimpleNamespace(sparkContext=sc, conf=conf))
