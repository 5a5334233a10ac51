"""Registered queries over written layers: what the runner's sinks wrote, read back.

The layers are written once per session and test folder and shared by all of
these queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.catalog import Layers, present
from strata.plans import gold
from strata.operators.references import References
from strata.operators.states import StateTable, evolution
from strata.plans.fileindex import files_for, index_column, lookup
from strata.plans.quality import rule_result, rules_for
from strata.plans.registry import SPECS
from strata.plans.run import parts, read_table, run, table_state, write_table, write_years
from strata.quality_catalog import LayerTables
from strata.session import scratch_dir
from strata.sources import testviews as tv

_WRITTEN: dict[tuple[str, str], tuple[str, dict]] = {}


def written_layers(spark: SparkSession, sf_dir: str) -> tuple[str, dict]:
    """Root folder and report of one run over the test views."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _WRITTEN:
        root = scratch_dir(spark, "layers")
        report = run(spark, tv.sources(spark, sf_dir), root, events=tv.bronze_events_view(spark, sf_dir), gate=False)
        _WRITTEN[key] = root, report
    return _WRITTEN[key]


def _rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def layer_receipts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-1/5, SRC-7: the row count each write reported beside the rows read back."""
    root, report = written_layers(spark, sf_dir)
    rows = []
    for layer, name in SPECS:
        exists, n = table_state(spark, root, layer, name)
        rows.append((layer, name, exists, report[layer][name]["rows"], n))
    rows.append(("gold", "never_written", *table_state(spark, root, "gold", "never_written"), 0))
    return _rows(spark, rows, "layer string, table_name string, found boolean, rows_reported long, rows_read long")


def _read_back(layer: str, name: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return present(read_table(spark, written_layers(spark, sf_dir)[0], layer, name))
    return query


def layer_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-2: the year folder of each row of the written pupil table."""
    df = read_table(spark, written_layers(spark, sf_dir)[0], "bronze", "alunos")
    folder = F.regexp_extract(F.input_file_name(), "/ano=([0-9]+)/", 1)
    return df.select(folder.alias("folder"), F.col("ano").cast("long").alias("ano")).groupBy("folder", "ano").agg(F.count("*").alias("n_rows"))


def layer_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-3: per year the rows, and how many files of the municipality table begin before the one before them ends."""
    df = read_table(spark, written_layers(spark, sf_dir)[0], "bronze", "alfabetizacao_municipio")
    files = df.groupBy("ano", F.input_file_name().alias("file")).agg(
        F.min("id_municipio").alias("lo"), F.max("id_municipio").alias("hi"), F.count("*").alias("n"))
    before = F.lag("hi").over(Window.partitionBy("ano").orderBy("lo", "hi"))
    # A hot id may fill the end of one file and the start of the next.
    return files.withColumn("over", (F.col("lo") < before).cast("int")).groupBy(F.col("ano").cast("long").alias("ano")).agg(
        F.sum("n").alias("n_rows"), F.coalesce(F.sum("over"), F.lit(0)).cast("long").alias("files_overlapping"))


def _positions(df: DataFrame) -> DataFrame:
    """The place of each row in the order the output comes in: rows of the earlier partitions, then those before it in its own.

    Ids count rows within a partition, so only the partitions are counted and
    added up; written once, as a sort deals its rows anew each time it runs.
    """
    path = scratch_dir(df.sparkSession, "positions")
    df.withColumn("_at", F.monotonically_increasing_id()).write.parquet(path)
    seen = df.sparkSession.read.parquet(path).withColumn("_part", F.shiftright("_at", 33))
    before, total = [], 0
    for part, n in sorted(map(tuple, seen.groupBy("_part").agg(F.count("*").alias("n")).collect())):  # a row per partition
        before.append((part, total))
        total += n
    offsets = _rows(df.sparkSession, before, "_part long, _before long")
    here = F.col("_at") - F.shiftleft("_part", 33)
    return seen.join(offsets, "_part").withColumn("position", F.col("_before") + here + 1).drop("_at", "_part", "_before")


def order_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRT-1: rows of the evolution table come by year and grade."""
    L = Layers(spark, sf_dir)
    return _positions(gold.evolucao_temporal_brasil(L.silver_uf)).select("position", "ano", "serie")


def order_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRT-2: rows of the state ranking come by rank."""
    L = Layers(spark, sf_dir)
    placed = _positions(gold.ranking_estados(L.silver_uf, L.silver_metas))
    return placed.groupBy("posicao").agg(F.min("position").alias("first_position"), F.count("*").alias("n_rows"))


AUDITED = [("bronze", n, "ingestao_ts") for lay, n in SPECS if lay == "bronze" and n != "streaming_eventos"] + \
          [("silver", n, "silver_processado_ts") for lay, n in SPECS if lay == "silver"]


def layer_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-6/7, SCL-12: every row of a load carries the same, filled audit time."""
    root, _ = written_layers(spark, sf_dir)
    out = None
    for layer, name, col in AUDITED:
        one = read_table(spark, root, layer, name).agg(
            F.count_if(F.col(col).isNull()).alias("nulls"), F.count_distinct(col).alias("n_values"))
        one = one.select(F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "nulls", "n_values")
        out = one if out is None else out.unionByName(one)
    return out


def layer_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ-14: per layer the checks, those that failed, and whether the gate lets the layer pass."""
    root, _ = written_layers(spark, sf_dir)
    results = read_table(spark, root, "quality", "results")
    bad = F.count_if(~F.col("passed"))
    return results.groupBy("layer").agg(F.count("*").alias("n_rules"), bad.alias("n_failed"), (bad == 0).alias("gate_open"))


REWRITTEN = [1996, 1998]


def _two_years_again(spark: SparkSession, sf_dir: str) -> str:
    """The pupil table written from damaged microdata (two years lack a third of their pupils, one year is made up), then those years again."""
    root = scratch_dir(spark, "years")
    L = Layers(spark, sf_dir)
    lost = F.col("ano").isin(*REWRITTEN) & (F.col("id_aluno").cast("long") % 3 == 0)
    made_up = L.bronze_alunos.where("ano = 1995").withColumn("ano", F.lit(1994).cast("long"))
    write_table(spark, L.bronze_alunos.where(~lost).unionByName(made_up), root, "bronze", "alunos", "run-1")
    write_years(spark, L.bronze_alunos, root, "bronze", "alunos", "run-2", [1994, *REWRITTEN])
    return root


def layer_years_rewritten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-1/2: reads of a version that mixes year folders of two runs give the whole table."""
    return present(read_table(spark, _two_years_again(spark, sf_dir), "bronze", "alunos"))


def layer_year_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-2: which run's folder holds each year, and its rows: a run for two years wrote those only."""
    root = _two_years_again(spark, sf_dir)
    held = _rows(spark, [(int(k.split("=")[1]), v) for k, v in parts(spark, root, "bronze", "alunos").items()], "ano long, run string")
    rows = read_table(spark, root, "bronze", "alunos").groupBy(F.col("ano").cast("long").alias("ano")).agg(F.count("*").alias("n_rows"))
    return held.join(rows, "ano").select("ano", "run", "n_rows")


def _merged_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States of the silver state table by year and grade, merged over three loads; one of them was loaded wrong first and again."""
    rows = Layers(spark, sf_dir).silver_uf
    table = StateTable(spark, scratch_dir(spark, "states"), ["ano", "serie"], ["taxa_alfabetizacao"], ["sigla_uf", "rede"])
    table.load("old", rows.where("ano < 1994"))
    table.load("odd", rows.where("ano >= 1994 AND sigla_uf < 'M'").withColumn("taxa_alfabetizacao", F.lit(1000.0)).withColumn("rede", F.col("sigla_uf")))
    table.load("rest", rows.where("ano >= 1994 AND NOT sigla_uf < 'M'"))
    table.load("odd", rows.where("ano >= 1994 AND sigla_uf < 'M'"))
    return table.merged()


def gold_evolution_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-1/2/4/5: the evolution table from merged states."""
    return present(evolution(_merged_states(spark, sf_dir)))


def distinct_count_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-4: distinct states and networks from merged bitmaps."""
    return present(_merged_states(spark, sf_dir).select("ano", "serie", F.col("distinct_sigla_uf").alias("qtd_estados"), F.col("distinct_rede").alias("qtd_redes")))


def dq_coverage_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-10, DQ-11: the coverage rule from bitmaps of both sides, each merged over two loads."""
    L = Layers(spark, sf_dir)
    sides = {"mine": gold.ranking_estados(L.silver_uf, L.silver_metas).select("sigla_uf"),
             "theirs": L.silver_metas.where("escopo = 'uf' AND sigla_uf IS NOT NULL").select("sigla_uf")}
    counts = None
    for side, keys in sides.items():
        table = StateTable(spark, scratch_dir(spark, f"coverage-{side}"), [], [], ["sigla_uf"])
        table.load("first", keys.where("sigla_uf < 'N'"))
        table.load("second", keys.where("sigla_uf >= 'M'"))
        one = table.distinct_only().withColumnRenamed("distinct_sigla_uf", side)
        counts = one if counts is None else counts.join(one)
    (rule,) = [r for r in rules_for("gold") if r.kind == "coverage"]
    return present(rule_result(counts, rule, F.abs(F.col("mine") - F.col("theirs")), F.col("theirs")))


def dq_references_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ-12, JOI-7: the reference rules from key counts that several loads changed: facts in two halves, a directory that
    came too large and then lost rows, and facts that were taken back."""
    L = Layers(spark, sf_dir)
    t = LayerTables(L, materialize=True)
    out = None
    for rule in [r for r in rules_for("all") if r.kind == "references"]:
        p = rule.params
        facts = t[rule.layer, rule.table].select(F.col(p["key"]).cast("string").alias("key"))
        facts = facts.withColumn("half", F.pmod(F.xxhash64("key"), F.lit(2)))
        ref = t[tuple(p["ref"])]
        ref = ref.where(p["ref_filter_sql"]) if p.get("ref_filter_sql") else ref
        ref = ref.select(F.col(p["ref_key"]).cast("string").alias("ref_key"))
        extra = facts.where("half = 1").select(F.col("key").alias("ref_key"))  # rows that a wrong directory had
        kept = References(spark, scratch_dir(spark, "references"), "key", "ref_key", buckets=8)
        kept.load("directory and half", facts.where("half = 0"), ref.unionByName(extra))
        kept.load("other half", facts.where("half = 1").unionByName(facts.where("half = 0")))
        kept.load("corrections", gone_facts=facts.where("half = 0"), gone_directory=extra)
        orphans, rows = kept.verdict()
        one = rule_result(spark.range(1), rule, F.lit(orphans), F.lit(rows))
        out = one if out is None else out.unionByName(one)
    return present(out)


def _indexed_pupils(spark: SparkSession, sf_dir: str) -> tuple[str, list[str]]:
    """The pupil table in small files, with an index of the pupil id, which it is not clustered by; and three ids to look up."""
    root = scratch_dir(spark, "index")
    pupils = Layers(spark, sf_dir).bronze_alunos
    write_table(spark, pupils, root, "bronze", "alunos", "run-1", max_records=max(20, pupils.count() // 60))  # 60 files or more
    index_column(spark, root, "bronze", "alunos", "id_aluno")
    ids = pupils.agg(F.min("id_aluno").alias("lo"), F.max("id_aluno").alias("hi")).first()
    return root, [ids["lo"], ids["hi"], "no such pupil"]


def layer_file_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-3: rows of looked-up pupils, read from the files that the index keeps."""
    root, ids = _indexed_pupils(spark, sf_dir)
    return present(lookup(spark, root, "bronze", "alunos", "id_aluno", ids))


def layer_file_pruning(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-3: whether a lookup of each of two ids, and of one that is not there, leaves out 90 % of the files."""
    root, ids = _indexed_pupils(spark, sf_dir)
    rows = []
    for kind, one in zip(("first", "last", "none"), ids, strict=True):
        kept, total = files_for(spark, root, "bronze", "alunos", "id_aluno", [one])
        rows.append((kind, len(kept) <= 0.1 * total))
    return _rows(spark, rows, "lookup string, pruned boolean")


LAYER_QUERIES = {
    "layer_receipts": layer_receipts,
    "layer_bronze_municipality": _read_back("bronze", "alfabetizacao_municipio"),
    "layer_silver_state": _read_back("silver", "alfabetizacao_uf_clean"),
    "layer_gold_panel": _read_back("gold", "painel_municipios"),
    "layer_partitions": layer_partitions,
    "layer_clustering": layer_clustering,
    "layer_audit": layer_audit,
    "layer_gate": layer_gate,
    "gold_evolution_states": gold_evolution_states,
    "distinct_count_states": distinct_count_states,
    "dq_coverage_states": dq_coverage_states,
    "dq_references_kept": dq_references_kept,
    "layer_file_lookup": layer_file_lookup,
    "layer_file_pruning": layer_file_pruning,
    "layer_years_rewritten": layer_years_rewritten,
    "layer_year_folders": layer_year_folders,
    "order_evolution": order_evolution,
    "order_ranking": order_ranking,
}
