"""Layer runner: build, write, count, gate.

Tables are written as parquet under ``<root>/<layer>/<table>/run=<id>``: every
run writes a fresh folder (a layer never overwrites the data it reads) and,
once the data is committed, an empty marker ``_runs/<id>``; readers list the
markers and take the latest.  A crash at any point leaves the previous version
readable.  A run for some years (``run(years=...)``) writes only the year
folders of those years; its marker is a manifest that names, for every year of
the table, the run whose folder holds it, so a version may mix folders of many
runs.  The row count comes with the write through ``DataFrame.observe`` (no
second scan).  Independent tables of a layer are submitted from a small thread
pool so their jobs share the cluster.  A failed table ends the run with
:class:`LayerError`; with the gate on, each layer's rules are enforced before
the next layer is built from it.
"""

from __future__ import annotations

import json
import logging
import time
import uuid
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.plans import bronze, gold, silver
from strata.plans.quality import enforce, evaluate, rules_for
from strata.plans.registry import SPECS, spec
from strata.session import hadoop_path, scratch_dir

log = logging.getLogger("strata")

MAX_RECORDS_PER_FILE = 5_000_000


class LayerError(RuntimeError):
    """A table could not be built or written; ``report`` holds what was done."""

    def __init__(self, layer: str, report: dict):
        failed = {n: r["error"] for n, r in report[layer].items() if "error" in r}
        super().__init__(f"{layer}: " + "; ".join(f"{n}: {e}" for n, e in failed.items()))
        self.report = report


class ConcurrentWrite(RuntimeError):
    """Another run committed a version of the table while this one built on the one before."""


def _markers(root: str, layer: str, name: str) -> str:
    return f"{root}/{layer}/{name}/_runs"


def clustered(df: DataFrame, order: list[str], ranges: int = 0) -> DataFrame:
    """Rows range-partitioned and sorted by ``order``.

    Each file then holds a narrow range (min/max statistics skip the others)
    and a partition value is in few files.  A hash of the row comes last in
    the range key, so one hot value is split over several files.  Spark samples
    the rows of a range partitioning, so the plan of ``df`` runs twice.  With
    more ``ranges`` than the session's shuffle partitions there are that many;
    otherwise Spark takes its own number and joins small ones.
    """
    many = [ranges] if ranges > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else []
    return df.repartitionByRange(*many, *[F.col(c) for c in order], _row_hash(df)).sortWithinPartitions(*order)


def _row_hash(df: DataFrame) -> Column:
    return F.xxhash64(*[f.name for f in df.schema.fields if not isinstance(f.dataType, T.MapType)])


ROWS_PER_RANGE = 1_000_000
#: Input (compressed) behind a range, so a task sorts about as much at any size and its sort stays in memory.
BYTES_PER_RANGE = 8 << 20
#: More ranges than these only where the session asks for more shuffle partitions: from there on ranges grow.
MAX_RANGES = 20_000
#: From this size of its inputs on, a table's rows are not computed twice for their layout; below it the extra jobs cost more.
ONCE_FROM_BYTES = 4 << 30
#: With more key values than these, the rows' ranges are no small table that a join could broadcast.
MOST_KEYS = 200_000


def scanned_bytes(df: DataFrame) -> int:
    """Size of the files (or other leaves) that a plan reads, as the planner knows it."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def clustered_once(df: DataFrame, order: list[str]) -> DataFrame:
    """The same layout for large tables (:data:`ONCE_FROM_BYTES`), with one evaluation of the rows.

    A first pass counts the rows per value of the first two columns of
    ``order``; it reads these columns only.  Running totals over the counts cut
    the values into ranges of about equal rows (a value with more than a range
    gets several, by a hash of the row), and the rows go to their range by its
    number.  The counts are written, so they are broadcast only by their size.
    With more than :data:`MOST_KEYS` values the join would shuffle all rows
    once more than the second evaluation that it saves, so those rows are
    ranged by :func:`clustered`.
    """
    spark, keys = df.sparkSession, order[:2]
    path = scratch_dir(spark, "ranges")
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    counts.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id()).write.parquet(path)
    seen = spark.read.parquet(path).withColumn("_part", F.shiftright("_at", 33))
    offsets, total, values = [], 0, 0
    for part, n, different in sorted(map(tuple, seen.groupBy("_part").agg(F.sum("_n").alias("n"), F.count("*").alias("v")).collect())):  # a row per partition
        offsets.append((part, total))
        total += n
        values += different
    coalesce = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled") == "true"
    shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = min(-(-total // ROWS_PER_RANGE), max(MAX_RANGES, shuffles))
    size = max(-(-total // max(ranges, 1 if coalesce else shuffles)), 1)
    if values > MOST_KEYS:
        return clustered(df, order, ranges)
    within = Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("_offset") + F.coalesce(F.sum("_n").over(within), F.lit(0))
    placed = seen.join(spark.createDataFrame(offsets, "_part long, _offset long"), "_part").select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.floor(before / size).alias("_first"), F.ceil(F.col("_n") / size).alias("_parts"))
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])
    at = F.col("_first") + F.pmod(_row_hash(df), F.col("_parts"))
    ranged = df.join(placed, same).withColumn("_range", at.cast("int")).repartitionById(-(-total // size) + 1, F.col("_range"))
    return ranged.sortWithinPartitions(*order).select(*df.columns)


def _write_rows(df: DataFrame, root: str, layer: str, name: str, run_id: str, max_records: int = MAX_RECORDS_PER_FILE) -> int:
    s = spec(layer, name)
    order = [*s.partition_by, *s.cluster_by]
    obs = Observation(f"{layer}.{name}")
    laid = df
    if order:
        inputs = scanned_bytes(df)
        ranges = min(-(-inputs // BYTES_PER_RANGE), MAX_RANGES) if s.partition_by else 0
        laid = clustered_once(df, order) if s.partition_by and s.cluster_by and inputs >= ONCE_FROM_BYTES else clustered(df, order, ranges)
    out = laid.observe(obs, F.count(F.lit(1)).alias("rows"))
    writer = out.write.mode("overwrite").option("maxRecordsPerFile", max_records)
    if s.partition_by:
        writer = writer.partitionBy(*s.partition_by)
    writer.parquet(f"{root}/{layer}/{name}/run={run_id}")
    return int(obs.get["rows"])


def write_table(spark: SparkSession, df: DataFrame, root: str, layer: str, name: str,
                run_id: str, max_records: int = MAX_RECORDS_PER_FILE) -> int:
    """Write ``df`` as the new version of ``layer.name`` and return its row count."""
    rows = _write_rows(df, root, layer, name, run_id, max_records)
    fs, marker = hadoop_path(spark, f"{_markers(root, layer, name)}/{run_id}")
    fs.create(marker).close()
    return rows


def _folders(spark: SparkSession, root: str, layer: str, name: str, run_id: str) -> list[str]:
    """The partition folders that a run wrote."""
    fs, where = hadoop_path(spark, f"{root}/{layer}/{name}/run={run_id}")
    return sorted(n for s in fs.listStatus(where) if "=" in (n := s.getPath().getName()))


def manifest(spark: SparkSession, root: str, layer: str, name: str, run_id: str) -> dict | None:
    """``{"schema": ..., "parts": {partition folder: run id}}`` of a version, or None where all is in its own run's folder."""
    fs, marker = hadoop_path(spark, f"{_markers(root, layer, name)}/{run_id}")
    if not fs.getFileStatus(marker).getLen():
        return None
    stream = fs.open(marker)
    text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    stream.close()
    return json.loads(text)


def parts(spark: SparkSession, root: str, layer: str, name: str) -> dict[str, str]:
    """Partition folder -> run that wrote it, in the current version."""
    known = versions(spark, root, layer, name)
    if not known:
        return {}
    told = manifest(spark, root, layer, name, known[-1])
    return told["parts"] if told else {f: known[-1] for f in _folders(spark, root, layer, name, known[-1])}


def write_years(spark: SparkSession, df: DataFrame, root: str, layer: str, name: str, run_id: str, years: list[int]) -> int:
    """Replace some years of a year-partitioned table: only their rows are computed and written; years without rows go.

    The other years stay in the folders that hold them now.  Raises
    :class:`ConcurrentWrite`, and shows nothing, if another version came meanwhile.
    """
    (column,) = spec(layer, name).partition_by
    base = versions(spark, root, layer, name)[-1:]
    now = parts(spark, root, layer, name)
    rows = _write_rows(df.where(F.col(column).isin(*years)), root, layer, name, run_id)
    gone = {f"{column}={y}" for y in years}
    placed = {k: v for k, v in now.items() if k not in gone} | {f: run_id for f in _folders(spark, root, layer, name, run_id)}
    if versions(spark, root, layer, name)[-1:] != base:
        raise ConcurrentWrite(f"{layer}.{name}: another version came after {base}; run the years again")
    _mark(spark, root, layer, name, run_id, {"schema": json.loads(df.schema.json()), "parts": placed})
    return rows


def _mark(spark: SparkSession, root: str, layer: str, name: str, run_id: str, told: dict) -> None:
    """Commit a version with a manifest: written beside, then renamed."""
    fs, marker = hadoop_path(spark, f"{_markers(root, layer, name)}/{run_id}")
    fs.mkdirs(marker.getParent())
    draft = hadoop_path(spark, f"{root}/{layer}/{name}/run={run_id}/_manifest")[1]
    out = fs.create(draft)
    out.write(bytearray(json.dumps(told), "utf-8"))
    out.close()
    if not fs.rename(draft, marker):
        raise ConcurrentWrite(f"{layer}.{name}: cannot commit {run_id}")


def expire(spark: SparkSession, root: str, layer: str, name: str, keep: int) -> list[str]:
    """Delete all but the last ``keep`` committed versions (marker first); returns the ids that went.

    Data of an older run stays as long as a kept version's manifest names it.
    """
    known = versions(spark, root, layer, name)
    old, kept = (known[:-keep], known[-keep:]) if keep > 0 else ([], known)
    used = set(kept)
    for run_id in kept:
        used |= set((manifest(spark, root, layer, name, run_id) or {"parts": {}})["parts"].values())
    for run_id in old:
        for path in (f"{_markers(root, layer, name)}/{run_id}", *([] if run_id in used else [f"{root}/{layer}/{name}/run={run_id}"])):
            fs, where = hadoop_path(spark, path)
            fs.delete(where, True)
    return old


def save_bucketed(df: DataFrame, table: str, path: str, buckets: int, keys: list[str],
                  partition_by: tuple[str, ...] = ()) -> None:
    """Save ``df`` as a catalog table at ``path`` (external), bucketed and sorted
    on ``keys``.  Two such tables with the same bucket count join on ``keys``
    bucket by bucket: neither side is shuffled at read time."""
    writer = (df.write.mode("overwrite").format("parquet").option("path", path)
              .bucketBy(buckets, *keys).sortBy(*keys))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(table)


def versions(spark: SparkSession, root: str, layer: str, name: str) -> list[str]:
    """Ids of the committed versions, oldest first (ids start with a UTC timestamp); none when never written.

    Only a missing folder means "never written"; any other read error is raised.
    """
    fs, folder = hadoop_path(spark, _markers(root, layer, name))
    if not fs.exists(folder):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(folder))


def table_path(spark: SparkSession, root: str, layer: str, name: str) -> str | None:
    """Folder of the latest committed version, or None when never written."""
    known = versions(spark, root, layer, name)
    return f"{root}/{layer}/{name}/run={known[-1]}" if known else None


def read_table(spark: SparkSession, root: str, layer: str, name: str) -> DataFrame | None:
    """The latest committed version; a filter on the partition column prunes folders, whichever runs wrote them."""
    known = versions(spark, root, layer, name)
    told = manifest(spark, root, layer, name, known[-1]) if known else None
    if told is None:
        path = table_path(spark, root, layer, name)
        return spark.read.parquet(path) if path else None
    base = f"{root}/{layer}/{name}"
    if not told["parts"]:
        return spark.createDataFrame([], T.StructType.fromJson(told["schema"]))
    return spark.read.option("basePath", base).parquet(*(f"{base}/run={r}/{f}" for f, r in sorted(told["parts"].items()))).drop("run")


def table_state(spark: SparkSession, root: str, layer: str, name: str) -> tuple[bool, int]:
    """(exists, rows) of the current version."""
    df = read_table(spark, root, layer, name)
    return (False, 0) if df is None else (True, df.count())


def _write_layer(spark, root, layer, builders: dict, run_id, threads, years: list[int] | None) -> dict:
    results: dict[str, dict] = {}

    def one(name):
        t0 = time.time()
        try:
            some = years is not None and spec(layer, name).partition_by
            rows = (write_years(spark, builders[name](), root, layer, name, run_id, years) if some
                    else write_table(spark, builders[name](), root, layer, name, run_id))
            return name, {"rows": rows, "seconds": round(time.time() - t0, 3)}
        except Exception as e:  # noqa: BLE001 - the other tables finish, then the run fails
            log.error("%s.%s failed: %s", layer, name, e)
            return name, {"error": f"{type(e).__name__}: {e}"}

    with ThreadPoolExecutor(max_workers=threads) as pool:
        for name, res in pool.map(one, list(builders)):
            results[name] = res
    return results


def run(spark: SparkSession, sources: Mapping[str, DataFrame], root: str,
        layers=("bronze", "silver", "gold", "quality"), events: DataFrame | None = None,
        gate: bool = True, threads: int = 3, keep_versions: int | None = None, years: list[int] | None = None) -> dict:
    """Build the requested layers in order; returns per-table rows and the rule results.

    ``sources`` are the batch inputs by name (``sources.registered`` or the
    test views); ``events`` is an optional bronze event table (the stream's
    output).  With ``quality`` among the layers, the rules of each layer built
    are evaluated before the next one starts, the rest at the end, and all
    results are written to ``quality.results``; with ``gate`` a failed rule
    raises after the results are written.  ``keep_versions`` deletes older
    versions of what was written.  With ``years``, the year-partitioned tables
    are built and written for those years only (their rows of a year come from
    that year of their inputs alone); the other tables, which are small, whole.
    """
    now = time.time()
    run_id = (time.strftime("%Y%m%dT%H%M%S", time.gmtime(now)) + f"{int(now * 1e6) % 1_000_000:06d}"
              + "-" + uuid.uuid4().hex[:8])
    report: dict = {"run_id": run_id}
    checked: list[str] = []
    verdicts: list = []

    def rd(layer, name):
        return read_table(spark, root, layer, name)

    def by_year(name):
        """A bronze input of a table that is written by year."""
        df = rd("bronze", name)
        return df if years is None else df.where(F.col("ano").isin(*years))

    def check(*which: str) -> None:
        """Evaluate the rules of layers over the written tables, write all results so far, and enforce."""
        tables = {k: df for k in SPECS if (df := rd(*k)) is not None}
        if "dicionario" in sources:
            tables["source", "dicionario"] = sources["dicionario"]
        stream = ("silver", "streaming_eventos_clean") in tables
        results = evaluate(spark, tables, [r for layer in which for r in rules_for(layer, stream)])
        verdicts.extend(results.collect())  # one row per rule
        checked.extend(which)
        report["quality"] = [r.asDict() for r in verdicts]
        write_table(spark, spark.createDataFrame(verdicts, results.schema), root, "quality", "results", f"{run_id}-{len(checked)}")
        if gate:
            enforce(rd("quality", "results"))

    def build(layer: str, builders: dict) -> None:
        report[layer] = _write_layer(spark, root, layer, builders, run_id, threads, years)
        if any("error" in r for r in report[layer].values()):
            raise LayerError(layer, report)
        if keep_versions:
            for name in builders:
                expire(spark, root, layer, name, keep_versions)
        if "quality" in layers:
            check(layer)

    if "bronze" in layers:
        def inputs(name: str) -> Mapping[str, DataFrame]:
            """The sources; those with years cut to the wanted ones for a table that is written by year."""
            if years is None or not spec("bronze", name).partition_by:
                return sources
            fact = bronze.FACTS[name]
            return {k: (sources[k].where(F.col("ano").isin(*years)) if k == fact else sources[k]) for k in (fact, "dicionario", "dir_municipio")}

        builders = {name: (lambda name=name, fn=fn: fn(inputs(name))) for name, fn in bronze.BUILDERS.items()}
        if events is not None:
            builders["streaming_eventos"] = lambda: events
        build("bronze", builders)
    if "silver" in layers:
        builders = {
            "alfabetizacao_uf_clean": lambda: silver.alfabetizacao_uf_clean(rd("bronze", "alfabetizacao_uf")),
            "metas_consolidadas": lambda: silver.metas_consolidadas(
                rd("bronze", "meta_brasil"), rd("bronze", "meta_uf"), rd("bronze", "meta_municipio")),
            "alfabetizacao_municipio_clean": lambda: silver.alfabetizacao_municipio_clean(
                by_year("alfabetizacao_municipio")),
            "alunos_clean": lambda: silver.alunos_clean(by_year("alunos")),
        }
        if table_path(spark, root, "bronze", "streaming_eventos"):
            builders["streaming_eventos_clean"] = lambda: silver.streaming_eventos_clean(
                rd("bronze", "streaming_eventos"))
        build("silver", builders)
    if "gold" in layers:
        build("gold", {
            "indicador_por_uf_ano": lambda: gold.indicador_por_uf_ano(
                rd("silver", "alfabetizacao_uf_clean"), rd("silver", "metas_consolidadas")),
            "evolucao_temporal_brasil": lambda: gold.evolucao_temporal_brasil(
                rd("silver", "alfabetizacao_uf_clean")),
            "ranking_estados": lambda: gold.ranking_estados(
                rd("silver", "alfabetizacao_uf_clean"), rd("silver", "metas_consolidadas")),
            "perfil_desempenho_uf": lambda: gold.perfil_desempenho_uf(rd("silver", "alfabetizacao_uf_clean")),
            "painel_municipios": lambda: gold.painel_municipios(
                rd("silver", "alfabetizacao_municipio_clean"), rd("silver", "metas_consolidadas")),
        })
    if "quality" in layers and (rest := [x for x in ("bronze", "silver", "gold") if x not in checked]):
        check(*rest)
    return report
