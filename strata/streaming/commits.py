"""Commits of a folder that batches write to: what no marker names does not exist.

A batch writes its rows into a folder of its own attempt and then puts one
small marker file into ``commits/``, which names that folder.  The marker comes
by a rename, so a reader sees all outputs of a batch or none.  An attempt that
died leaves a folder that nobody reads.  A batch that is run again after its
commit finds its marker and leaves everything as it is.

Markers hold ``key folder`` lines, folders relative to the root.  They are
plain text files, so a stream can follow them (:func:`follow`).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader

from strata.session import hadoop_path


def _folder(root: str) -> str:
    return f"{root}/commits"


def names(spark: SparkSession, root: str) -> list[str]:
    """The committed batches, in the order of their names; none where nothing was ever committed."""
    fs, folder = hadoop_path(spark, _folder(root))
    if not fs.exists(folder):
        return []
    return sorted(n for s in fs.listStatus(folder) if (n := s.getPath().getName())[0] not in "._")


def has(spark: SparkSession, root: str, name: str) -> bool:
    fs, marker = hadoop_path(spark, f"{_folder(root)}/{name}")
    return bool(fs.exists(marker))


def add(spark: SparkSession, root: str, name: str, lines: list[tuple[str, str]]) -> bool:
    """Commit ``lines`` under ``name``; False, and no change, if that name is committed already."""
    fs, marker = hadoop_path(spark, f"{_folder(root)}/{name}")
    fs.mkdirs(marker.getParent())
    draft = hadoop_path(spark, f"{_folder(root)}/_{name}-{uuid.uuid4().hex[:8]}")[1]
    out = fs.create(draft)
    out.write(bytearray("".join(f"{k} {v}\n" for k, v in lines), "utf-8"))
    out.close()
    if fs.exists(marker) or not fs.rename(draft, marker):
        fs.delete(draft, False)
        return False
    return True


def parse(lines: list[str]) -> list[tuple[str, str]]:
    return [tuple(line.split(" ", 1)) for line in lines if line]


def lines_of(spark: SparkSession, root: str, which: list[str] | None = None) -> list[tuple[str, str]]:
    """The lines of the named commits (all): one per folder, so a small list beside the data."""
    found = names(spark, root) if which is None else which
    jvm = spark.sparkContext._jvm
    out = []
    for name in found:
        fs, marker = hadoop_path(spark, f"{_folder(root)}/{name}")
        stream = fs.open(marker)
        text = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        stream.close()
        out += parse(text.split("\n"))
    return out


def read(spark: SparkSession, root: str, folders: list[str], schema: T.StructType) -> DataFrame:
    """The rows of some committed folders, with the columns of their ``name=value`` parts that ``schema`` names."""
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", root).parquet(*(f"{root}/{f}" for f in folders)).select(*schema.fieldNames())


def follow(spark: SparkSession, root: str, per_batch: int = 100) -> DataFrame:
    """The commits of a root as a stream of their lines (``value``), at most ``per_batch`` commits a time."""
    fs, folder = hadoop_path(spark, _folder(root))
    fs.mkdirs(folder)
    reader: DataStreamReader = spark.readStream.option("maxFilesPerTrigger", per_batch)
    return reader.text(_folder(root))


def attempt() -> str:
    return f"attempt=a-{uuid.uuid4().hex[:12]}"
