"""A quality gate on the stream: every micro-batch gets a verdict, and a batch that fails is held.

The counts come with the batch's one write (``observe``), repeated messages
from the ids it wrote.  A held batch is committed as ``held``: its rows are
stored, and readers do not see them until it is released.  The verdict is part
of the commit, so verdicts and rows cannot disagree.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.streaming import commits

VERDICT = "commit string, folder string, rows long, malformed long, nulls long, out_of_range long, repeated long, held boolean"
CRITICAL = ("tipo", "timestamp", "sigla_uf", "pubsub_message_id")


@dataclass(frozen=True)
class Gate:
    """Largest shares of a batch's messages that may be malformed, lack a critical column, be out of range or come again in the batch."""

    malformed: float = 0.5
    nulls: float = 0.5
    out_of_range: float = 0.5
    repeated: float = 1.0
    critical: tuple[str, ...] = CRITICAL
    rate: str = "taxa_alfabetizacao"

    def counts(self) -> list:
        """Aggregates over written batch rows (the shape of ``ingest.batch_rows``)."""
        good = F.col("bad") == "false"
        missing = reduce(or_, [F.col(c).isNull() for c in self.critical])
        return [F.count(F.lit(1)).alias("rows"), F.count_if(~good).alias("malformed"), F.count_if(good & missing).alias("nulls"),
                F.count_if(good & ((F.col(self.rate) < 0) | (F.col(self.rate) > 100))).alias("out_of_range")]

    def holds(self, verdict: dict) -> bool:
        n = verdict["rows"]
        return n > 0 and any(verdict[k] > getattr(self, k) * n for k in ("malformed", "nulls", "out_of_range", "repeated"))


def verdicts(spark: SparkSession, bronze_dir: str) -> DataFrame:
    """One row per judged batch."""
    rows = []
    for name in commits.names(spark, bronze_dir):
        lines = dict(commits.lines_of(spark, bronze_dir, [name]))
        if "verdict" in lines:
            v = json.loads(lines["verdict"])
            rows.append((name, lines.get("rows") or lines.get("held"), v["rows"], v["malformed"], v["nulls"], v["out_of_range"], v["repeated"], "held" in lines))
    return spark.createDataFrame(rows, VERDICT)


def release(spark: SparkSession, bronze_dir: str, name: str) -> bool:
    """Show the rows of a held batch; False if it was released before."""
    lines = dict(commits.lines_of(spark, bronze_dir, [name]))
    if "held" not in lines:
        raise ValueError(f"{name} is not a held batch")
    return commits.add(spark, bronze_dir, f"released-{name}", [("rows", lines["held"])])
