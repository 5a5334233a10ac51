"""Aggregates kept as states that merge: a new load adds its own state, gold is read from the merged ones.

A state row holds, per group and measure, the exact sum (decimal), the count,
the sum of squared distances from its mean, the minimum and the maximum; and,
per group and counted column, the bitmaps of the dictionary ids of its values.
Merging is adding, taking minima and maxima, and or-ing; squared distances are
moved to the merged mean (each part's own, plus its count times the squared
distance of the two means), so nothing large is subtracted.

The states of a part (a load, a year) are one folder.  A part that is loaded
again replaces its folder, which is how late corrections of a year come in
(minima cannot be taken back from a merged state).  Parts and the dictionary
are named by commits (:mod:`strata.streaming.commits`).

The dictionary gives every distinct value of a counted column a number.  New
values are numbered within hash buckets (behind the bucket's last number), so
no task numbers all, and numbers stay dense enough for bitmaps of 32,768 bits.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.streaming import commits

SUM = "decimal(30,12)"


def _mean(total: Column, n: Column) -> Column:
    return F.when(n > 0, total.cast("double") / n)


def moments(df: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """The state of every group: ``n_, sum_, spread_, min_, max_`` of each measure."""
    aggs = []
    for m in measures:
        # var_pop * n: Spark's own partial moments, added up without cancellation.
        aggs += [F.count(m).alias(f"n_{m}"), F.sum(F.col(m).cast(SUM)).alias(f"sum_{m}"),
                 F.coalesce(F.var_pop(m) * F.count(m), F.lit(0.0)).alias(f"spread_{m}"), F.min(m).alias(f"min_{m}"), F.max(m).alias(f"max_{m}")]
    return df.groupBy(*keys).agg(*aggs)


def merged_moments(states: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """One state per group from those of the parts (a row per group and part)."""
    group, aggs = Window.partitionBy(*keys), []
    for m in measures:
        n, total = F.col(f"n_{m}"), F.col(f"sum_{m}")
        away = _mean(total, n) - _mean(F.sum(total).over(group), F.sum(n).over(group))
        states = states.withColumn(f"spread_{m}", F.col(f"spread_{m}") + F.coalesce(n * away * away, F.lit(0.0)))
        aggs += [F.sum(f"n_{m}").alias(f"n_{m}"), F.sum(f"sum_{m}").alias(f"sum_{m}"), F.sum(f"spread_{m}").alias(f"spread_{m}"),
                 F.min(f"min_{m}").alias(f"min_{m}"), F.max(f"max_{m}").alias(f"max_{m}")]
    return states.groupBy(*keys).agg(*aggs)


def mean(m: str) -> Column:
    return _mean(F.col(f"sum_{m}"), F.col(f"n_{m}"))


def stddev0(m: str) -> Column:
    """Sample standard deviation; 0 where it is undefined (one row)."""
    n = F.col(f"n_{m}")
    return F.when(n > 1, F.sqrt(F.col(f"spread_{m}") / (n - 1))).otherwise(F.lit(0.0))


class StateTable:
    """States of one table's aggregates under ``root``."""

    def __init__(self, spark: SparkSession, root: str, keys: list[str], measures: list[str], counted: list[str], buckets: int = 64) -> None:
        self.spark, self.root, self.keys, self.measures, self.counted, self.buckets = spark, root, keys, measures, counted, buckets

    # --- what is committed ---

    def _lines(self) -> list[tuple[str, str]]:
        return commits.lines_of(self.spark, self.root)

    def parts(self) -> dict[str, str]:
        """Part -> folder of its states; a later load of a part replaces the earlier one."""
        return {k[5:]: v for k, v in self._lines() if k.startswith("part:")}

    def _read(self, kind: str) -> DataFrame | None:
        if kind == "moments" and not self.measures:
            return None
        folders = [f"{self.root}/{v}/{kind}" for v in self.parts().values()]
        return self.spark.read.parquet(*folders) if folders else None

    def dictionary(self) -> DataFrame:
        """``name, value, id`` of every value ever counted."""
        schema = T.StructType([T.StructField("name", T.StringType()), T.StructField("value", T.StringType()), T.StructField("id", T.LongType())])
        return commits.read(self.spark, self.root, [v for k, v in self._lines() if k == "dictionary"], schema)

    # --- loads ---

    def load(self, part: str, rows: DataFrame) -> None:
        """Compute and commit the states of one part (its name has no blanks); an earlier load of it is replaced."""
        number = len(commits.names(self.spark, self.root))
        folder = f"load=l-{number:010d}/{commits.attempt()}"
        known = self.dictionary()
        lines = [(f"part:{part}", folder)]
        if self.measures:
            moments(rows, self.keys, self.measures).write.parquet(f"{self.root}/{folder}/moments")
        if self.counted:
            pairs = None
            for c in self.counted:
                one = rows.where(F.col(c).isNotNull()).select(*self.keys, F.lit(c).alias("name"), F.col(c).cast("string").alias("value")).distinct()
                pairs = one if pairs is None else pairs.unionByName(one)
            # Distinct (group, value) pairs, written: the new values and the bitmaps are taken from the same rows.
            pairs.write.parquet(f"{self.root}/{folder}/pairs")
            pairs = self.spark.read.schema(pairs.schema).parquet(f"{self.root}/{folder}/pairs")
            self._numbered(pairs.select("name", "value").distinct().join(known, ["name", "value"], "left_anti"), known) \
                .write.parquet(f"{self.root}/{folder}/dictionary")
            new = commits.read(self.spark, self.root, [f"{folder}/dictionary"], known.schema)
            ids = pairs.join(known.unionByName(new), ["name", "value"])
            ids.groupBy(*self.keys, "name", F.bitmap_bucket_number("id").alias("slot")).agg(
                F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bits")).write.parquet(f"{self.root}/{folder}/bitmaps")
            lines.append(("dictionary", f"{folder}/dictionary"))
        if not commits.add(self.spark, self.root, f"{number:010d}", lines):
            raise RuntimeError(f"{self.root}: another load was committed as number {number}; load {part} again")

    def _numbered(self, values: DataFrame, known: DataFrame) -> DataFrame:
        bucket = F.pmod(F.xxhash64("name", "value"), F.lit(self.buckets))
        # Ids of a bucket are bucket, bucket + buckets, ...; the last one in use per name and bucket.
        last = known.groupBy(F.col("name").alias("k"), F.pmod(F.col("id"), F.lit(self.buckets)).alias("b")).agg(F.max("id").alias("last"))
        mine = values.withColumn("bucket", bucket)
        joined = mine.join(last, (mine["name"] == last["k"]) & (mine["bucket"] == last["b"]), "left")
        nth = F.row_number().over(Window.partitionBy("name", "bucket").orderBy("value"))
        return joined.select("name", "value", (F.coalesce("last", F.col("bucket") - self.buckets) + nth * self.buckets).cast("long").alias("id"))

    # --- reads ---

    def _distinct(self, c: str) -> DataFrame:
        whole = self._read("bitmaps").where(F.col("name") == c).groupBy(*self.keys, "slot").agg(F.bitmap_or_agg("bits").alias("bits"))
        return whole.groupBy(*self.keys).agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).cast("long").alias(f"distinct_{c}"))

    def merged(self) -> DataFrame | None:
        """One row per group: its moments and, per counted column ``c``, ``distinct_c``; None before the first load."""
        stored = self._read("moments")
        if stored is None:
            return None
        out = merged_moments(stored, self.keys, self.measures)
        for c in self.counted:
            counts = self._distinct(c)
            same = reduce(and_, [out[k].eqNullSafe(counts[k]) for k in self.keys])
            out = out.join(counts, same, "left").select(*(out[x] for x in out.columns), F.coalesce(counts[f"distinct_{c}"], F.lit(0)).cast("long").alias(f"distinct_{c}"))
        return out

    def distinct_only(self) -> DataFrame:
        """Without groups: one row with the distinct count of the (one) counted column."""
        (c,) = self.counted
        return self._distinct(c)


def evolution(states: DataFrame) -> DataFrame:
    """``gold.evolucao_temporal_brasil`` from merged states by year and grade."""
    rate = "taxa_alfabetizacao"
    return states.select("ano", "serie", mean(rate).alias("taxa_media_brasil"), F.col(f"min_{rate}").alias("taxa_min_estado"),
                         F.col(f"max_{rate}").alias("taxa_max_estado"), stddev0(rate).alias("desvio_padrao"),
                         F.col("distinct_sigla_uf").alias("qtd_estados")).orderBy("ano", "serie")
