"""Mixing sources to target weights.

The words of a source form one stream (its documents in a fixed pseudorandom
order), packed into blocks of ``block`` words.  A source's target is its share
of the mix by weight, held at ``max_repeat`` times its size; the mix has as
many slots as the targets need blocks, in output shards of ``shard_slots``.

How many slots of a shard belong to each source is a multinomial draw, made
with the totals fixed: the slots of a range of shards are split between its
halves by a draw without replacement (hypergeometric per source, one after the
other), down to single shards.  A draw depends on the range alone, so every
task makes those on the way to its own shards, nothing is drawn on the driver,
reruns agree, and the sources' totals are exact.  A shard's slots of a source
are consecutive numbers; they go through the source's own pseudorandom index
permutation to blocks, and slots and blocks meet in a join on the block index.
Blocks repeat only once all of the source's blocks were used, so no word is
taken more than ``max_repeat`` times; the last slot of a source takes just the
words that are missing to the target.

A hot source is no hot task: its documents are hashed into buckets, as many as
the number of rows needs, running sums are taken per bucket, and the few bucket
totals give the offsets.  Equal rows (id, source and text) are one row with a
count until they are cut into blocks, where long counts are spread.  The driver
holds one row per source (its configuration); more than ``max_sources`` raise.

Defined cases: a NULL source is one source, ordered last; a NULL, empty or
blank text has size 0 and is never taken; an empty table gives an empty mix;
repeated rows are separate documents, also with NULL ids; extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import n_words, words, written
from strata.llm.textnp import U, mix

WEIGHTS = (5, 2, 1)


def targets(sizes: list[int], weights: list[float], share: float = 1.5, max_repeat: float = 2.0) -> list[float]:
    """Words per source: ``share`` of all words by weight, each at most ``max_repeat`` times its size, the excess reshared."""
    out = [0.0] * len(sizes)
    left, free = share * sum(sizes), [i for i, s in enumerate(sizes) if s > 0]
    while free:
        unit = left / sum(weights[i] for i in free)
        full = [i for i in free if weights[i] * unit > max_repeat * sizes[i]]
        for i in full or free:
            out[i] = float(max_repeat * sizes[i]) if full else weights[i] * unit
        if not full:
            break
        left -= sum(out[i] for i in full)
        free = [i for i in free if i not in set(full)]
    return out


def permuted(i: np.ndarray, n: int | np.ndarray, seed: int | np.ndarray, back: bool = False) -> np.ndarray:
    """A pseudorandom permutation of ``0..n-1`` at ``i`` (``back``: its inverse): a four-round Feistel network with cycle walking; ``n`` and ``seed`` per value or one for all."""
    x, n = i.astype(U), np.broadcast_to(np.asarray(n, U), i.shape)
    seed = np.broadcast_to(np.asarray(seed, U), i.shape)
    half = np.ones(i.shape, U)
    for _ in range(32):
        half += (half < U(32)) & ((U(1) << (U(2) * half)) < n)
    mask = (U(1) << half) - U(1)
    todo = np.arange(len(x))
    while len(todo):
        h, m, s = half[todo], mask[todo], seed[todo]
        a, b = x[todo] >> h, x[todo] & m
        for r in (4, 3, 2, 1) if back else (1, 2, 3, 4):
            turn = mix((a if back else b) + s * U(0x9E3779B97F4A7C15) + U(r * 0xD1342543DE82EF95 & (1 << 64) - 1)) & m
            a, b = (b ^ turn, a) if back else (b, a ^ turn)
        x[todo] = a << h | b
        todo = todo[x[todo] >= n[todo]]
    return x.astype(np.int64)


class Plan:
    """The mix of one corpus: per source size, target, blocks and slots, and the positions of its slots."""

    def __init__(self, sources: list[tuple[str | None, int]], block: int, share: float, max_repeat: float):
        # Code point order is the order of the UTF-8 bytes; NULL comes last.
        sources = sorted(sources, key=lambda s: (s[0] is None, (s[0] or "").encode()))
        self.names = [s for s, _ in sources]
        self.sizes = [n for _, n in sources]
        self.weights = [WEIGHTS[i % len(WEIGHTS)] for i in range(len(sources))]
        self.targets = targets(self.sizes, self.weights, share, max_repeat)
        self.words = [min(round(t), int(max_repeat * n)) for t, n in zip(self.targets, self.sizes, strict=True)]
        self.block = block
        self.blocks = [-(-n // block) for n in self.sizes]
        self.slots = [self._slots(i) for i in range(len(sources))]
        self.first = np.concatenate(([0], np.cumsum(self.slots))).astype(np.int64)

    def _slots(self, i: int) -> int:
        size, words = self.sizes[i], self.words[i]
        if not size:
            return 0
        passes, rest = divmod(words, size)
        return int(passes * self.blocks[i] + self._prefix_blocks(i, passes, rest))

    def _short(self, i: int, seed: int) -> int:
        """Position, within a pass, of the source's partial last block (or past the end)."""
        size, n = self.sizes[i], self.blocks[i]
        if size % self.block == 0:
            return n
        return int(permuted(np.array([n - 1]), n, seed, back=True)[0])

    def _prefix_blocks(self, i: int, passes: int, rest: int) -> int:
        """Slots of the last, partial pass that together hold ``rest`` words."""
        if not rest:
            return 0
        n = -(-rest // self.block)
        lost = self.block - (self.sizes[i] % self.block or self.block)
        short = self._short(i, seed_of(i))
        return n if short >= n or n * self.block - lost >= rest else n + 1

    def cut(self, i: int) -> tuple[int, int]:
        """The last slot of source ``i`` and the words it takes."""
        size, words = self.sizes[i], self.words[i]
        passes, rest = divmod(words, size) if size else (0, 0)
        if not rest:
            return -1, 0
        m = self._prefix_blocks(i, passes, rest)
        short = self._short(i, seed_of(i))
        lost = self.block - (size % self.block or self.block)
        return self.slots[i] - 1, rest - ((m - 1) * self.block - (lost if short < m - 1 else 0))


def seed_of(i: int) -> int:
    return i + 1


def _drawn(rng: np.random.Generator, counts: np.ndarray, n: int) -> np.ndarray:
    """How many of ``n`` slots drawn without replacement belong to each source."""
    out, total = np.zeros(len(counts), np.int64), int(counts.sum())
    for i, c in enumerate(counts.tolist()):
        if n <= 0:
            break
        rest = total - c
        least, most = max(0, n - rest), min(c, n)
        if least == most:
            x = least
        elif total < 10 ** 9:
            x = int(rng.hypergeometric(c, rest, n))
        else:  # beyond the generator's range: the normal law of the same mean and variance
            share = c / total
            spread = n * share * (1 - share) * (total - n) / (total - 1)
            x = min(most, max(least, round(n * share + rng.standard_normal() * spread ** 0.5)))
        out[i] = x
        n -= x
        total = rest
    return out


def shard_counts(slots: np.ndarray, shard_slots: int, lo: int, hi: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """``(shard, sources, counts, first numbers)`` of the shards ``lo`` to ``hi``, drawn from the slots of all sources."""
    total = int(slots.sum())
    todo = [(0, -(-total // shard_slots), np.flatnonzero(slots), slots[slots > 0], np.zeros(int((slots > 0).sum()), np.int64))]
    while todo:
        a, b, src, counts, first = todo.pop()
        if b <= lo or a >= hi or a >= b:
            continue
        if b - a == 1:
            yield a, src, counts, first
            continue
        mid = (a + b) // 2
        left = _drawn(np.random.default_rng([a, b, total]), counts, (mid - a) * shard_slots)
        right = counts - left
        for x, y, c, f in ((mid, b, right, first + left), (a, mid, left, first)):
            some = c > 0
            todo.append((x, y, src[some], c[some], f[some]))


def slot_table(spark, plan: Plan, shard_slots: int = 1024) -> DataFrame:
    """``(shard, slot, src, block, take)``: every slot of the mix, ``take`` its number of words."""
    all_slots = np.array(plan.slots or [0], np.int64)
    blocks, sizes = np.array(plan.blocks or [0], np.int64), np.array(plan.sizes or [0], np.int64)
    cuts = np.array([plan.cut(i) for i in range(len(plan.names))] or [(-1, 0)], np.int64)
    size, shards = plan.block, -(-int(all_slots.sum()) // shard_slots)

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column(0).to_numpy()  # consecutive, as they come from a range
            for shard, src, counts, first in shard_counts(all_slots, shard_slots, int(ids[0]), int(ids[-1]) + 1):
                of = np.repeat(src, counts)
                k = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(first, counts)
                slot = shard * shard_slots + permuted(np.arange(len(of)), len(of), shard)
                block = permuted(k % blocks[of], blocks[of], of + 1)
                take = np.minimum(size, sizes[of] - block * size)
                take = np.where(k == cuts[of, 0], cuts[of, 1], take)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(of), shard)), pa.array(slot), pa.array(of), pa.array(block), pa.array(take)],
                                                 names=["shard", "slot", "src", "block", "take"])

    n = max(1, min(shards // 64 + 1, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    return spark.range(0, shards, 1, n).mapInArrow(run, "shard long, slot long, src long, block long, take long")


BUCKET_ROWS = 20_000


def _digest(text_col: str):
    return F.substring(F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)), 1, 16)


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``(doc_id, source, digest, size, copies, bucket, row, at)``: each distinct row's number of words, how often it stands in
    the table, and the place of its first copy in its source's word stream; the others follow."""
    sized = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), n_words(F.col(text_col)).alias("size"), _digest(text_col).alias("digest"))
    sized = written(sized.groupBy("doc_id", "source", "size", "digest").agg(F.count("*").alias("copies")), "mix-sizes")
    buckets = max(16, -(-sized.count() // BUCKET_ROWS))
    sized = sized.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "digest"), F.lit(buckets)))
    order = Window.partitionBy("source", "bucket").orderBy(F.xxhash64("digest", "doc_id"), "doc_id", "digest")
    within = order.rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    words_of = F.col("size") * F.col("copies")
    totals = sized.groupBy("source", "bucket").agg(F.sum(words_of).alias("n")) \
        .select(F.col("source").alias("_s"), F.col("bucket").alias("_b"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    placed = sized.select("*", F.coalesce(F.sum(words_of).over(within), F.lit(0)).alias("in_bucket"), F.row_number().over(order).alias("row"))
    return written(placed.join(totals, F.col("source").eqNullSafe(F.col("_s")) & (F.col("bucket") == F.col("_b")))
                   .select("doc_id", "source", "digest", "size", "copies", "bucket", "row", (F.col("base") + F.col("in_bucket")).alias("at")), "mix-packed")


def plan_mix(packed: DataFrame, block: int = 128, share: float = 1.5, max_repeat: float = 2.0, max_sources: int = 100_000) -> Plan:
    """The plan from the sizes per source, one row per source on the driver."""
    rows = packed.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("n")).limit(max_sources + 1).collect()
    if len(rows) > max_sources:
        raise ValueError(f"more than {max_sources} sources: a mix needs a weight for each")
    return Plan([(r["source"], r["n"]) for r in rows], block, share, max_repeat)


#: A document among the pieces: its distinct row and which copy of it.
ROW = ["src", "bucket", "row", "copy"]
SPREAD = 1000


def pieces(packed: DataFrame, plan: Plan) -> DataFrame:
    """Packed documents cut at block borders: one row per document and block (none: NULL block), ``lo`` to ``hi`` within the block."""
    spark, size = packed.sparkSession, plan.block
    rows = [(i, s, float(t), n) for i, (s, t, n) in enumerate(zip(plan.names, plan.targets, plan.sizes, strict=True))]
    info = spark.createDataFrame(rows, "src long, _s string, target double, source_size long")
    # A row of the configuration per source; copies of a row are dealt out in runs, so one row with very many is no task.
    named = packed.join(F.broadcast(info), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    few = named.where(F.col("copies") <= SPREAD).withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    runs = named.where(F.col("copies") > SPREAD).withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / SPREAD))))
    first = F.col("run") * SPREAD
    many = runs.repartition("src", "bucket", "row", "run").withColumn(
        "copy", F.explode(F.sequence(first, F.least(first + SPREAD, F.col("copies")) - 1))).drop("run")
    one = few.unionByName(many).withColumn("at", F.col("at") + F.col("copy") * F.col("size"))
    last = F.col("at") + F.col("size")
    spans = F.when(F.col("size") > 0, F.sequence(F.floor(F.col("at") / size), F.floor((last - 1) / size)))
    return (one.select("doc_id", "source", "digest", *ROW, "size", "at", "target", "source_size", F.explode_outer(spans).alias("block"))
            .withColumn("first", F.col("block").isNull() | (F.col("block") == F.floor(F.col("at") / size)))
            .withColumn("lo", F.greatest(F.lit(0), F.col("at") - F.col("block") * size))
            .withColumn("hi", F.least(F.lit(size), last - F.col("block") * size)))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                block: int = 128, share: float = 1.5, max_repeat: float = 2.0) -> tuple[DataFrame, DataFrame, Plan]:
    """``(pieces, slots, plan)``: the packed documents cut into blocks, every slot of the mix, and the plan."""
    packed = pack(docs, id_col, text_col, source_col)
    plan = plan_mix(packed, block, share, max_repeat)
    # Written: a shard is one number and many slots, which the planner cannot know before it joins them.
    return pieces(packed, plan), written(slot_table(docs.sparkSession, plan), "mix-slots"), plan


def joined_slots(cut: DataFrame, slots: DataFrame, *more: str) -> DataFrame:
    """Every slot with the pieces of its block: ``shard, slot, src, take, pieces`` (at most a piece per word of the block)."""
    one = F.struct("lo", "hi", *ROW[1:], *more)
    blocks = cut.where("block IS NOT NULL").groupBy("src", "block").agg(F.sort_array(F.collect_list(one)).alias("pieces"))
    return slots.join(blocks, ["src", "block"]).select("shard", "slot", "src", "take", "pieces")


def taken_words(cut: DataFrame, slots: DataFrame) -> DataFrame:
    """Per document how many of its words the mix takes, repeats counted: the words of its pieces in the joined slots."""
    used = joined_slots(cut, slots).select("src", "take", F.explode("pieces").alias("p"))
    taken = F.greatest(F.lit(0), F.least(F.col("p.hi"), F.col("take")) - F.col("p.lo"))
    sums = used.select("src", "p.bucket", "p.row", "p.copy", taken.alias("n")).groupBy(*ROW).agg(F.sum("n").alias("taken"))
    # A document is its first piece, or its only row if it has no words.
    documents = cut.where("first")
    return documents.join(sums, ROW, "left").select(*ROW, "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mixed_texts(docs: DataFrame, cut: DataFrame, slots: DataFrame, block: int = 128,
                id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself: ``(shard, slot, src, text)`` with the words of each slot's block joined by one space.

    Texts meet the pieces on the distinct row (id, source and digest, NULLs
    included); a document is cut to its pieces first, so a long one is split
    over the blocks it fills.
    """
    texts = docs.select(F.col(id_col).alias("_id"), F.col(source_col).alias("_source"), _digest(text_col).alias("_digest"), F.col(text_col).alias("_text")) \
        .dropDuplicates(["_id", "_source", "_digest"])
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("source").eqNullSafe(F.col("_source")) & (F.col("digest") == F.col("_digest"))
    start = F.greatest(F.lit(0), F.col("block") * block - F.col("at")) + 1
    part = cut.where("block IS NOT NULL").join(texts, same).withColumn("w", F.slice(words(F.col("_text")), start.cast("int"), (F.col("hi") - F.col("lo")).cast("int")))
    found = joined_slots(part, slots, "w")
    flat = F.flatten(F.transform("pieces", lambda p: p["w"]))
    return found.select("shard", "slot", "src", F.array_join(F.slice(flat, F.lit(1), F.col("take").cast("int")), " ").alias("text"))
