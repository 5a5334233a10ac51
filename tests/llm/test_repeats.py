"""Repeats where hashes collide, and with anchors in more surroundings than one task should hold."""

import inspect
import random
import tracemalloc

import pyarrow as pa
from pyspark.sql import functions as F

from strata.llm import repeats, substring_dedup, suffix_dedup
from tests.llm import brute
from tests.llm.test_operators import SCHEMA, got, rows, sha


def thue_morse(n, a, b):
    bits = [bin(i).count("1") & 1 for i in range(n)]
    return "".join(b if x else a for x in bits), "".join(a if x else b for x in bits)


def test_polynomial_collisions_remove_nothing(spark):
    """Thue-Morse texts and their complements agree under any polynomial hash modulo 2**64."""
    one, two = thue_morse(1024, "a", "b")
    words = " ".join(f"w{i}" for i in range(34))
    df = spark.createDataFrame(rows([f"{words} {one}", f"{words} {two}"]), SCHEMA)
    assert got(substring_dedup.remove_repeats(df), "n_words", "n_removed") == {0: (35, 0), 1: (35, 0)}
    one, two = thue_morse(512, "'", "u")
    texts = dict(enumerate([one, two]))
    df = spark.createDataFrame(rows([one, two]), SCHEMA)
    out = suffix_dedup.remove_repeats(df).withColumn("h", sha("kept"))
    assert got(out, "n_bytes", "n_removed", "n_spans", "h") == brute.suffix(texts)
    assert got(out, "n_removed") == {0: (0,), 1: (0,)}


def crowded(n, passage, seed, unit):
    """Texts with one passage in surroundings of their own, some of them copied in part."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6))
    out = []
    for i in range(n):
        head, tail = " ".join(word() for _ in range(unit)), " ".join(word() for _ in range(unit))
        out.append(f"{head} {passage} {tail}")
        if i % 50 == 0:
            out.append(f"{word()} {head[-200:]} {passage} {tail[:260]} {word()}")
    return out


def test_hot_anchors_at_default_bounds(spark):
    """More than 8,192 different segments of one anchor, with real repeats of 400 bytes among them: equal to brute force."""
    line = "This line is under a licence and stands in every document of this corpus, word for word, so its grams are hot."
    texts = crowded(9000, line, 5, 42)
    df = spark.createDataFrame(rows(texts), SCHEMA).repartition(16)
    out = suffix_dedup.remove_repeats(df).withColumn("h", sha("kept"))
    want = brute.suffix(dict(enumerate(texts)))
    assert got(out, "n_bytes", "n_removed", "n_spans", "h") == want
    assert 0 < sum(w[1] > 0 for w in want.values()) < 1000


def test_hot_passages_nearly_as_long_as_a_window(spark):
    """Anchors stay hot until the windows name themselves."""
    rng = random.Random(9)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(390)).strip()
    texts = crowded(60, passage, 6, 12) + [passage + "x", "y" + passage, passage + "x"]
    df = spark.createDataFrame(rows(texts), SCHEMA).repartition(4)
    want = brute.suffix(dict(enumerate(texts)))
    for hot in (5, 1 << 13):
        out = suffix_dedup.remove_repeats(df, hot=hot).withColumn("h", sha("kept"))
        assert got(out, "n_bytes", "n_removed", "n_spans", "h") == want
    words = " ".join(f"p{i}" for i in range(33))
    texts = crowded(60, words, 7, 8) + [words + " x y", "x " + words + " x y"]
    df = spark.createDataFrame(rows(texts), SCHEMA).repartition(4)
    want = brute.substring(dict(enumerate(texts)))
    for hot in (5, 1 << 16):
        out = substring_dedup.remove_repeats(df, hot=hot).withColumn("h", sha("kept"))
        assert got(out, "n_words", "n_removed", "h") == want
    assert df.agg(F.count("*")).first()[0] == len(texts)


def test_largest_group_of_a_default_search_is_small():
    """The most segments that one anchor may bring to a task, each as long as a segment may be, take less than 250 MB."""
    rng = random.Random(3)
    hot = inspect.signature(suffix_dedup.remove_repeats).parameters["hot"].default
    passage = rng.randbytes(32).hex().encode()
    segments = [(1, (i, i), 1, 400, rng.randbytes(184).hex().encode() + passage + rng.randbytes(184).hex().encode()[:367]) for i in range(hot)]
    tracemalloc.start()
    assert not any(spans for _, spans in suffix_dedup.pfp_finder(400)(segments))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 250e6


def test_a_large_key_joins_no_shard_before_it():
    """A shard holds more than its bound only if it is one key; keys stay whole, a segment that comes twice counts once."""
    sizes = {1: [40, 30], 2: [50, 50, 50], 3: [10], 4: [60], 5: [30, 30]}
    rows = [(k, i, i, 1, 1, 1, b"x" * n) for k, ns in sizes.items() for i, n in enumerate(ns) for _ in range(2)]
    batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows[i:i + 3], strict=True)], names=list("abcdefg")) for i in range(0, len(rows), 3)]
    shards = list(repeats._shards(batches, 100))
    assert [[(s[0], len(s[4])) for s in shard] for shard in shards] == [
        [(1, 40), (1, 30)], [(2, 50), (2, 50), (2, 50)], [(3, 10), (4, 60)], [(5, 30), (5, 30)]]
