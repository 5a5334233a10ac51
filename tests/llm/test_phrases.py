"""Collocations against a plain count; automata against dictionaries; exact scores beyond 64 bits."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from strata.llm import phrases
from strata.llm.phrases import Transducer, Union
from tests.conftest import SMOKE

SCHEMA = "doc_id long, text string, lang string, phrase string, f long, path string, n long"


def brute(rows, least, top=2000):
    f, n = Counter(), Counter()
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, 6):
                for i in range(len(w) - m + 1):
                    f[lang, tuple(w[i:i + m])] += 1
    often = {k: v for k, v in f.items() if v >= least}
    out = []
    for (lang, p), a in often.items():
        if len(p) < 2 or any(k == lang and len(q) > len(p) and b >= a and any(q[i:i + len(p)] == p for i in range(len(q))) for (k, q), b in often.items()):
            continue
        cuts = []
        for k in range(1, len(p)):
            left, right = often[lang, p[:k]], often[lang, p[k:]]
            cuts.append((1000 * a * n[lang] // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        out.append((lang, -score, -a, " ".join(p).encode(), left, right, n[lang]))
    ranked, seen = [], Counter()
    for lang, score, a, p, left, right, total in sorted(out):
        seen[lang] += 1
        if seen[lang] <= top:
            ranked.append((lang, seen[lang], p.decode(), -a, left, right, total, -score))
    return ranked


def found(df):
    return sorted(tuple(r) for r in df.collect())


def corpus():
    rng = random.Random(8)
    vocab = ["The", "the", "cat", "sat", "on", "mat", "é", "漢字", "a-b", "nbsp word", "x", "yy", "zzz", "Ärger", "ÄRGER"]
    rows = []
    for i in range(400):
        text = ""
        for _ in range(rng.randint(0, 40)):
            text += rng.choice(vocab if rng.random() < 0.6 else ["new york city hall tonight", "of the"]) + rng.choice([" ", " ", " ", "\t ", ". ", ",", "\n", "\x0b", ":"])
        rows.append((text, rng.choice(["en", "en", "de", None, "und"])))
    rows += [(None, "en"), ("", None), (" .,;\n", "fr"), ("word", "it"), ("long run " * 5000, "en"), ("a " * 6000, "de")]
    return rows + rows[:50]


@pytest.mark.parametrize("least,top", [(3, 2000), (20, 15)])
def test_against_count(spark, least, top):
    rows = corpus()
    df = spark.createDataFrame([(i, *r, "p", 1, "q", 2) for i, r in enumerate(rows)], SCHEMA).repartition(6)
    assert found(phrases.collocations(df, least=least, top=top)) == sorted(brute(rows, least, top))


def test_full_filters_and_small_ranges_change_nothing(spark):
    rows = corpus()[:150]
    df = spark.createDataFrame([(i, *r, "p", 1, "q", 2) for i, r in enumerate(rows)], SCHEMA).repartition(3)
    want = sorted(brute(rows, 2))
    assert found(phrases.collocations(df, least=2, max_bits=64)) == want
    assert found(phrases.collocations(df, least=2, range_words=50)) == want


def test_smallest_data_and_empty(spark):
    table = spark.read.parquet(f"{SMOKE}/documents.parquet")
    rows = [(r["text"], r["lang"]) for r in table.collect()]
    assert found(phrases.collocations(table, least=60)) == sorted(brute(rows, 60))
    assert phrases.collocations(table.limit(0)).collect() == []


def test_automata():
    rng = random.Random(2)
    words = [f"w{i}".encode() for i in range(7)]
    whole, counts = Union(compact=50), Counter()
    for _ in range(12):
        windows = [[rng.randrange(7) + 1 if j < 2 or rng.random() < 0.7 else 0 for j in range(5)] for _ in range(60)]
        for w in windows:
            for j in range(1, 5):
                w[j] = w[j] if w[j - 1] else 0
            for j in range(5):
                if w[j]:
                    counts[b" ".join(words[x - 1] for x in w[:j + 1])] += 1
        rows, weights = phrases.summed(np.array(windows), np.ones(60, np.int64))
        part = Transducer.build(words, rows, weights)
        again = Transducer.load(part.dump())
        assert again.words == words and all((x == y).all() for a, b in zip(part.levels, again.levels, strict=True) for x, y in zip(a, b, strict=True))
        whole.add(again)
    assert {(p, n) for p, _, n in whole.frequent(1, 1)} == set(counts.items())


def test_scores_beyond_64_bits(spark):
    big = 3_000_000_019
    frame = spark.createDataFrame([("x", "a", 1, big), ("x", "a b", 2, big - 7), ("x", "b", 1, big - 2)], "lang string, phrase string, words int, f long")
    walked = phrases._path_weights(phrases._path_weights(frame, "firsts", False), "lasts", True).where("words = 2").collect()[0]
    assert walked["firsts"] == [big] and walked["lasts"] == [big - 2]
    n = 9_000_000_000_000_000
    exact = "CAST({} AS DECIMAL(38, 0))"
    row = spark.sql(f"SELECT ({exact.format(1000)} * {exact.format(big - 7)} * {exact.format(n)}) div ({exact.format(big)} * {exact.format(big - 2)}) AS s").first()
    assert row["s"] == 1000 * (big - 7) * n // (big * (big - 2))
