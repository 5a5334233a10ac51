"""Conversation repair against an exhaustive search, in one block and in many."""

import hashlib
import heapq
import random
import re
import zlib
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from strata.llm import turn_repair
from tests.conftest import SMOKE

SCHEMA = "conv_id long, turn long, role string, text string, c string, open string, runs long"
BLANK = re.compile(r"[^\x20\x09-\x0D]")


def damaged(rows):
    out = []
    for c, t, role, text in rows:
        shown = [" " if x is None else str(x) for x in (c, t)]
        f = zlib.crc32(":".join(shown).encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if f == 1 else re.sub("[.!?]", "", text) if f == 2 else text
        if f:
            out += [(c, t, "user" if f == 4 else role, text)] * (2 if f == 3 else 1)
    return out


def brute(rows):
    """One conversation: best-first search over (row, state) with the audit as the tie break."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3][:64], hashlib.sha256(r[3].encode()).hexdigest()))
    seen, faults = set(), []
    for _, _, role, text in rows:
        core = text.strip(" \t\n\x0b\f\r")
        faults.append("blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else "")
        seen.add((role, text))
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    ini = [r[2][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(ini, ini[1:]))
    heap, done = [(0, "", 0, "", ())], {}
    while heap:
        cost, audit, i, made, kept = heapq.heappop(heap)
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", made):
            break
        if done.setdefault((i, made[-1:]), (cost, audit)) != (cost, audit):
            continue
        def push(letter, extra, j, initial, turn):
            new = made + initial
            if re.fullmatch("s?(ua)*u?", new):
                heapq.heappush(heap, (cost + extra, audit + letter, j, new, kept + turn))
        for initial, role in (("u", "user"), ("a", "assistant")):
            push("I", 5, i, initial, ((role, ""),))
        if i < len(rows):
            push("D", 2, i + 1, "", ())
            if faults[i] not in ("blank", "duplicate"):
                extra = 5 if faults[i] else 0
                push("K", extra, i + 1, ini[i], ((rows[i][2], rows[i][3]),)) if ini[i] else None
                for initial, role in (("u", "user"), ("a", "assistant")):
                    push("R", 1 + extra, i + 1, initial, ((role, rows[i][3]),))
    lines = "\n".join(f"{r}:{t}" for r, t in kept)
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256(lines.encode()).hexdigest())


def expected(rows):
    ids = {r[0] for r in rows}
    by = {c: [r for r in damaged(rows) if r[0] == c] for c in ids}
    return {c: brute(v) for c, v in by.items()}


def found(df):
    return {r[0]: tuple(r[1:]) for r in df.collect()}


def conversations():
    rng = random.Random(3)
    roles = ["user", "assistant", "system", "tool", None, "", "User"]
    texts = ["Yes.", "No!", "Well", " \t", "", None, "Why?  ", "long " * 30 + "end.", "long " * 30 + "no end"]
    rows = []
    for c in range(60):
        for t in range(rng.randint(1, 14)):
            rows.append((c, rng.choice([t, t, t, t + 3, None]), rng.choice(roles[:3] if c % 2 else roles), rng.choice(texts) if c % 3 else f"text {rng.randint(0, 5)}."))
    rows += [(None, None, None, None), (None, 1, "user", "x."), (None, 2, "assistant", "y."), (-5, None, "user", "Hm"), (-5, None, "user", "Hm")]
    rows += [(70, t, "user", "again and again.") for t in range(200)] + [(71, 4, "assistant", "same.")] * 150
    rows += [(72, t, ["user", "assistant"][t % 2], f"{t}.") for t in range(300)]
    rows += [r for c in range(2000, 2080) for r in [(c, 0, "user", "dropped or not.")]]
    return rows


@pytest.mark.parametrize("block", [4096, 3])
def test_repair_against_search(spark, block):
    rows = conversations()
    df = spark.createDataFrame([(*r, "x", "y", 7) for r in rows], SCHEMA).repartition(5)
    want = expected(rows)
    assert any(not damaged([r for r in rows if r[0] == c]) for c in want), "a conversation that is dropped whole"
    assert found(turn_repair.repaired_digests(turn_repair.damage(df), block_rows=block)) == want


def test_repair_smallest_data_and_empty(spark):
    table = spark.read.parquet(f"{SMOKE}/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    assert found(turn_repair.repaired_digests(turn_repair.damage(table), block_rows=5)) == expected(rows)
    assert turn_repair.repaired_digests(turn_repair.damage(table.limit(0))).collect() == []


def test_pieces_hold_the_turns(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "assistant", "Hello."), (1, 2, "user", "Bye"), (1, 3, "assistant", "So long.")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("copies", F.lit(1))
    stats, pieces = turn_repair.repair(df, block_rows=2)
    # Which edits are cheapest is the search's to say; here it is the form of the result.
    assert stats.collect()[0]["cost"] == brute([r for r in rows])[5]
    turns = [(t["role"], t["text"]) for p in sorted(pieces.collect(), key=lambda p: (p["part"], p["seq"])) for t in p["rows"]]
    assert re.fullmatch("(s?(ua)+)?", "".join(r[0] for r, _ in turns))


def test_very_long_runs_and_texts():
    runs = [(turn_repair.symbol("u", 0), 10_000), (turn_repair.symbol("a", 0), 3)]
    v = turn_repair.END
    for sym, n in reversed(runs):
        v = turn_repair.run_before(sym, n, v)
    audit, _ = turn_repair.unroll(runs, 0, turn_repair.END)
    costs = {"K": 0, "R": 1, "D": 2, "I": 5}
    assert sum(costs[x] for x in audit) == v[0] and sum(x != "I" for x in audit) == 10_003
    m = turn_repair.block_matrix(runs)
    assert turn_repair.before(m, turn_repair.END) == v
    assert max(len(list(g)) for _, g in groupby(audit)) < 10_000
