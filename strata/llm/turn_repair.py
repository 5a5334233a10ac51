"""Conversation structure repair by a run-length dynamic programme.

The rows of a conversation, in the order of their turns, become symbols (role
initial and fault); equal neighbours collapse to runs.  Costs live on four
states of the wanted role order ``(s?(ua)+)?`` (nothing yet, after system,
after user, after assistant): a symbol is a 4 x 4 min-plus matrix, a run of
``n`` of them its ``n``-th power, put together from cached binary powers.
Costs to go run backwards over the runs; the audit is then unrolled forwards,
at each step the ASCII-least edit that stays cheapest, in cached halves of a
run.  An audit fixes the repaired roles, as the wanted order alternates.

Distribution: rows are range-partitioned in conversation order, the last range
column being a row number, so a conversation of any length (and any number of
equal rows) is spread over partitions.  A partition streams its rows into
blocks of at most ``block_rows`` rows and ``block_chars`` characters.  A
conversation in one block is finished there.  The blocks of the others meet
twice without their text, as a sorted stream: backwards for the costs to go
(one vector is carried), forwards for the states in which blocks begin; then
each block is unrolled where its text is.  Nothing holds a conversation.

Edits: Keep 0, Rerole to user or assistant 1, Delete 2 (required for blank and
repeated rows), Insert an empty user or assistant turn 5; a truncated row that
is not deleted adds 5.

Defined cases: NULL ``conv_id`` is a conversation of its own; NULL turns come
first and count in no gap; NULL roles and texts are one space; rows of one turn
come by role, then by the first 64 characters of the text, then by its digest;
equal rows are repeats of the first; a conversation without rows has zeros, an
empty audit and the digest of the empty text; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import SPACES, written

# States of the wanted order: nothing yet, after system, after user, after assistant.
NEXT = (2, 2, 3, 2)  # the state after a user or assistant turn, whichever may follow
NAMES = {2: "user", 3: "assistant"}
KEEPS = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
LEGAL = {"su", "ua", "au"}
INITIALS = "sua?"  # "?": any other initial
INSERT, DELETE, REROLE, TRUNCATED = 5, 2, 1, 5
GONE = 2  # fault code of rows that must be deleted; 1: truncated, 0: none
FAR = 1 << 60
#: Cost of ending in a state: the missing turns are inserted.
END = (0, 2 * INSERT, INSERT, 0)


def symbol(initial: str, fault: int) -> int:
    return 3 * (INITIALS.find(initial) if initial and initial in "sua" else 3) + fault


@lru_cache(None)
def edits(sym: int, state: int) -> tuple[tuple[str, int, int], ...]:
    """The edits of one row: ``(letter, cost, next state)``."""
    fault = sym % 3
    out = [("D", DELETE, state)]
    if fault != GONE:
        extra = TRUNCATED if fault else 0
        if state in KEEPS.get(INITIALS[sym // 3], {}):
            out.append(("K", extra, KEEPS[INITIALS[sym // 3]][state]))
        out.append(("R", REROLE + extra, NEXT[state]))
    return tuple(out)


def times(a: tuple, b: tuple) -> tuple:
    """Min-plus product of two matrices."""
    return tuple(tuple(min(x + b[k][j] for k, x in enumerate(row)) for j in range(4)) for row in a)


def before(m: tuple, v: tuple) -> tuple:
    """Costs to go before a stretch, from those after it."""
    return tuple(min(x + y for x, y in zip(row, v, strict=True)) for row in m)


@lru_cache(None)
def power(sym: int, k: int) -> tuple:
    """The transition of ``2 ** k`` equal symbols; a symbol may follow any number of inserts."""
    if k:
        return times(power(sym, k - 1), power(sym, k - 1))
    rows = [[FAR] * 4 for _ in range(4)]
    for start in range(4):
        state = start
        for inserts in range(4):
            for _, cost, to in edits(sym, state):
                rows[start][to] = min(rows[start][to], INSERT * inserts + cost)
            state = NEXT[state]
    return tuple(map(tuple, rows))


IDENTITY = tuple(tuple(0 if i == j else FAR for j in range(4)) for i in range(4))


def _bits(n: int) -> list[int]:
    return [k for k in range(n.bit_length()) if n >> k & 1]


def run_before(sym: int, n: int, v: tuple) -> tuple:
    for k in _bits(n):
        v = before(power(sym, k), v)
    return v


def block_matrix(runs: list[tuple[int, int]]) -> tuple:
    out = IDENTITY
    for sym, n in runs:
        for k in _bits(n):
            out = times(out, power(sym, k))
    return out


@lru_cache(100_000)
def _choices(sym: int, k: int, state: int, v: tuple) -> tuple[str, int]:
    """Letters and last state of ``2 ** k`` rows from ``state``, with costs to go ``v`` after them."""
    if k:
        mid = before(power(sym, k - 1), v)
        first, state = _choices(sym, k - 1, state, _low(mid))
        second, state = _choices(sym, k - 1, state, v)
        return first + second, state
    best = before(power(sym, 0), v)
    done = ""
    while True:
        for letter, cost, to in sorted((*edits(sym, state), ("I", INSERT, NEXT[state]))):
            rest = cost + (best[to] if letter == "I" else v[to])
            if rest == best[state]:
                break
        done, state = done + letter, to
        if letter != "I":
            return done, state


def _low(v: tuple) -> tuple:
    """Costs to go less their smallest: only differences decide, and few of them occur."""
    least = min(v)
    return tuple(x - least for x in v)


def unroll(runs: list[tuple[int, int]], state: int, v: tuple) -> tuple[str, int]:
    """The audit of some runs from a state, with costs to go ``v`` after them, and the state behind them."""
    after = [v]
    for sym, n in reversed(runs):
        after.append(run_before(sym, n, after[-1]))
    after.reverse()
    out = []
    for i, (sym, n) in enumerate(runs):
        bits = _bits(n)
        behind = [after[i + 1]]
        for k in bits:
            behind.append(before(power(sym, k), behind[-1]))
        for k, costs in zip(reversed(bits), reversed(behind[:-1]), strict=True):
            letters, state = _choices(sym, k, state, _low(costs))
            out.append(letters)
    return "".join(out), state


def closing(state: int) -> str:
    """Inserts after the last row."""
    return "I" * (END[state] // INSERT)


def repaired(audit: str, runs: list[tuple[int, int]], rows: Iterator[tuple[str, str]], state: int) -> list[tuple[str, str]]:
    """The turns that an audit leaves; ``rows`` are those that need not be deleted."""
    syms = (sym for sym, n in runs for _ in range(n))
    out = []
    for letter in audit:
        role, text = None, ""
        if letter != "I":
            sym = next(syms)
            if sym % 3 != GONE:
                role, text = next(rows)
        if letter == "D":
            continue
        state = KEEPS[role[0]][state] if letter == "K" else NEXT[state]
        out.append((role if letter == "K" else NAMES[state], text))
    return out


# --- rows to blocks -------------------------------------------------------------------------------------------------


def damage(rows: DataFrame) -> DataFrame:
    """Rows damaged by the CRC-32 of ``conv_id:turn``: ``conv_id, turn, role, text, copies`` (0: dropped, 2: repeated)."""
    def shown(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    fault = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn"))) % 20
    text = shown("text")
    return rows.select(
        "conv_id", "turn",
        F.when(fault == 4, F.lit("user")).otherwise(shown("role")).alias("role"),
        F.when(fault == 1, F.lit("")).when(fault == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).alias("copies"))


def _ordered(rows: DataFrame) -> DataFrame:
    """Rows with their faults, range-partitioned and sorted in conversation order."""
    said = F.col("copies") > 0
    core = F.btrim("text", F.lit(SPACES))
    fault = F.when(F.length(core) == 0, GONE).when(~F.substring(core, -1, 1).isin(".", "!", "?"), 1).otherwise(0)
    base = rows.select(
        "conv_id", F.when(said, F.col("turn").cast("long")).alias("turn"),
        F.when(said, F.coalesce("role", F.lit(" "))).alias("role"), F.when(said, F.coalesce("text", F.lit(" "))).alias("text"),
        "copies", F.monotonically_increasing_id().alias("uid"))
    base = base.withColumn("fault", F.when(said, fault)).withColumn("digest", F.substring(F.unhex(F.sha2("text", 256)), 1, 16))
    base = written(base, "repair-rows")  # row numbers are the same wherever they are read
    # Partial minima, so a text that stands in a third of the rows is one row a task.
    again = base.where(said & (F.col("fault") != GONE)).groupBy(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d")).agg(
        F.min(F.struct("turn", "uid")).alias("first"), F.count("*").alias("n")).where("n > 1").select("c", "r", "d", "first.uid")
    same = base["conv_id"].eqNullSafe(again["c"]) & (base["role"] == again["r"]) & (base["digest"] == again["d"])
    # Texts that occur again are few; AQE broadcasts them only by measured size.
    marked = base.join(again, same, "left").select(
        base["*"], (again["uid"].isNotNull() & (again["uid"] != base["uid"])).alias("dup"))
    order = ["conv_id", "turn", "role", F.substring("text", 1, 64), "digest", "uid"]
    return marked.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "conv_id", "turn", "role", "text", "copies", "fault", "dup")


TURNS = "array<struct<role:string,text:string>>"
FIELDS = ("open boolean, part int, seq long, runs array<long>, matrix array<long>, turn_lo long, turn_hi long, n_turns long, blank long, "
          f"duplicate long, truncated long, illegal long, first string, last string, cost long, audit string, rows {TURNS}")
_ARROW = [("open", pa.bool_()), ("part", pa.int32()), ("seq", pa.int64()), ("runs", pa.list_(pa.int64())), ("matrix", pa.list_(pa.int64())),
          ("turn_lo", pa.int64()), ("turn_hi", pa.int64()), ("n_turns", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()),
          ("truncated", pa.int64()), ("illegal", pa.int64()), ("first", pa.string()), ("last", pa.string()), ("cost", pa.int64()),
          ("audit", pa.string()), ("rows", pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())])))]


class _Block:
    """Rows of one conversation that are read together."""

    def __init__(self) -> None:
        self.runs: list[list[int]] = []
        self.rows: list[tuple[str, str]] = []
        self.n = self.chars = self.n_turns = self.illegal = 0
        self.faults = [0, 0, 0]
        self.lo = self.hi = self.first = self.last = None

    def add(self, turn, role, text, copies, fault, dup) -> None:
        initial = role[:1]
        if turn is not None and turn != self.hi:
            self.n_turns += 1
            self.lo, self.hi = turn if self.lo is None else self.lo, turn
        if self.last is not None and self.last + initial not in LEGAL:
            self.illegal += 1
        self.first, self.last = initial if self.first is None else self.first, initial
        # The copies of a row are adjacent: the later ones repeat the first.
        self.illegal += (copies - 1) * (2 * initial not in LEGAL)
        gone = fault == GONE or dup
        self.faults[0 if fault == GONE else 1] += copies if gone else copies - 1
        self.faults[2] += not gone and fault == 1
        if not gone:
            self.rows.append((role, text))
            self.chars += len(text)
            self._run(symbol(initial, fault), 1)
        if extra := copies if gone else copies - 1:
            self._run(symbol(initial, GONE), extra)
        self.n += 1

    def _run(self, sym: int, n: int) -> None:
        if self.runs and self.runs[-1][0] == sym:
            self.runs[-1][1] += n
        else:
            self.runs.append([sym, n])


def _emitted(conv, block: _Block, part: int, seq: int, open_: bool) -> tuple:
    runs, rows, matrix, cost, audit = [tuple(r) for r in block.runs], block.rows, None, None, None
    if open_:
        matrix = [x for row in block_matrix(runs) for x in row]
    else:
        v = END
        for sym, n in reversed(runs):
            v = run_before(sym, n, v)
        audit, state = unroll(runs, 0, END)
        audit, cost = audit + closing(state), v[0]
        rows = repaired(audit, runs, iter(rows), 0)
    flat = [x for r in runs for x in r] if open_ else None
    return (conv, open_, part, seq, flat, matrix, block.lo, block.hi, block.n_turns, *block.faults, block.illegal,
            block.first, block.last, cost, audit, [{"role": r, "text": t} for r, t in rows])


def _blocks(ordered: DataFrame, block_rows: int, block_chars: int) -> DataFrame:
    conv_type = ordered.schema["conv_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        nothing = object()
        conv, block, whole = nothing, _Block(), False  # the first conversation may have begun in the partition before
        out, held, arrow = [], 0, None
        for batch in batches:
            arrow = arrow or batch.schema.field("conv_id").type
            columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
            for c, *row in zip(*columns, strict=True):
                full = block.n >= block_rows or block.chars >= block_chars
                if c != conv or full:
                    if conv is not nothing:
                        out.append(_emitted(conv, block, part, seq, not whole or c == conv))
                        held += block.chars + 100
                    whole = c != conv and conv is not nothing
                    conv, block, seq = c, _Block(), seq + 1
                if row[3]:
                    block.add(*row)
                if held > 1 << 22:
                    yield _batch(out, arrow)
                    out, held = [], 0
        if conv is not nothing:
            out.append(_emitted(conv, block, part, seq, True))
            yield _batch(out, arrow)

    return ordered.mapInArrow(run, T.StructType([T.StructField("conv_id", conv_type), *T.StructType.fromDDL(FIELDS).fields]))


def _batch(rows: list[tuple], conv_type: pa.DataType) -> pa.RecordBatch:
    kinds = [("conv_id", conv_type), *_ARROW]
    return pa.RecordBatch.from_arrays([pa.array(list(col), t) for col, (_, t) in zip(zip(*rows, strict=True), kinds, strict=True)],
                                      names=[n for n, _ in kinds])


# --- conversations in several blocks --------------------------------------------------------------------------------


def _pairs(flat: list[int]) -> list[tuple[int, int]]:
    return list(zip(flat[::2], flat[1::2], strict=True))


def _carried(df: DataFrame, fields: str, start, step) -> DataFrame:
    """A sorted stream with a value carried along each conversation: ``step(row, carried) -> (new columns, carried)``."""
    kinds = T.StructType.fromDDL(fields)
    schema = T.StructType([*df.schema.fields, *kinds.fields])

    def run(batches):
        nothing = object()
        conv, value = nothing, None
        for batch in batches:
            rows, added = batch.to_pylist(), []
            for row in rows:
                if row["conv_id"] != conv:
                    conv, value = row["conv_id"], start
                new, value = step(row, value)
                added.append(new)
            columns = list(zip(*added, strict=True)) if rows else [[] for _ in kinds.fields]
            types = {"long": pa.int64(), "array": pa.list_(pa.int64())}
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array(list(c), types["array" if isinstance(f.dataType, T.ArrayType) else "long"]) for c, f in zip(columns, kinds.fields, strict=True))],
                names=[*batch.schema.names, *kinds.names])

    return df.mapInArrow(run, schema)


def _backward(row: dict, after: tuple):
    runs = _pairs(row["runs"])
    m = [row["matrix"][i:i + 4] for i in range(0, 16, 4)]
    ahead = before(m, after)
    exits = [unroll(runs, state, _low(after))[1] for state in range(4)]
    return (list(after), exits, ahead[0]), ahead


def _forward(row: dict, seen):
    state, last, hi, begun = seen
    seam = int(begun and last is not None and row["first"] is not None and last + row["first"] not in LEGAL)
    shared = int(hi is not None and row["turn_lo"] == hi)
    new = (state, seam, shared, 0 if begun else row["togo"])
    return new, (row["exits"][state], row["last"] if row["last"] is not None else last,
                 row["turn_hi"] if row["turn_hi"] is not None else hi, True)


STATS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _gaps(lo: Column, hi: Column, n: Column) -> Column:
    return F.coalesce(hi - lo + 1 - n, F.lit(0)).cast("long").alias("gaps")


def _unrolled(df: DataFrame) -> DataFrame:
    """The audit and the turns of open blocks, from the state they begin in and the costs to go after them."""
    schema = T.StructType([*[df.schema[c] for c in ("conv_id", "part", "seq")], *T.StructType.fromDDL(f"audit string, rows {TURNS}").fields])

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                runs, state = _pairs(row["runs"]), row["state"]
                audit, end = unroll(runs, state, _low(tuple(row["after"])))
                if row["final"]:
                    audit += closing(end)
                turns = repaired(audit, runs, iter([(r["role"], r["text"]) for r in row["rows"]]), state)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.slice(i, 1).column(c) for c in ("conv_id", "part", "seq")), pa.array([audit]),
                     pa.array([[{"role": r, "text": t} for r, t in turns]], _ARROW[-1][1])], names=schema.names)

    return df.mapInArrow(run, schema)


def repair(rows: DataFrame, block_rows: int = 4096, block_chars: int = 1 << 20) -> tuple[DataFrame, DataFrame]:
    """``(stats, pieces)`` of the conversations in ``rows`` (``conv_id, turn, role, text, copies``).

    ``stats``: ``conv_id, gaps, blank, duplicate, truncated, illegal, cost``.
    ``pieces``: ``conv_id, part, seq, audit, rows`` - the edits and the
    repaired turns; a conversation's pieces follow each other by ``part, seq``.
    """
    blocks = written(_blocks(_ordered(rows), block_rows, block_chars), "repair-blocks")
    closed, open_ = blocks.where("NOT open"), blocks.where("open")
    narrow = open_.drop("open", "audit", "rows", "cost").repartition("conv_id")
    back = _carried(narrow.sortWithinPartitions("conv_id", F.desc("part"), F.desc("seq")), "after array<long>, exits array<long>, togo long", END, _backward)
    placed = written(_carried(back.sortWithinPartitions("conv_id", "part", "seq"), "state long, seam long, shared long, paid long",
                              (0, None, None, False), _forward), "repair-states")
    total = placed.groupBy("conv_id").agg(
        _gaps(F.min("turn_lo"), F.max("turn_hi"), F.sum("n_turns") - F.sum("shared")),
        *(F.sum(c).alias(c) for c in STATS[1:4]), F.sum(F.col("illegal") + F.col("seam")).alias("illegal"), F.sum("paid").alias("cost"))
    ends = placed.groupBy("conv_id").agg(F.max(F.struct("part", "seq")).alias("e")).select("e.part", "e.seq", F.lit(True).alias("final"))
    here = placed.select("part", "seq", "state", "after").join(ends, ["part", "seq"], "left")
    pieces = _unrolled(open_.select("conv_id", "part", "seq", "runs", "rows").join(here, ["part", "seq"]))
    stats = closed.select("conv_id", _gaps(F.col("turn_lo"), F.col("turn_hi"), F.col("n_turns")), *STATS[1:])
    return stats.unionByName(total), closed.select("conv_id", "part", "seq", "audit", "rows", F.lit(True).alias("whole")).unionByName(
        pieces.withColumn("whole", F.lit(False)))


def repaired_digests(rows: DataFrame, **options) -> DataFrame:
    """``repair`` as one row per conversation: its statistics, the whole audit and the SHA-256 of the repaired ``role:text`` lines.

    The pieces of a conversation in several blocks pass through as a sorted
    stream that feeds the digest piece by piece: only the audit of one
    conversation is held, which is a value of the result.
    """
    stats, pieces = repair(rows, **options)
    lines = F.array_join(F.transform("rows", lambda r: F.concat(r["role"], F.lit(":"), r["text"])), "\n")
    told = pieces.select("conv_id", "part", "seq", "audit", lines.alias("lines"), (F.size("rows") > 0).alias("some"), "whole")
    conv = T.StructField("conv_id", pieces.schema["conv_id"].dataType)
    schema = T.StructType([conv, T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())])

    def batch_of(out, kind):
        cols = list(zip(*out, strict=True)) if out else [[], [], []]
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, (kind, pa.string(), pa.string()), strict=True)], names=schema.names)

    def run(batches):
        nothing = object()
        now, audit, digest, begun, kind = nothing, [], None, False, None
        for batch in batches:
            kind, out = batch.schema.field("conv_id").type, []
            for c, letters, text, some in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "audit", "lines", "some")), strict=True):
                if c != now:
                    if now is not nothing:
                        out.append((now, "".join(audit), digest.hexdigest()))
                    now, audit, digest, begun = c, [], hashlib.sha256(), False
                audit.append(letters)
                if some:
                    digest.update(("\n" + text if begun else text).encode())
                    begun = True
            yield batch_of(out, kind)
        if now is not nothing:
            yield batch_of([(now, "".join(audit), digest.hexdigest())], kind)

    parts = told.where("NOT whole").drop("whole").repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq").mapInArrow(run, schema)
    single = told.where("whole").select("conv_id", "audit", F.sha2("lines", 256).alias("repaired_sha256"))
    right = single.unionByName(parts).withColumnRenamed("conv_id", "c")
    return stats.join(right, stats["conv_id"].eqNullSafe(right["c"])).select("conv_id", *STATS, "audit", "repaired_sha256")
