"""Chat formatting of reply trees, in DataFrame functions only.

A message names its parent.  Iterative self-joins by doubling give, after
round ``k``, every message's ``2**k``-th ancestor; the paths of the leaves are
then unfolded by the same jumps in falling order, so a thread of depth ``d``
takes ``2 log2(d)`` joins and no row ever holds more than two ids: the work is
``n log n`` and the size of the paths, also for one very long thread.  The
paths are the branches; each branch is ranked by the sum of its scores and
formatted as one conversation

    <|im_start|>ROLE<|im_sep|>TEXT<|im_end|>...

Control strings inside roles and texts are escaped reversibly: a backslash
goes into every ``<``, backslashes, ``|``, so ``<|`` stands only in markers.

Defined cases: NULL roles and texts are empty; a NULL conversation id is one
conversation; a parent that is not there makes a root; in a cycle of replies
the smallest id becomes the root; of rows with one message id the first by
parent, role, text and score is kept; an empty table has no branches; extra
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import written

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def chain(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Plain conversations as reply trees: each row answers the one before (ordered by turn, role, text)."""
    w = Window.partitionBy(conv).orderBy(F.col(turn).asc_nulls_first(), role, text)
    return rows.select(F.col(conv).alias("conv_id"), F.row_number().over(w).cast("long").alias("msg_id"),
                       F.lag(F.lit(1)).over(w).alias("_has"), F.col(role).alias("role"), F.col(text).alias("text")) \
        .select("conv_id", "msg_id", F.when(F.col("_has").isNotNull(), F.col("msg_id") - 1).alias("parent_id"),
                "role", "text", F.lit(0.0).alias("score"))


def _jumps(links: DataFrame, top: int) -> list[DataFrame]:
    """Tables ``(conv_id, msg_id, up)`` with the ``2**k``-th ancestor, up to the last that has rows; at most ``top`` of them."""
    out = [links]
    while len(out) < top:
        a, b = out[-1].alias("a"), out[-1].alias("b")
        nxt = written(a.join(b, F.col("a.conv_id").eqNullSafe(F.col("b.conv_id")) & (F.col("a.up") == F.col("b.msg_id")))
                      .select("a.conv_id", "a.msg_id", "b.up"), "chat-jump")
        if nxt.isEmpty():
            break
        out.append(nxt)
    return out


def _cycle_heads(links: DataFrame, jumps: list[DataFrame]) -> DataFrame:
    """The smallest id of every cycle, given jumps longer than any path without one: only cycles are still reached."""
    state = jumps[-1].select("conv_id", F.col("up").alias("msg_id")).distinct().withColumn("least", F.col("msg_id"))
    for jump in jumps:
        s, o, j = state.alias("s"), state.alias("o"), jump.alias("j")
        up = s.join(j, F.col("s.conv_id").eqNullSafe(F.col("j.conv_id")) & (F.col("s.msg_id") == F.col("j.msg_id"))) \
            .select("s.conv_id", "s.msg_id", "s.least", "j.up").alias("s")
        state = written(up.join(o, F.col("s.conv_id").eqNullSafe(F.col("o.conv_id")) & (F.col("s.up") == F.col("o.msg_id")))
                        .select("s.conv_id", "s.msg_id", F.least("s.least", "o.least").alias("least")), "chat-cycle")
    return state.where("msg_id = least").select("conv_id", "msg_id")


def ancestor_jumps(nodes: DataFrame) -> list[DataFrame]:
    """Jump tables of the trees in ``(conv_id, msg_id, parent_id)``; absent parents are roots, cycles are cut at their smallest id."""
    n, h = nodes.alias("n"), nodes.select("conv_id", "msg_id").alias("h")
    links = written(n.join(h, F.col("n.conv_id").eqNullSafe(F.col("h.conv_id")) & (F.col("n.parent_id") == F.col("h.msg_id")))
                    .select("n.conv_id", "n.msg_id", F.col("h.msg_id").alias("up")), "chat-links")
    # No path without a cycle has more steps than the largest conversation has messages.
    most = links.groupBy("conv_id").count().agg(F.coalesce(F.max("count"), F.lit(0))).first()[0]
    top = max(1, most).bit_length() + 1
    jumps = _jumps(links, top)
    if len(jumps) < top:
        return jumps
    c = _cycle_heads(links, jumps).alias("c")
    links = links.alias("n").join(c, F.col("n.conv_id").eqNullSafe(F.col("c.conv_id")) & (F.col("n.msg_id") == F.col("c.msg_id")), "left_anti")
    return _jumps(written(links, "chat-cut"), top)


def paths(nodes: DataFrame) -> DataFrame:
    """``(conv_id, leaf_id, msg_id, dist)``: every message of every root-to-leaf path, ``dist`` replies above its leaf.

    A path is unfolded from its leaf by halving jumps: before round ``k`` every
    ``2**(k + 1)``-th message is there, the round adds those half way between.
    The rows made are those of the result, whatever the depth.
    """
    nodes = written(nodes.select("conv_id", "msg_id", "parent_id"), "chat-nodes")
    jumps = ancestor_jumps(nodes)
    a, p = nodes.alias("a"), jumps[0].select("conv_id", "up").distinct().alias("p")
    state = written(a.join(p, F.col("a.conv_id").eqNullSafe(F.col("p.conv_id")) & (F.col("a.msg_id") == F.col("p.up")), "left_anti")
                    .select("conv_id", F.col("msg_id").alias("leaf_id"), "msg_id", F.lit(0).cast("long").alias("dist")), "chat-leaves")
    for k in range(len(jumps) - 1, -1, -1):
        s, j = state.alias("s"), jumps[k].alias("j")
        more = s.join(j, F.col("s.conv_id").eqNullSafe(F.col("j.conv_id")) & (F.col("s.msg_id") == F.col("j.msg_id"))) \
            .select("s.conv_id", "s.leaf_id", F.col("j.up").alias("msg_id"), (F.col("s.dist") + (1 << k)).alias("dist"))
        state = state.union(written(more, "chat-path"))
    return state


def format_reply_trees(messages: DataFrame, branches: int | None = None) -> DataFrame:
    """Every chosen root-to-leaf path of ``(conv_id, msg_id, parent_id, role, text, score)`` as one conversation.

    ``branches`` keeps the best branches of each tree (None: all).  Returns
    conv_id, leaf_id, rank (1: highest sum of scores, then the smaller path),
    score, path, formatted, and loss_spans: ``(start, end)`` in code points of
    ``formatted`` (end exclusive) of the assistant texts.
    """
    first = Window.partitionBy("conv_id", "msg_id").orderBy("parent_id", "role", "text", "score")
    rows = messages.select("conv_id", F.col("msg_id").cast("long").alias("msg_id"), F.col("parent_id").cast("long").alias("parent_id"),
                           F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
                           F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score")) \
        .withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")
    rows = written(rows, "chat-rows")
    steps = paths(rows)
    turn = rows.select(F.col("conv_id").alias("_c"), F.col("msg_id").alias("_m"), "score",
                       F.concat(F.lit(START), escape(F.col("role")), F.lit(SEP)).alias("head"),
                       F.concat(escape(F.col("text")), F.lit(END)).alias("body"), (F.col("role") == "assistant").alias("loss"))
    turns = steps.join(turn, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("msg_id") == F.col("_m")))
    before = Window.partitionBy("conv_id", "leaf_id").orderBy(F.col("dist").desc()).rowsBetween(Window.unboundedPreceding, -1)
    size = F.length("head") + F.length("body")
    placed = turns.withColumn("at", F.coalesce(F.sum(size).over(before), F.lit(0)) + F.length("head"))
    span = F.struct(F.col("at").alias("start"), (F.col("at") + F.length("body") - len(END)).alias("end"))
    joined = placed.groupBy("conv_id", "leaf_id").agg(
        F.sum("score").alias("score"),
        F.sort_array(F.collect_list(F.struct((-F.col("dist")).alias("pos"), "msg_id", F.concat("head", "body").alias("s")))).alias("parts"),
        F.sort_array(F.collect_list(F.when(F.col("loss"), span))).alias("loss_spans")) \
        .withColumn("path", F.transform("parts", lambda p: p["msg_id"]))
    best = Window.partitionBy("conv_id").orderBy(F.col("score").desc(), "path")
    out = joined.select("conv_id", "leaf_id", F.row_number().over(best).alias("rank"), "score", "path",
                        F.array_join(F.transform("parts", lambda p: p["s"]), "").alias("formatted"), "loss_spans")
    return out if branches is None else out.where(F.col("rank") <= branches)


def parsed_turns(formatted: Column) -> Column:
    """Turns read back from a formatted conversation: an array of ``(role, text)``, unescaped."""
    body = F.slice(F.split(formatted, r"<\|im_start\|>", -1), 2, 1 << 30)
    return F.transform(body, lambda t: F.struct(
        unescape(F.substring_index(t, SEP, 1)).alias("role"),
        unescape(F.substring_index(F.substring_index(t, SEP, -1), END, 1)).alias("text")))
