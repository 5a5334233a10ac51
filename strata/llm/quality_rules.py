"""Quality rules: learned decision lists, in DataFrame functions only.

Statistics of every text are computed in its row (no shuffle).  From labelled
statistics, sequential covering learns an ordered list of rules: a rule is a
conjunction of thresholds grown by information gain on the growing part of the
labels and pruned, from its last condition on, on the rest; rows it covers are
set aside and the next rule is learned.  The list is emitted as one Spark
conditional expression.

Learning reads the small labelled table only: its statistics are binned at
percentile thresholds once, and each growth step is one aggregation whose
result (feature x bin x label x part) is bounded and comes to the driver.

Defined cases: NULL texts have the statistics of an empty text; a document
without words fails the base rule; without usable labels the list is empty and
only the base rule decides; repeated rows get equal results; extra columns are
ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import SPACES, words, written

WINDOW = 8
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FEATURES = ["words", "mean_word", "symbols", "dup_lines", "repeats", "upper", "marks", "line_words", "distinct"]


def _per(a: str, b: str) -> Column:
    return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))


def text_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, the ``BASE`` counts and the ``FEATURES`` (shares) of every text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    split = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), words(text).alias("w"),
                        F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "").alias("lines"))
    n = F.size("w")
    grams = F.when(n >= WINDOW, F.transform(F.sequence(F.lit(1), n - WINDOW + 1), lambda i: F.xxhash64(F.slice("w", i, WINDOW)))) \
        .otherwise(F.array().cast("array<bigint>"))
    counted = split.select(
        "doc_id", n.cast("long").alias("n_words"), F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.regexp_count("text", F.lit("[A-Z]")).alias("n_upper"), F.regexp_count("text", F.lit("[!?]")).alias("n_marks"),
        F.size(F.array_distinct("w")).alias("n_distinct"), grams.alias("grams"))
    # Only texts that repeat a window at all sort theirs; a window repeats if a neighbour in that order is equal.
    repeated = F.size(F.array_distinct("grams")) < F.size("grams")
    in_order = counted.select("*", F.when(repeated, F.sort_array(F.transform("grams", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))).alias("s"))
    same = lambda x, i, d: F.coalesce(F.get(F.col("s"), i + d)["h"] == x["h"], F.lit(False))
    starts = F.sort_array(F.transform(F.filter("s", lambda x, i: same(x, i, -1) | same(x, i, 1)), lambda x: x["i"]))
    covered = F.aggregate(starts, F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
                          lambda a, x: F.struct((a["n"] + F.least(F.lit(WINDOW), x - a["last"])).alias("n"), x.alias("last")))
    done = in_order.withColumn("n_repeat_words", F.coalesce(covered["n"], F.lit(0)).cast("long"))
    return done.select("doc_id", *BASE, F.col("n_words").cast("double").alias("words"), _per("word_chars", "n_words").alias("mean_word"),
                       _per("n_symbols", "n_words").alias("symbols"), _per("n_dup_lines", "n_lines").alias("dup_lines"),
                       _per("n_repeat_words", "n_words").alias("repeats"), _per("n_upper", "word_chars").alias("upper"),
                       _per("n_marks", "n_words").alias("marks"), _per("n_words", "n_lines").alias("line_words"),
                       _per("n_distinct", "n_words").alias("distinct"))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        c = F.col(self.feature)
        return c > F.lit(self.threshold) if self.above else c <= F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def rule_column(rule: Rule) -> Column:
    out = rule[0].column()
    for c in rule[1:]:
        out = out & c.column()
    return out


def verdict(rules: list[Rule]) -> Column:
    """The decision list as one conditional expression: False for the first rule that fires, else True."""
    out = None
    for rule in rules:
        out = F.when(rule_column(rule), False) if out is None else out.when(rule_column(rule), False)
    return F.lit(True) if out is None else out.otherwise(True)


def learn(labelled: DataFrame, features: list[str] = FEATURES, max_rules: int = 12, max_conditions: int = 4,
          min_cover: int = 4, min_precision: float = 0.9) -> list[Rule]:
    """Rules for the rows with ``bad = 1`` of ``(doc_id, bad, features...)``.

    Two thirds of the rows (by id hash) grow rules, the rest prune them; a
    rule is kept if it covers ``min_cover`` rows of both parts together with
    ``min_precision``, and its own precision on the pruning part is as high.
    """
    probs = [0.01, 0.02, 0.05, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.85, 0.9, 0.95, 0.98, 0.99]
    cuts_row = labelled.agg(*(F.percentile_approx(f, probs, 10_000).alias(f) for f in features)).first()
    cuts = {f: sorted(set(cuts_row[f] or [])) for f in features}
    bins = [sum((F.when(F.col(f) > F.lit(t), 1).otherwise(0) for t in cuts[f]), F.lit(0)) for f in features]
    rows = written(labelled.select(F.col("bad"), (F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 2).cast("int").alias("part"),
                                   F.array(*bins).alias("bins")), "rules-bins")
    index = {f: i for i, f in enumerate(features)}

    def on_bins(c: Condition) -> Column:
        b, at = F.col("bins")[index[c.feature]], cuts[c.feature].index(c.threshold)
        return b > at if c.above else b <= at

    def matches(rule: Rule) -> Column:
        out = F.lit(True)
        for c in rule:
            out = out & on_bins(c)
        return out

    rules: list[Rule] = []
    left = rows
    while len(rules) < max_rules:
        rule: Rule = ()
        prefixes = []  # (rule, rows of the pruning part it covers: bad, good; of both parts)
        while True:
            counts = (left.where(matches(rule)).select("bad", "part", F.posexplode("bins").alias("f", "b"))
                      .groupBy("f", "b", "bad", "part").count().collect())
            total = [[sum(r["count"] for r in counts if r["f"] == 0 and r["bad"] == y and r["part"] == p) for y in (1, 0)] for p in (0, 1)]
            prefixes.append((rule, total[1], [total[0][0] + total[1][0], total[0][1] + total[1][1]]))
            p0, n0 = total[0]
            if len(rule) == max_conditions or not p0 or not n0:
                break
            best, gain = None, 1e-9
            for f in features:
                mine = [r for r in counts if r["f"] == index[f] and r["part"] == 0]
                for at, t in enumerate(cuts[f]):
                    low = [sum(r["count"] for r in mine if r["b"] <= at and r["bad"] == y) for y in (1, 0)]
                    for above, (p, n) in ((False, low), (True, [p0 - low[0], n0 - low[1]])):
                        if p and n < n0 and (g := p * (log2(p / (p + n)) - log2(p0 / (p0 + n0)))) > gain:
                            best, gain = Condition(f, above, t), g
            if best is None:
                break
            rule += (best,)
        # Prune from the end: the prefix with the best (bad - good) / (bad + good) on the pruning part, shorter first.
        worth = lambda x: (x[1][0] - x[1][1]) / max(1, sum(x[1]))
        chosen = max(reversed(prefixes[1:]), key=worth, default=None)
        chosen = next((x for x in prefixes[1:] if worth(x) == worth(chosen)), None) if chosen else None
        if chosen is None:
            break
        rule, (pp, pn), (p, n) = chosen
        if p + n < min_cover or p < min_precision * (p + n) or pp < min_precision * (pp + pn):
            break
        rules.append(rule)
        left = left.where(~matches(rule))
    return rules


def apply_rules(statistics: DataFrame, rules: list[Rule]) -> DataFrame:
    """Adds ``base_failed`` and ``kept`` to the statistics."""
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return statistics.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & verdict(rules))


def learned_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> tuple[DataFrame, list[Rule]]:
    """Statistics of all documents (written once) and the rules learned from ``labels`` (doc_id, quality 0 or 1; others ignored)."""
    statistics = written(text_statistics(docs, id_col, text_col), "rules-statistics")
    usable = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()) \
        .groupBy("doc_id").agg((1 - F.min("quality")).alias("bad"))
    return statistics, learn(statistics.join(usable, "doc_id"), **options)
