"""Quality classifier by positive-unlabelled learning.

Trusted positives are the training rows labelled 1; the unlabelled set is a
sample of all documents.  The class prior is estimated from the training
labels (their share of 1s, or given).  A small network of one hidden layer is
fitted by the non-negative unbiased risk

    R = prior * R_p(+) + max(0, R_u(-) - prior * R_p(-))

with the logistic loss; while the estimate of the negative part is below zero
it has no slope, so the fit cannot drive it further down.

The features are statistics of the text alone.  The model is fitted on the
driver from a bounded sample (``max_positive``, ``max_unlabelled`` documents,
those with the smallest hashes of the id): the sample's ids are broadcast, and
tasks return its feature vectors.  Scoring is one pass over all texts in
tasks.  Texts are never shuffled.

Defined cases: NULL and empty texts have the feature vector of an empty text
and are scored like any other; repeated rows get equal scores; a NULL id is
no training row, and is not held out; without positives every score is the
prior; labels other than 0 and 1 are ignored; extra columns are ignored.
"""

from __future__ import annotations

from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.textnp import SPACE, text_chunks, word_spans

#: Byte groups whose shares are features.
GROUPS = ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " ", "\n", "\t\r\x0b\x0c", ".", ",", "!", "?",
          ";:", "'\"`", "()[]{}", "#", "*", "$", "%", "&", "|", "<>", "@", "+-=", "/\\_~^")
CLASS = np.full(256, len(GROUPS), np.uint8)  # everything else: bytes beyond ASCII and control bytes
for _i, _g in enumerate(GROUPS):
    CLASS[list(_g.encode())] = _i
N_SHARES = len(GROUPS) + 1
NAMES = [f"share_{i}" for i in range(N_SHARES)] + [
    "log_words", "log_lines", "mean_word", "long_words", "one_letter_words", "distinct_words", "repeat_next",
    "distinct_pairs", "upper_words", "symbol_words", "capital_words", "dup_lines", "words_per_line", "end_marks"]


def features(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """One row of ``NAMES`` per text."""
    n = len(offs) - 1
    out = np.zeros((n, len(NAMES)), np.float32)
    cls = CLASS[data]
    s, e, first = word_spans(data, offs)
    size = e - s
    upper, symbol = CLASS[np.arange(256)] == 1, (CLASS >= 13) & (CLASS <= 19)
    ups, syms = (np.concatenate(([0], np.cumsum(x[data]))) for x in (upper, symbol))
    allup = (ups[e] - ups[s]) * 2 > size
    anysym = (syms[e] - syms[s]) > 0
    cap = upper[data[s]] if len(s) else np.empty(0, bool)
    raw = data.tobytes()
    for i in range(n):
        a, b = offs[i], offs[i + 1]
        if a == b:
            continue
        row = out[i]
        row[:N_SHARES] = np.bincount(cls[a:b], minlength=N_SHARES) / (b - a)
        wa, wb = first[i], first[i + 1]
        m = wb - wa
        text = raw[a:b]
        lines = [x for x in text.split(b"\n") if x.strip()]
        words = text.split()
        if not m:
            continue
        pairs = set(zip(words, words[1:]))
        counts = len(set(words))
        nxt = sum(map(eq, words, words[1:]))
        lens = size[wa:wb]
        row[N_SHARES:] = (np.log1p(m), np.log1p(len(lines)), lens.mean(), (lens > 12).mean(), (lens == 1).mean(), counts / m, nxt / m,
                          len(pairs) / max(1, m - 1),
                          allup[wa:wb].mean(), anysym[wa:wb].mean(), cap[wa:wb].mean(), 1 - len(set(lines)) / len(lines),
                          np.log1p(m / len(lines)), (text.count(b".") + text.count(b"!") + text.count(b"?")) / m)
    return out


def feature_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, x)`` with ``x`` the float32 vector of a text as bytes."""
    def run(batches):
        for batch in batches:
            for lo, hi, data, offs in text_chunks(batch.column(1)):
                x = features(data, offs)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array([r.tobytes() for r in x], pa.binary())],
                                                 names=["doc_id", "x"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col)).mapInArrow(run, "doc_id long, x binary")


class Model:
    """Standardised features, one hidden layer of ``tanh`` units, a logistic output."""

    def __init__(self, mean, std, w1, b1, w2, b2):
        self.mean, self.std, self.w1, self.b1, self.w2, self.b2 = mean, std, w1, b1, w2, b2

    def z(self, x):
        return np.clip((x - self.mean) / self.std, -6, 6)

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(self.z(x) @ self.w1 + self.b1) @ self.w2 + self.b2

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x), -30, 30)))


def fit(pos: np.ndarray, unl: np.ndarray, prior: float, hidden: int = 16, epochs: int = 100, rate: float = 0.01,
        batch: int = 2048, seed: int = 7) -> Model:
    """Non-negative PU learning with Adam on mini-batches of positives and unlabelled rows."""
    rng = np.random.default_rng(seed)
    both = np.concatenate([pos, unl]).astype(np.float64)
    mean, std = both.mean(0), both.std(0) + 1e-6
    d = both.shape[1]
    par = [rng.normal(0, 1 / np.sqrt(d), (d, hidden)), np.zeros(hidden), rng.normal(0, 0.1, hidden), np.zeros(1)]
    model = Model(mean, std, *par)
    zp, zu = model.z(pos.astype(np.float64)), model.z(unl.astype(np.float64))
    m1, m2, step = [np.zeros_like(p) for p in par], [np.zeros_like(p) for p in par], 0
    rounds = max(1, -(-len(unl) // batch))
    for epoch in range(epochs):
        up, uu = rng.permutation(len(zp)), rng.permutation(len(zu))
        for r in range(rounds):
            xp = zp[up[np.arange(r * len(zp) // rounds, max(r * len(zp) // rounds + 1, (r + 1) * len(zp) // rounds))]]
            xu = zu[uu[r * len(zu) // rounds:(r + 1) * len(zu) // rounds]]
            hp, hu = np.tanh(xp @ par[0] + par[1]), np.tanh(xu @ par[0] + par[1])
            fp, fu = hp @ par[2] + par[3], hu @ par[2] + par[3]
            sp, su = 1 / (1 + np.exp(-fp)), 1 / (1 + np.exp(-fu))
            # Derivatives of the logistic losses log(1+exp(-f)) for + and log(1+exp(f)) for -.
            gp_pos, gp_neg, gu_neg = (sp - 1) * prior / len(xp), -sp * prior / len(xp), su / len(xu)
            negative = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
            # Where the negative part is below zero, max(0, .) has no slope: only the positive part is left.
            gp, gu = (gp_pos + gp_neg, gu_neg) if negative >= 0 else (gp_pos, np.zeros_like(gu_neg))
            dhp, dhu = np.outer(gp, par[2]) * (1 - hp * hp), np.outer(gu, par[2]) * (1 - hu * hu)
            grads = [xp.T @ dhp + xu.T @ dhu + 1e-4 * par[0], dhp.sum(0) + dhu.sum(0), hp.T @ gp + hu.T @ gu + 1e-4 * par[2],
                     np.array([gp.sum() + gu.sum()])]
            step += 1
            lr = rate * (1 - epoch / epochs) + 1e-4
            for p, g, a, b in zip(par, grads, m1, m2, strict=True):
                a *= 0.9
                a += 0.1 * g
                b *= 0.999
                b += 0.001 * g * g
                p -= lr * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.999 ** step)) + 1e-8)
    return model


def held_out(doc_id: Column) -> Column:
    """``crc32(id as text) mod 3 = 1``; False for NULL."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", prior: float | None = None,
          max_positive: int = 20_000, max_unlabelled: int = 20_000) -> tuple[Model | None, float]:
    """The model and the class prior, from a bounded sample of documents (the smallest id hashes, so reruns agree)."""
    usable = labels.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")) & F.col("quality").isin(0, 1))
    if prior is None:
        # One more of each label keeps the prior inside (0, 1).
        n = usable.agg(F.count("*").alias("n"), F.coalesce(F.sum("quality"), F.lit(0)).alias("p")).first()
        prior = (n["p"] + 1) / (n["n"] + 2)
    ids = docs.select(F.col(id_col).cast("long").alias("doc_id")).where("doc_id IS NOT NULL").distinct()
    positive = usable.where("quality = 1").select(F.col("doc_id").cast("long")).distinct()

    def sample(df, n):
        chosen = df.orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
        # At most n ids: their broadcast is bounded by the parameter.
        rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "doc_id", "left_semi")
        # One row an id, the one with the smallest text hash, so repeated rows neither count twice nor move the sample.
        one = rows.groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
        x = sorted((r["doc_id"], bytes(r["x"])) for r in feature_table(one).collect())
        return np.array([np.frombuffer(v, np.float32) for _, v in x], np.float32).reshape(-1, len(NAMES))

    pos = sample(ids.join(positive, "doc_id", "left_semi"), max_positive)
    unl = sample(ids.where(~held_out(F.col("doc_id"))), max_unlabelled)
    return (fit(pos, unl, prior) if len(pos) and len(unl) else None), prior


def _score(col: pa.Array, model: Model | None, prior: float) -> np.ndarray:
    if model is None:
        return np.full(len(col), prior)
    parts = [model.score(features(data, offs).astype(np.float64)) for _, _, data, offs in text_chunks(col)]
    return np.concatenate(parts) if parts else np.empty(0)


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every document."""
    model, prior = train(docs, labels, id_col, text_col, **options)

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_score(batch.column(1), model, prior), pa.float64())], names=["doc_id", "score"])

    scored = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col)).mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that the classifier predicts as 1, all columns unchanged."""
    model, prior = train(docs, labels, id_col, text_col, **options)
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(_score(batch.column(at), model, prior) >= 0.5))

    return docs.mapInArrow(run, docs.schema)
