"""Phrase collocations from weighted acyclic automata.

A count transducer is an acyclic automaton over words: a path spells a phrase
and its arc weight is the number of windows that pass through, so the weight of
a path is the phrase's count.  Each task builds one from its sorted windows
(level by level: where a sorted row first differs from the one before it, a
state begins; its weight is the sum over its range of rows) and sends it in
parts, one per prefix range.  All parts of a prefix range meet in one task that
unions them and sums the weights of equal paths.  For the parts of a phrase the
frequent phrases are walked once in the order of their words and once in the
order of their reversed words: the weights along the path of a phrase are the
counts of all its first parts, and along its reversed path of all its rests.

Counting takes three passes over the text: words; pairs of frequent words;
windows of three to five words whose neighbouring pairs are all frequent.  A
part of a frequent phrase is frequent, so nothing is lost.  What a pass lets
through is a Bloom filter of at most ``max_bits`` bits (bounded broadcast; a
full filter lets more through and changes no result).

Prefix ranges are hash ranges of the first word; a word that holds more than a
range's share of all words is split by the words after it, so no hot word is
one task.  Every task sends an equal phrase once, with its sum.

Defined cases: NULL texts are empty; a NULL lang is ``und``; repeated rows all
count; texts of any length are read whole; an empty table gives an empty
result; extra columns are ignored; ties end with the phrase's UTF-8 bytes.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import partitions, written
from strata.llm.textnp import U, mix, span_hash, text_chunks, word_spans

LONGEST = 5
#: Fixed characters: pieces end at these, words also at blanks and tabs; A-Z are lower-cased.
PIECE_END = b".,;:!?\n\x0b\x0c\r"
BLANK = b" \t"

_ends = np.zeros(256, bool)
_ends[list(PIECE_END)] = True
_outside = _ends.copy()
_outside[list(BLANK)] = True
_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32
_TURN = U(0x9E3779B97F4A7C15)


def follow(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Hash of a phrase and one more word, from their hashes."""
    return mix(first * U(3) + second * _TURN + U(1))


def _salt(lang: str) -> np.uint64:
    return mix(np.array([zlib.crc32(lang.encode())], U) + _TURN)[0]


# --- automata -------------------------------------------------------------------------------------------------------


class Transducer:
    """A count transducer: sorted words, and per level the arcs in path order.

    Level ``d`` has per state (a path of ``d + 1`` words) the label of its last
    arc, its weight, and how many states follow it on the next level.
    """

    def __init__(self, words: list[bytes], levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> None:
        self.words, self.levels = words, levels

    @classmethod
    def build(cls, words: list[bytes], rows: np.ndarray, weights: np.ndarray) -> Transducer:
        """From sorted rows of labels (0: no word, then 1 + the word's place)."""
        n, depth = rows.shape
        begins = np.zeros(n, bool)
        begins[:1] = True
        levels, above = [], None
        for d in range(depth):
            begins = begins.copy()
            begins[1:] |= rows[1:, d] != rows[:-1, d]
            at = np.flatnonzero(begins)
            sums = np.add.reduceat(weights, at) if n else weights
            here = rows[at, d] > 0
            if not here.any():
                break
            if above is not None:
                parent = np.searchsorted(above, at[here], "right") - 1
                levels[-1] = (*levels[-1][:2], np.bincount(parent, minlength=len(above)).astype(np.int64))
            above = at[here]
            levels.append((rows[above, d].astype(np.int64) - 1, sums[here], np.zeros(len(above), np.int64)))
        return cls(words, levels)

    def paths(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per level the labels of every path (a row each) and its weight."""
        out, before = [], None
        for d, (labels, weights, _) in enumerate(self.levels):
            if d:
                before = np.repeat(before, self.levels[d - 1][2], axis=0)
            before = labels[:, None] if before is None else np.hstack([before, labels[:, None]])
            out.append((before, weights))
        return out

    def dump(self) -> bytes:
        head = [len(self.words), len(self.levels), *(len(labels) for labels, _, _ in self.levels)]
        parts = [struct.pack(f"<{len(head)}q", *head), np.array([len(w) for w in self.words], "<u4").tobytes(), b"".join(self.words)]
        for level in self.levels:
            for a in level:
                kind = "<u4" if not len(a) or a.max() < 1 << 32 else "<u8"
                parts += [kind[-1].encode(), a.astype(kind).tobytes()]
        return zlib.compress(b"".join(parts), 1)

    @classmethod
    def load(cls, blob: bytes) -> Transducer:
        data = zlib.decompress(blob)
        n, depth = struct.unpack_from("<2q", data)
        sizes = struct.unpack_from(f"<{depth}q", data, 16)
        at = 16 + 8 * depth
        ends = np.cumsum(np.frombuffer(data, "<u4", n, at), dtype=np.int64)
        at += 4 * n
        words = [data[at + lo:at + hi] for lo, hi in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)] if n else []
        at += int(ends[-1]) if n else 0
        levels = []
        for size in sizes:
            level = []
            for _ in range(3):
                width = int(data[at:at + 1])
                level.append(np.frombuffer(data, f"<u{width}", size, at + 1).astype(np.int64))
                at += 1 + width * size
            levels.append(tuple(level))
        return cls(words, levels)


def summed(rows: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct rows with the sums of their weights."""
    if len(rows) < 2:
        return rows, weights
    order = np.lexsort(rows.T[::-1])
    rows, weights = rows[order], weights[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]).any(axis=1)
    at = np.flatnonzero(new)
    return rows[at], np.add.reduceat(weights, at)


class Union:
    """The union of transducers: paths of each level with summed weights."""

    def __init__(self, compact: int = 2_000_000) -> None:
        self.places: dict[bytes, int] = {}
        self.levels: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(LONGEST)]
        self.held, self.compact = 0, compact

    def add(self, part: Transducer) -> None:
        places = self.places
        label = np.array([places.setdefault(w, len(places)) for w in part.words], np.int64)
        for d, (paths, weights) in enumerate(part.paths()):
            self.levels[d].append((label[paths], weights))
            self.held += len(weights)
        if self.held > self.compact:
            self._sum()
            self.compact = max(self.compact, 2 * self.held)

    def _sum(self) -> None:
        for d, parts in enumerate(self.levels):
            if len(parts) > 1:
                self.levels[d] = [summed(np.vstack([p for p, _ in parts]), np.concatenate([w for _, w in parts]))]
        self.held = sum(len(w) for parts in self.levels for _, w in parts)

    def frequent(self, least: int, shortest: int) -> Iterator[tuple[bytes, int, int]]:
        """``(phrase, words, count)`` of the paths with enough weight."""
        self._sum()
        words = list(self.places)
        for d in range(shortest - 1, LONGEST):
            for paths, weights in self.levels[d]:
                keep = weights >= least
                for path, weight in zip(paths[keep].tolist(), weights[keep].tolist(), strict=True):
                    yield b" ".join(words[i] for i in path), d + 1, weight


# --- one task's windows ---------------------------------------------------------------------------------------------


class Shard:
    """Words and windows of one language in one task."""

    def __init__(self, lang: str) -> None:
        self.salt = _salt(lang)
        self.places: dict[bytes, int] = {}
        self.hashes = np.zeros(1024, U)
        self.counts = np.zeros(1024, np.int64)
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0

    def read(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Per piece of the column: the place of every word, and how many words its piece of text still has from it."""
        for _, _, data, offs in text_chunks(texts, 1 << 23):
            data = _lower[data]
            s, e, first = word_spans(data, offs, _outside)
            if not len(s):
                continue
            lengths = np.zeros(len(s) + 1, np.int64)
            np.cumsum(e - s, out=lengths[1:])
            body = data[~_outside[data]]
            array = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(s), [None, pa.py_buffer(lengths), pa.py_buffer(body)])
            coded = array.dictionary_encode()
            known = coded.dictionary
            ends = np.frombuffer(known.buffers()[1], np.int64)[:len(known) + 1]
            hashes = mix(span_hash(np.frombuffer(known.buffers()[2], np.uint8).astype(U) + U(1), ends[:-1], ends[1:]) + self.salt)
            places = self.places
            place = np.array([places.setdefault(w, len(places)) for w in known.to_pylist()], np.int64)
            if len(places) > len(self.hashes):
                more = max(len(places), 2 * len(self.hashes)) - len(self.hashes)
                self.hashes = np.concatenate([self.hashes, np.zeros(more, U)])
                self.counts = np.concatenate([self.counts, np.zeros(more, np.int64)])
            self.hashes[place] = hashes
            ids = place[coded.indices.to_numpy()]
            # A word is the last of its piece if a piece end or a row's end comes before the next word.
            seen = np.cumsum(_ends[data], dtype=np.int64)
            last = np.ones(len(s), bool)
            last[:-1] = seen[s[1:] - 1] > seen[e[:-1] - 1]
            starts = first[1:-1]
            last[starts[(starts > 0)] - 1] = True
            stop = np.flatnonzero(last)
            left = np.repeat(stop, np.diff(stop, prepend=-1)) - np.arange(len(s)) + 1
            yield ids, left

    def add(self, rows: np.ndarray) -> None:
        self.parts.append(summed(rows, np.ones(len(rows), np.int64)))
        self.held += len(self.parts[-1][1])
        if self.held > 4_000_000 and len(self.parts) > 1:
            self.sum()

    def sum(self) -> tuple[np.ndarray, np.ndarray]:
        if len(self.parts) > 1:
            self.parts = [summed(np.vstack([r for r, _ in self.parts]), np.concatenate([w for _, w in self.parts]))]
        self.held = len(self.parts[0][1]) if self.parts else 0
        return self.parts[0] if self.parts else (np.zeros((0, LONGEST), np.int64), np.zeros(0, np.int64))

    def full(self) -> bool:
        return self.held > 6_000_000 or len(self.places) > 2_000_000


class Bloom:
    """Two bits per hash in a table of a power of two bits."""

    def __init__(self, table: np.ndarray) -> None:
        self.table, self.mask = table, U(64 * len(table) - 1)

    @staticmethod
    def bits(h: np.ndarray, mask: np.uint64) -> tuple[np.ndarray, np.ndarray]:
        return h & mask, (h >> U(32)) * U(0xD1342543DE82EF95) >> U(17) & mask

    def has(self, h: np.ndarray) -> np.ndarray:
        a, b = self.bits(h, self.mask)
        one = U(1)
        return (((self.table[a >> U(6)] >> (a & U(63))) & (self.table[b >> U(6)] >> (b & U(63)))) & one).astype(bool)


def _phrase_hashes(lang: str, phrases: list[bytes]) -> np.ndarray:
    """The hashes of phrases (all of as many words) as the tasks compute them."""
    columns = list(zip(*(p.split(b" ") for p in phrases), strict=True))
    salt = _salt(lang)
    out = None
    for words in columns:
        data = np.frombuffer(b"".join(words), np.uint8).astype(U) + U(1)
        ends = np.cumsum([0, *map(len, words)])
        h = mix(span_hash(data, ends[:-1], ends[1:]) + salt)
        out = h if out is None else follow(out, h)
    return out


def bloom(frequent: DataFrame, max_bits: int) -> Bloom:
    """The filter of ``frequent`` (``lang, phrase``; phrases of one length): 32 bits an entry, at most ``max_bits``; its words are or-ed over all tasks."""
    n = frequent.count()
    mask = min(max_bits, max(1 << 12, 1 << (32 * n - 1).bit_length() if n else 0)) - 1

    def run(batches):
        for batch in batches:
            table: dict[int, int] = {}
            langs = np.array(batch.column(0).to_pylist(), object)
            phrases = np.array([p.encode() for p in batch.column(1).to_pylist()], object)
            for lang in set(langs):
                for bit in np.concatenate(Bloom.bits(_phrase_hashes(lang, phrases[langs == lang].tolist()), U(mask))).tolist():
                    table[bit >> 6] = table.get(bit >> 6, 0) | 1 << (bit & 63)
            slots = np.fromiter(table.keys(), np.int64, len(table))
            words = np.fromiter(table.values(), U, len(table)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(slots), pa.array(words)], names=["slot", "word"])

    rows = frequent.select("lang", "phrase").mapInArrow(run, "slot long, word long").groupBy("slot").agg(F.expr("bit_or(word)").alias("word")).toArrow()
    table = np.zeros((mask + 1) // 64, U)
    table[rows["slot"].to_numpy()] = rows["word"].to_numpy().view(U)
    return Bloom(table)


# --- passes ---------------------------------------------------------------------------------------------------------


def _by_lang(batch: pa.RecordBatch) -> Iterator[tuple[str, pa.Array]]:
    langs, texts = batch.column(0).dictionary_encode(), batch.column(1)
    for i, lang in enumerate(langs.dictionary.to_pylist()):
        yield lang, texts.take(pa.array(np.flatnonzero(langs.indices.to_numpy() == i)))


def word_counts(docs: DataFrame) -> DataFrame:
    """``lang, phrase, n`` of all words (``docs``: ``lang, text``)."""
    def run(batches):
        shards: dict[str, Shard] = {}

        def out(lang):
            shard = shards.pop(lang)
            n = len(shard.places)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * n, pa.string()), pa.array(list(shard.places), pa.binary()).cast(pa.string()), pa.array(shard.counts[:n])],
                                             names=["lang", "phrase", "n"])

        for batch in batches:
            for lang, texts in _by_lang(batch):
                shard = shards.setdefault(lang, Shard(lang))
                for ids, _ in shard.read(texts):
                    shard.counts += np.bincount(ids, minlength=len(shard.counts))
                if shard.full():
                    yield from out(lang)
        for lang in list(shards):
            yield from out(lang)

    return docs.mapInArrow(run, "lang string, phrase string, n long").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def _windows(shard: Shard, ids: np.ndarray, left: np.ndarray, words: Bloom, pairs: Bloom | None) -> np.ndarray:
    """Rows of places + 1 (0: none) of the windows whose words, or neighbouring pairs, are frequent."""
    good = words.has(shard.hashes[:len(shard.places)])[ids]
    pair = good.copy()
    pair[-1:] = False
    pair[:-1] &= good[1:] & (left[:-1] > 1)
    at = np.flatnonzero(pair)
    if pairs is None:
        return np.stack([ids[at], ids[at + 1]], axis=1) + 1
    h = shard.hashes
    pair[at] = pairs.has(follow(h[ids[at]], h[ids[at + 1]]))
    reach = np.concatenate([pair, np.zeros(LONGEST, bool)])
    at = np.flatnonzero(pair[:-1] & pair[1:]) if len(pair) > 1 else np.zeros(0, np.int64)
    rows = np.zeros((len(at), LONGEST), np.int64)
    alive = np.ones(len(at), bool)
    padded = np.concatenate([ids, np.zeros(LONGEST, np.int64)])
    for d in range(LONGEST):
        if d:
            alive = alive & reach[at + d - 1]
        rows[:, d] = np.where(alive, padded[at + d] + 1, 0)
    return rows


def _parts(lang: str, shard: Shard, ranges: int, hot: dict[tuple[str, bytes], int]) -> Iterator[tuple[str, int, bytes]]:
    """The shard's transducer, cut into one per prefix range."""
    rows, weights = shard.sum()
    if not len(rows):
        return
    h = np.concatenate([np.zeros(1, U), shard.hashes[:len(shard.places)]])
    words = [None, *shard.places]
    split = np.ones(len(words), U)
    for i in np.unique(rows[:, 0]).tolist():
        split[i] = hot.get((lang, words[i]), 1)
    rest = follow(h[rows[:, 1]], h[rows[:, 2]] if rows.shape[1] > 2 else U(0))
    at = ((h[rows[:, 0]] >> U(20)) + (rest >> U(20)) % split[rows[:, 0]]) % U(ranges)
    order = np.argsort(at, kind="stable")
    rows, weights, at = rows[order], weights[order], at[order]
    cuts = np.flatnonzero(np.diff(at)) + 1
    for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(at)], strict=True):
        mine = rows[lo:hi]
        used = np.unique(mine)
        used = used[used > 0]
        spelled = sorted((words[i], i) for i in used.tolist())
        label = np.zeros(len(words) if len(used) * 4 > len(words) else int(used[-1]) + 1, np.int64)
        label[[i for _, i in spelled]] = np.arange(1, len(spelled) + 1)
        mine, w = summed(label[mine], weights[lo:hi])
        yield lang, int(at[lo]), Transducer.build([word for word, _ in spelled], mine, w).dump()


def frequent_phrases(docs: DataFrame, words: Bloom, pairs: Bloom | None, least: int, ranges: int, hot: dict) -> DataFrame:
    """``lang, phrase, words, f`` with ``f >= least``: pairs, or with ``pairs`` given, phrases of three to five words."""
    shared = docs.sparkSession.sparkContext.broadcast((words, pairs, hot))
    shortest = 2 if pairs is None else 3

    def count(batches):
        words, pairs, hot = shared.value
        shards: dict[str, Shard] = {}

        def out(lang):
            found = list(_parts(lang, shards.pop(lang), ranges, hot))
            for i in range(0, len(found), 64):
                part = found[i:i + 64]
                yield pa.RecordBatch.from_arrays([pa.array([x for x, _, _ in part], pa.string()), pa.array([x for _, x, _ in part], pa.int64()),
                                                  pa.array([x for _, _, x in part], pa.binary())], names=["lang", "prefix", "part"])

        for batch in batches:
            for lang, texts in _by_lang(batch):
                shard = shards.setdefault(lang, Shard(lang))
                for ids, left in shard.read(texts):
                    shard.add(_windows(shard, ids, left, words, pairs))
                if shard.full():
                    yield from out(lang)
        for lang in list(shards):
            yield from out(lang)

    def union(batches):
        now, whole = None, Union()

        def out():
            found = list(whole.frequent(least, shortest)) if now else []
            for i in range(0, len(found), 10_000):
                part = found[i:i + 10_000]
                yield pa.RecordBatch.from_arrays([pa.array([now[0]] * len(part), pa.string()), pa.array([x for x, _, _ in part], pa.binary()).cast(pa.string()),
                                                  pa.array([x for _, x, _ in part], pa.int32()), pa.array([x for _, _, x in part], pa.int64())],
                                                 names=["lang", "phrase", "words", "f"])

        for batch in batches:
            for lang, prefix, part in zip(*(c for c in batch.columns), strict=True):
                key = (lang.as_py(), prefix.as_py())
                if key != now:
                    yield from out()
                    now, whole = key, Union()
                whole.add(Transducer.load(part.as_py()))
        yield from out()

    parts = docs.mapInArrow(count, "lang string, prefix long, part binary")
    return parts.repartition(ranges, "prefix").sortWithinPartitions("lang", "prefix").mapInArrow(union, "lang string, phrase string, words int, f long")


def _path_weights(phrases: DataFrame, out: str, backwards: bool) -> DataFrame:
    """Adds the counts of each phrase's first parts (or, ``backwards``, of its last ones), shortest first.

    Phrases are walked in the order of their (reversed) words; every part of a
    frequent phrase is frequent, so the states on the path to a phrase come
    right before it, and the stack holds one path.
    """
    spelled = F.split("phrase", " ")
    path = F.reverse(spelled) if backwards else spelled
    walked = phrases.withColumn("path", path)
    near = walked.repartition("lang", F.col("path")[0]).sortWithinPartitions("lang", "path")
    schema = near.drop("path").schema.add(out, T.ArrayType(T.LongType()))
    names = [f.name for f in near.drop("path").schema]

    def run(batches):
        lang, stack = None, []
        for batch in batches:
            weights = []
            for now, path, f in zip(*(batch.column(c).to_pylist() for c in ("lang", "path", "f")), strict=True):
                if now != lang:
                    lang, stack = now, []
                while len(stack) >= len(path) or any(w != p for (w, _), p in zip(stack, path)):  # noqa: B905
                    stack.pop()
                assert len(stack) == len(path) - 1, (now, path)
                weights.append([f for _, f in stack])
                stack.append((path[-1], f))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(weights, pa.list_(pa.int64()))], names=[*names, out])

    return near.mapInArrow(run, schema)


def collocations(docs: DataFrame, least: int = 100, top: int = 2000, text_col: str = "text", lang_col: str = "lang",
                 max_bits: int = 1 << 27, range_words: int = 2_000_000) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the first ``top`` phrases of each language."""
    base = docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    counted = written(word_counts(base), "phrase-words")
    sizes = written(counted.groupBy("lang").agg(F.sum("n").alias("n")), "phrase-sizes")
    total = int(sizes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"])
    ranges = max(partitions(docs), -(-total // range_words))
    one = counted.where(F.col("n") >= least).select("lang", "phrase", F.lit(1).alias("words"), F.col("n").alias("f"))
    # Words with more than a range's share of all words: fewer than there are ranges.
    hot = {(r["lang"], r["phrase"].encode()): -(-r["n"] * ranges // total) for r in counted.where(F.col("n") * ranges > total).collect()}
    words = bloom(one, max_bits)
    two = written(frequent_phrases(base, words, None, least, ranges, hot), "phrase-pairs")
    more = written(frequent_phrases(base, words, bloom(two, max_bits), least, ranges, hot), "phrase-longer")
    frequent = one.unionByName(two).unionByName(more)
    parts = _path_weights(_path_weights(frequent, "firsts", False), "lasts", True).where("words > 1")
    exact = "CAST({} AS DECIMAL(38, 0))"
    cut = (f"struct(({exact.format('1000')} * {exact.format('f')} * {exact.format('n')}) div ({exact.format('firsts[k - 1]')} * {exact.format('lasts[words - k - 1]')}) AS score, "
           "k, firsts[k - 1] AS l, lasts[words - k - 1] AS r)")
    scored = parts.join(sizes, "lang").withColumn("best", F.expr(f"array_min(transform(sequence(1, words - 1), k -> {cut}))"))
    # A phrase that holds a part as often as the part occurs: one word longer is enough, as counts never grow with length.
    spelled = F.split("phrase", " ")
    longer = more.select("lang", "f", F.explode(F.array(F.slice(spelled, F.lit(1), F.col("words") - 1), F.slice(spelled, F.lit(2), F.col("words") - 1))).alias("part"))
    inside = longer.groupBy("lang", F.array_join("part", " ").alias("phrase")).agg(F.max("f").alias("most"))
    kept = scored.join(inside, ["lang", "phrase"], "left").where("most IS NULL OR most < f")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    flat = kept.select("lang", "phrase", F.col("f").alias("a"), F.col("best.l").alias("l"), F.col("best.r").alias("r"), "n", F.col("best.score").cast("long").alias("score"))
    return flat.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
