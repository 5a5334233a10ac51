"""Information-theoretic sanitisation of personal data.

Protected entities (e-mail, IP, card and phone values) are found in every
text.  The document is the context: every word outside the entities is a term
of it.  Over the distinct contents of the corpus we count in how many an
entity ``e`` occurs, in how many of them with term ``t``, and in how many
``t`` occurs.  A term discloses an entity to the degree

    disclosure(t, e) = PMI(t, e) / IC(e) = log(p(t, e) / (p(t) p(e))) / -log p(e)

which is 1 when seeing the term gives the entity away, also if both occur only
once.  In a document with the entity every occurrence of a term whose
disclosure reaches ``generalise_at`` is generalised (replaced by its shape),
of one that reaches ``remove_at`` removed.  Copies of a content count once in
all counts, so duplicated documents do not make their wording look revealing.

With ``discount`` > 0 the PMI is multiplied by ``n_te / (n_te + discount)``, so
a pair that was seen once counts less (0: no discount, the plain definition).

Plan: a first pass over the texts writes the base spans, the entities per
content and partial counts of terms (contents that several tasks counted are
taken off again).  Because ``n_te <= n_e``, most terms are too frequent to
disclose an entity; a second pass, over texts with entities, writes the
remaining terms of a content once, with their places.  Entities that occur
once need no counting (``n_te`` is 1).  The others fall into classes of equal
sets of contents, which have equal counts with every term; classes and terms
of a content meet in a join that streams, so a content's entities and terms
are never multiplied in one list.  Contents are told apart by 128 bits of their
SHA-256.  Texts are shuffled only if a count shows more than 1,000,000 contents
in several tasks.

Defined cases: NULL and empty texts have no spans; repeated rows give
repeated results and count once as context; a NULL id stays NULL; extra
columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import KEY, doc_id, keyed, written

KINDS = ("email", "ip", "card", "phone", "term")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
WORD = re.compile(r"[^\W_]+")

Span = tuple[str, int, int]


def _emails(text: str) -> list[Span]:
    """Leftmost matches of ``local@label(.label)+`` by walking the at signs: linear also on long runs."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        a = at
        while a > last and text[a - 1] in LOCAL:
            a -= 1
        if a < at and (m := DOMAIN.match(text, at + 1)):
            out.append(("email", a, m.end()))
            last = m.end()
        at = text.find("@", max(at + 1, last))
    return out


def _luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Base entities: leftmost non-overlapping per kind, failing matches dropped, ordered by kind, then start."""
    out = _emails(text) if "@" in text else []
    if "." in text:
        out += [("ip", *m.span()) for m in IP.finditer(text)
                if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = re.sub("[^0-9]", "", m[0])
            if 13 <= len(digits) <= 19 and _luhn(digits):
                out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in PHONE.finditer(text)
                if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return out


def entity(kind: str, value: str) -> str:
    """One spelling per protected entity."""
    return f"{kind}:{value.lower() if kind in ('email', 'ip') else re.sub('[^0-9]', '', value)}"


def term_places(text: str, base: list[Span]) -> dict[str, list[tuple[int, int]]]:
    """The terms of a text, lower-cased, with all their places outside its entities."""
    taken: list[list[int]] = []
    for a, b in sorted((a, b) for _, a, b in base):
        if taken and a <= taken[-1][1]:
            taken[-1][1] = max(b, taken[-1][1])
        else:
            taken.append([a, b])
    i, out = 0, {}
    for m in WORD.finditer(text):
        while i < len(taken) and taken[i][1] <= m.start():
            i += 1
        if i == len(taken) or m.end() <= taken[i][0]:
            out.setdefault(m[0].lower(), []).append(m.span())
    return out


def _contents(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(_doc, _hash, text)`` as :func:`keyed`, with 128 bits of the text's SHA-256 as ``_hash`` (NULL as the empty text)."""
    return keyed(docs, id_col, text_col).withColumn("_hash", F.substring(F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)), 1, 16))


def _pack(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)


def _scan(docs: DataFrame) -> DataFrame:
    """First pass over the texts: rows of tag ``doc`` (``n`` is 1 if the task counted the content), ``ent`` and ``df`` (see the module text)."""
    flush = 200_000
    schema = pa.schema([("tag", pa.string()), ("_doc", pa.int64()), ("_hash", pa.binary()), ("name", pa.string()),
                        ("base_spans", pa.string()), ("n", pa.int64())])

    def run(batches):
        counts: Counter = Counter()
        met: set[bytes] = set()
        for batch in batches:
            rows = []
            for doc, h, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                text = text or ""
                base = base_spans(text)
                rows.append(("doc", doc, h, None, ",".join(f"{k}:{a}:{b}" for k, a, b in base), int(h not in met)))
                if h in met:
                    continue
                met.add(h)
                rows += [("ent", None, h, e, None, None) for e in {entity(k, text[a:b]) for k, a, b in base}]
                counts.update(term_places(text, base).keys() if base else {w.lower() for w in set(WORD.findall(text))})
                if len(counts) > flush:
                    yield _pack(schema, [("df", None, None, t, None, n) for t, n in counts.items()])
                    counts.clear()
            yield _pack(schema, rows)
        yield _pack(schema, [("df", None, None, t, None, n) for t, n in counts.items()])

    return docs.mapInArrow(run, "tag string, _doc long, _hash binary, name string, base_spans string, n long")


def _term_counts(docs: DataFrame, rows: DataFrame, max_broadcast: int = 1_000_000) -> DataFrame:
    """``(term, n_t)``: distinct contents with the term.  Contents that several tasks counted are taken off again, from one copy each."""
    schema = pa.schema([("term", pa.string()), ("n", pa.int64())])
    copies = rows.where("tag = 'doc'").groupBy("_hash").agg((F.sum("n") - 1).alias("extra")).where("extra > 0")
    copies = written(copies, "pii-copies")
    if copies.count() <= max_broadcast:
        # Counted, so the texts stay where they are.
        copies = F.broadcast(copies)
    again = docs.join(copies, "_hash").groupBy("_hash").agg(F.first("text").alias("text"), F.first("extra").alias("extra"))

    def run(batches):
        for batch in batches:
            out = []
            for text, extra in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                out += [(t, -extra) for t in term_places(text or "", base_spans(text or ""))]
            yield _pack(schema, out)

    off = again.select("text", "extra").mapInArrow(run, "term string, n long")
    return (rows.where("tag = 'df'").select(F.col("name").alias("term"), "n").unionByName(off)
            .groupBy("term").agg(F.sum("n").alias("n_t")))


def _near(docs: DataFrame, often: dict[str, int], hot: dict[str, int], other: int, n: int, least: float) -> DataFrame:
    """Second pass, over the texts with entities: ``(_hash, terms)``, once per task and content, with every term's places.

    ``n_te <= n_e`` bounds the disclosure of a term from above, most weakly for
    the most frequent entity; terms that cannot reach ``least`` are left out
    here.  ``often`` and ``hot`` hold the most frequent terms and entities, so
    an unknown term passes and an unknown entity occurs at most ``other`` times.
    """
    item = pa.struct([("term", pa.string()), ("places", pa.string())])
    schema = pa.schema([("_hash", pa.binary()), ("terms", pa.list_(item))])
    shared = docs.sparkSession.sparkContext.broadcast((often, hot))

    def run(batches):
        often, hot = shared.value
        met: set[bytes] = set()
        for batch in batches:
            out, size = [], 0
            for h, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if not text or h in met or not (base := base_spans(text)):
                    continue
                met.add(h)
                n_e = max(hot.get(e, other) for e in {entity(k, text[a:b]) for k, a, b in base})
                most = n_e * (n / n_e) ** (1 - least) * (1 + 1e-9)
                out.append((h, [{"term": t, "places": " ".join(f"{a}:{b}" for a, b in x)} for t, x in term_places(text, base).items() if often.get(t, 0) <= most]))
                size += len(text)
                if size > 4 << 20:
                    yield _pack(schema, out)
                    out, size = [], 0
            yield _pack(schema, out)

    return docs.select("_hash", "text").mapInArrow(run, "_hash binary, terms array<struct<term:string,places:string>>")


def disclosure(n_te: Column, n_t: Column, n_e: Column, n: int, discount: float = 0.0) -> Column:
    """PMI of a term and an entity over the entity's information content; 0 for an entity of every content."""
    p_te, p_t, p_e = (c / F.lit(float(n)) for c in (n_te, n_t, n_e))
    ic = -F.log(p_e)
    pmi = F.log(F.least(F.lit(1.0), p_te / p_t) / p_e) * (n_te / (n_te + F.lit(float(discount))))
    return F.when(ic > 0, pmi / ic).otherwise(F.lit(0.0))


def _classes(entities: DataFrame) -> DataFrame:
    """``(_hash, solo, classes)`` of the contents with entities (``_hash, entity`` rows, distinct).

    ``solo``: one of them occurs nowhere else.  ``classes``: those that occur
    again, as classes of entities with equal sets of contents (a 128-bit
    digest of the set, and its size ``n_e``).
    """
    sets = entities.groupBy("entity").agg(F.count("*").alias("n_e"), *(F.bit_xor(F.xxhash64("_hash", F.lit(i))).alias(f"s{i}") for i in (1, 2)))
    member = entities.join(sets, "entity").groupBy("_hash", "n_e", "s1", "s2").agg(F.count("*").alias("members"))
    return member.groupBy("_hash").agg(F.max(F.col("n_e") == 1).alias("solo"),
                                       F.collect_list(F.when(F.col("n_e") > 1, F.struct("n_e", "s1", "s2"))).alias("classes"))


def _sanitised(docs: DataFrame, id_col: str, text_col: str, generalise_at: float = 0.6, remove_at: float = 0.95,
               most_known: int = 100_000, discount: float = 0.0, max_broadcast: int = 1_000_000) -> DataFrame:
    docs = _contents(docs, id_col, text_col)
    rows = written(_scan(docs), "pii")
    base = rows.where("tag = 'doc'").select(*KEY, "base_spans")
    n = max(1, base.select("_hash").distinct().count())
    terms = written(_term_counts(docs, rows, max_broadcast), "pii-terms")
    entities = written(rows.where("tag = 'ent'").select("_hash", F.col("name").alias("entity")).distinct(), "pii-entities")
    # Only to leave out terms early: at most ``most_known`` rows of each on the driver, the rest is decided in the joins.
    often = {r["term"]: r["n_t"] for r in terms.where(F.col("n_t") > n ** (1 - generalise_at)).orderBy(F.desc("n_t"), "term").limit(most_known).collect()}
    hot = {r["entity"]: r["n_e"] for r in entities.groupBy("entity").agg(F.count("*").alias("n_e")).where("n_e > 1")
           .orderBy(F.desc("n_e"), "entity").limit(most_known).collect()}
    other = min(hot.values()) if 0 < len(hot) == most_known else n if most_known == 0 else 1
    # Copies of a content come from several tasks; one row per content stays.
    near = _near(docs, often, hot, other, n, generalise_at).groupBy("_hash").agg(F.first("terms").alias("terms"))
    held = written(near.join(_classes(entities), "_hash"), "pii-contents")
    term, kind = F.explode("terms").alias("t"), F.explode("classes").alias("c")
    known = held.select("_hash", "solo", term).select("_hash", "solo", "t.term", "t.places").join(terms, "term")
    one = F.lit(1).cast("long")
    alone = known.where("solo").select("_hash", "places", disclosure(one, F.col("n_t"), one, n, discount).alias("d")).where(F.col("d") >= generalise_at)
    # Classes of entities that occur again: pairs are streamed through a partial count, and again to those that disclose.
    pairs = held.where(F.size("classes") > 0).select("_hash", "terms", kind).select("_hash", "c.*", term).select("_hash", "n_e", "s1", "s2", "t.term", "t.places")
    counted = pairs.groupBy("n_e", "s1", "s2", "term").agg(F.count("*").alias("n_te")).join(terms, "term")
    strong = written(counted.select("n_e", "s1", "s2", "term", disclosure(F.col("n_te"), F.col("n_t"), F.col("n_e"), n, discount).alias("d"))
                     .where(F.col("d") >= generalise_at), "pii-strong")
    shared = pairs.join(strong, ["n_e", "s1", "s2", "term"]).select("_hash", "places", "d")
    place = F.split("p", ":")
    added = (alone.unionByName(shared).groupBy("_hash", "places").agg(F.max("d").alias("d"))
             .select("_hash", "d", F.explode(F.split("places", " ")).alias("p"))
             .groupBy("_hash").agg(F.sort_array(F.collect_list(F.struct(
                 place[0].cast("long").alias("start"), place[1].cast("long").alias("stop"), "d"))).alias("t")))
    spans = F.array_join(F.transform("t", lambda x: F.concat_ws(":", F.lit("term"), x["start"].cast("string"), x["stop"].cast("string"))), ",")
    acts = F.array_join(F.transform("t", lambda x: F.when(x["d"] >= remove_at, "remove").otherwise("generalise")), ",")
    return (base.join(added, "_hash", "left")
            .select(*KEY, "base_spans",
                    F.concat_ws(",", F.when(F.col("base_spans") != "", F.col("base_spans")), spans).alias("spans"),
                    F.coalesce(acts, F.lit("")).alias("actions")))


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per document: ``doc_id``, ``base_spans`` and ``spans`` (``kind:start:end``, code points), ``actions``.

    ``spans`` adds ``term`` spans to the base ones; ``actions`` lists for each
    added span ``generalise`` or ``remove``, in the order of the spans.  Options: see :func:`_sanitised`.
    """
    found = _sanitised(docs, id_col, text_col, **options)
    return found.select(doc_id(), "base_spans", "spans", "actions")


def apply_spans(text: str | None, spans: str, actions: str) -> str | None:
    """The sanitised text: entities as ``[KIND]``, terms as their shape (``Xx``, ``x``) or removed."""
    if text is None:
        return None
    acts = iter(actions.split(",") if actions else [])
    found = []
    for s in filter(None, spans.split(",")):
        kind, a, b = s.split(":")
        found.append((int(a), int(b), kind, next(acts) if kind == "term" else ""))
    out, at = [], 0
    for a, b, kind, act in sorted(found):
        if a < at:
            at = max(at, b)
            continue
        word = text[a:b]
        shape = ("X" if word[0].isupper() else "") + "x" * (not word.isupper())
        out += [text[at:a], f"[{kind.upper()}]" if kind != "term" else "" if act == "remove" else shape]
        at = b
    return "".join(out + [text[at:]])


def sanitised_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``(doc_id, text)`` with the spans of :func:`sanitise` applied; texts and spans meet on id and content."""
    found = _sanitised(docs, id_col, text_col, **options).select(*KEY, "spans", "actions").distinct()
    use = F.udf(apply_spans, "string")
    return (_contents(docs, id_col, text_col).join(found, KEY)
            .select(doc_id(), use("text", "spans", "actions").alias("text")))
