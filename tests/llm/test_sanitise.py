"""Term spans against the definition, on random corpora, beyond the broadcast bound, and on one very crowded text."""

import math
import random
import re
import resource

import pytest

from strata.llm import sanitise
from tests.llm.test_operators import SCHEMA, got, rows

WORD = re.compile(r"[^\W_]+")


def brute(texts, least=0.6, remove=0.95, discount=0.0):
    contents = {t or "" for t in texts}
    n = len(contents)
    facts = {}
    for t in contents:
        base = sanitise.base_spans(t)
        inside = lambda m, base=base: any(m.start() < b and a < m.end() for _, a, b in base)
        places = {}
        for m in WORD.finditer(t):
            if not inside(m):
                places.setdefault(m[0].lower(), []).append(m.span())
        facts[t] = base, {sanitise.entity(k, t[a:b]) for k, a, b in base}, places
    n_t, n_e, n_te = {}, {}, {}
    for _, ents, places in facts.values():
        for x in places:
            n_t[x] = n_t.get(x, 0) + 1
        for e in ents:
            n_e[e] = n_e.get(e, 0) + 1
            for x in places:
                n_te[e, x] = n_te.get((e, x), 0) + 1
    def score(e, x):
        ic = -math.log(n_e[e] / n)
        c = n_te[e, x]
        return math.log(min(1, c / n_t[x]) / (n_e[e] / n)) * c / (c + discount) / ic if ic > 0 else 0.0
    out = []
    for t in texts:
        base, ents, places = facts[t or ""]
        spans, acts = [f"{k}:{a}:{b}" for k, a, b in base], []
        for a, b, d in sorted((a, b, d) for x, where in places.items() if ents and (d := max(score(e, x) for e in ents)) >= least for a, b in where):
            spans.append(f"term:{a}:{b}")
            acts.append("remove" if d >= remove else "generalise")
        out.append((",".join(spans), ",".join(acts)))
    return dict(enumerate(out))


def corpus(seed, n=120):
    rng = random.Random(seed)
    common, rare = [f"w{i}" for i in range(12)], [f"Name{i}" for i in range(40)]
    mails = [f"p{i}@x.org" for i in range(25)]
    texts = []
    for _ in range(n):
        words = rng.choices(common, k=rng.randrange(0, 25)) + rng.choices(rare, k=rng.randrange(0, 4)) + rng.choices(mails, k=rng.choice([0, 0, 1, 2, 6]))
        rng.shuffle(words)
        texts.append(" ".join(words))
    return texts + texts[:10] + [None, "", "p1@x.org", "p1@x.org p2@x.org Name1"] + [" ".join(mails) + " Contact list Name2 w1"] * 3



@pytest.mark.parametrize("seed,options", [(1, {}), (2, {"max_broadcast": 0}), (3, {"most_known": 2}), (4, {"discount": 0.5}), (5, {"generalise_at": 0.3, "remove_at": 0.7})])
def test_terms_against_the_definition(spark, seed, options):
    texts = corpus(seed)
    df = spark.createDataFrame(rows(texts), SCHEMA).repartition(5)
    plain = {k: v for k, v in options.items() if k not in ("max_broadcast", "most_known")}
    want = brute(texts, plain.get("generalise_at", 0.6), plain.get("remove_at", 0.95), plain.get("discount", 0.0))
    out = got(sanitise.sanitise(df, **options), "spans", "actions")
    assert out == want
    assert sum("term" in s for s, _ in want.values()) > 10


def test_ten_thousand_entities_and_words_in_one_text(spark):
    """Terms of a crowded text are not multiplied by its entities; a near copy makes all its entities shared."""
    names, mails = [f"Person{i}" for i in range(10_000)], [f"m{i}@list.example.org" for i in range(10_000)]
    crowded = " ".join(x for pair in zip(names, mails, strict=True) for x in pair)
    texts = [crowded, crowded + " again"] + [f"word{i % 5} filler text {i}" for i in range(60)]
    df = spark.createDataFrame(rows(texts), SCHEMA).repartition(2)
    out = got(sanitise.sanitise(df), "spans")
    assert out[0][0].count("term:") == 10_000 and out[1][0].count("term:") == 10_001 and out[5][0] == ""
    assert resource.getrusage(resource.RUSAGE_CHILDREN).ru_maxrss < 4 << 20  # KB, of any child process
