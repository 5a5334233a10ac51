"""Plain restatements of the operators' contracts, slow and independent of the package."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text) -> str:
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def secrets(text):
    text = text or ""
    found = [("assign", *m.span()) for m in re.finditer(
        r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD])|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text)
        if len(m[2]) >= 6]
    found += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    kinds = ["assign", "access", "hex"]
    found.sort(key=lambda s: (s[1], kinds.index(s[0])))
    n = Counter(s[0] for s in found)
    return n["assign"], n["access"], n["hex"], sha(",".join(f"{k}:{a}:{b}" for k, a, b in found))


def repeats(units: dict, length: int) -> dict:
    """Per key the set of units covered by windows that start anywhere else too."""
    seen = defaultdict(list)
    for d, u in units.items():
        for i in range(len(u) - length + 1):
            seen[u[i:i + length]].append((d, i))
    out = {d: set() for d in units}
    for places in seen.values():
        if len(places) > 1:
            for d, i in places:
                out[d].update(range(i, i + length))
    return out


def substring(texts: dict, length: int = 35) -> dict:
    units = {d: tuple(WORD.findall(t or "")) for d, t in texts.items()}
    gone = repeats(units, length)
    return {d: (len(u), len(gone[d]), sha(" ".join(w for i, w in enumerate(u) if i not in gone[d]))) for d, u in units.items()}


def suffix(texts: dict, length: int = 400) -> dict:
    units = {d: (t or "").encode() for d, t in texts.items()}
    gone = repeats(units, length)
    return {d: (len(u), len(gone[d]), sum(i - 1 not in gone[d] for i in gone[d]),
                sha(bytes(c for i, c in enumerate(u) if i not in gone[d]))) for d, u in units.items()}


def contamination(texts: dict, items: dict) -> dict:
    words = lambda t: tuple(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")))
    target = defaultdict(set)
    for item, t in items.items():
        w = words(t)
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            target[w[i:i + n]].add(item)
    sizes = {len(w) for w in target}
    out = {}
    for d, t in texts.items():
        w = words(t)
        hit, named = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if w[i:i + n] in target:
                    hit.update(range(i, i + n))
                    named |= target[w[i:i + n]]
        out[d] = (len(w), len(hit), len(named), sha(",".join(sorted(map(str, named)))), bool(hit))
    return out


def simhash(texts: dict) -> dict:
    fps = {}
    for d, t in texts.items():
        w = [x.decode() for x in (t or "").encode().lower().split()]
        grams = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
        hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
        fps[d] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))
    distinct = sorted(set(fps.values()))
    root = {f: f for f in distinct}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, a in enumerate(distinct):
        for b in distinct[i + 1:]:
            if (a ^ b).bit_count() <= 2:
                root[find(a)] = find(b)
    least = {}
    for d, f in fps.items():
        r = find(f)
        least[r] = min(least.get(r, d), d)
    return {d: (f"{f:016x}", least[find(f)]) for d, f in fps.items()}


def quality_base(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    n = Counter(grams)
    covered = {j for i, g in enumerate(grams) if n[g] > 1 for j in range(i, i + 8)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
            len(w) < 20 or 100 * len(covered) > 30 * len(w))


def personal(text):
    text = text or ""
    out = {"email": [m.span() for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)] if "@" in text else []}
    out["ip"] = [m.span() for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]

    def luhn(s):
        total = 0
        for i, c in enumerate(reversed(s)):
            d = int(c) * (1 + i % 2)
            total += d - 9 * (d > 9)
        return total % 10 == 0
    digits = lambda s: re.sub("[^0-9]", "", s)
    out["card"] = [m.span() for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 13 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    out["phone"] = [m.span() for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(digits(m[0])) <= 15]
    return (*(len(out[k]) for k in ("email", "ip", "card", "phone")), sha(",".join(f"{k}:{a}:{b}" for k in out for a, b in out[k])))


def mix_targets(sizes: dict) -> dict:
    """Source targets by repeated sharing; sizes per source."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target = dict.fromkeys(names, 0.0)
    left = 1.5 * sum(sizes.values())
    for _ in range(100 * len(names)):
        free = [s for s in names if target[s] < 2 * sizes[s] - 1e-9]
        if left < 1e-9 or not free:
            break
        total = sum(weight[s] for s in free)
        share = {s: min(left * weight[s] / total, 2 * sizes[s] - target[s]) for s in free}
        for s in free:
            target[s] += share[s]
        left -= sum(share.values())
    return target


def held_out(doc_id) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 1
