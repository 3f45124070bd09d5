"""Brute-force twins and odd rows for the operator tests."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))


def docs_of(spark, texts, **more):
    rows = [(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def sentence(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}x" for _ in range(n))


def odd_documents(spark):
    """Nulls in every column, empty and long texts, ties and repeated rows, extra columns with names that clash."""
    rng = random.Random(3)
    long = sentence(rng, 30_000, 5000)
    rows = [(1, None, None, None, None), (None, "a text without an id", "en", "s0", 20), (2, "", "en", "s1", 0), (3, " \n\t", "de", None, 3), (4, "word", "en", "s1", 4),
            (5, long, "en", "s0", len(long)), (6, long, None, "s0", len(long)), (7, "same words here", "fr", "s2", 15), (7, "same words here", "fr", "s2", 15),
            (8, "1234 5678 ++ --", "en", "s1", 15), (9, "é ü 漢字 слово", "es", "s2", 12), (None, None, None, None, None)]
    d = spark.createDataFrame(rows, DOCS)
    return d.selectExpr("*", "1 as n", "2 as u", "'x' as id", "3 as k", "cast(null as string) as f", "4 as size", "5 as top", "6 as score", "7 as component_id", "8 as q")


def components(nodes, links):
    parent = {x: x for x in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in nodes}


def near_duplicates(texts: dict[int, str | None], size: int = 2):
    sets = {}
    for i, t in texts.items():
        w = words(t)
        sets[i] = {tuple(w[k:k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    comp = components(sets, links)
    return {i: (len(sets[i]), comp[i], comp[i] == i) for i in sets}


def removed(texts: dict[int, str | None], window: int):
    raw = {i: (t or "").encode() for i, t in texts.items()}
    seen: dict[bytes, int] = {}
    for b in raw.values():
        for k in range(len(b) - window + 1):
            seen[b[k:k + window]] = seen.get(b[k:k + window], 0) + 1
    out = {}
    for i, b in raw.items():
        cover = [False] * len(b)
        for k in range(len(b) - window + 1):
            if seen[b[k:k + window]] > 1:
                cover[k:k + window] = [True] * window
        spans = sum(1 for k in range(len(b)) if cover[k] and (k == 0 or not cover[k - 1]))
        out[i] = (len(b), sum(cover), spans, hashlib.sha256(bytes(x for x, c in zip(b, cover) if not c)).hexdigest())
    return out


EMAIL, IP = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD, PHONE = r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"


def luhn(digits: str) -> bool:
    doubled = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(digits))]
    return sum(x - 9 if x > 9 else x for x in doubled) % 10 == 0


def base_pii(text: str | None) -> list[tuple[int, int, int, str]]:
    """(start, rank, end, kind) of the base kinds, one regular expression each."""
    digits = lambda m: re.sub("[^0-9]", "", m)
    rules = [("email", EMAIL, lambda m: True), ("ip", IP, lambda m: all(int(x) <= 255 for x in m.split("."))),
             ("card", CARD, lambda m: 12 <= len(digits(m)) <= 19 and luhn(digits(m))), ("phone", PHONE, lambda m: 9 <= len(digits(m)) <= 15)]
    return sorted((m.start(), rank, m.end(), kind) for rank, (kind, p, ok) in enumerate(rules) for m in re.finditer(p, text or "") if ok(m.group()))


def damaged(rows, least: int = 7) -> list[str]:
    out = []
    for i, t in rows:
        for w in re.findall("[A-Za-z\u00C0-\u00FF]+", t or ""):
            w = w.translate(LOW)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            out.append(w[:h % len(w)] + w[h % len(w) + 1:] if h % 31 == 0 else w)
    return [w for w in out if len(w) >= least]


def one_edit(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted([a, b], key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def variants(words: list[str], least_count: int = 2, factor: int = 10):
    n = {w: c for w, c in Counter(words).items() if c >= least_count}
    by = {}
    for w in n:
        by.setdefault(len(w), []).append(w)
    near = {w: [] for w in n}
    for size, some in by.items():
        for k, a in enumerate(some):
            for b in some[k + 1:] + by.get(size + 1, []):
                if one_edit(a, b):
                    near[a].append(b)
                    near[b].append(a)
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= factor * n[w] else None
    root = {}
    for w in n:
        r = w
        while form[r] is not None:
            r = form[r]
        root[w] = r
    return {w: (n[w], len(near[w]), form[w], n[form[w]] if form[w] else None, root[w]) for w in n}


def hard_negatives(rows, positives: int = 5, negatives: int = 10):
    """``rows``: (id, label, whole numbers)."""
    out = []
    score = lambda a, b: sum(x * y for x, y in zip(a[2], b[2]))
    for a in rows:
        if a[0] % 100:
            continue
        ranked = sorted(((-score(a, b), b[0], b[1]) for b in rows if b is not a and len(a[2]) == len(b[2])))
        for ps, pid, _ in [x for x in ranked if x[2] == a[1]][:positives]:
            inside = [x for x in ranked if x[2] != a[1] and 30 * -ps <= 100 * -x[0] <= 90 * -ps][:negatives]
            out += [(a[0], pid, k, nid, -ps, -ns) for k, (ns, nid, _) in enumerate(inside, 1)]
    return out
