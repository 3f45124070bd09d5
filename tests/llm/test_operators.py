"""Each operator against brute force or hand-made cases, and on odd rows."""

from __future__ import annotations

import datetime as dt
import os
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from brisa.llm import decontaminate, embeddings, language, mixing, neardup, quality, repeats, tokens, urlfilter, warc
from brisa.llm.graph import components
from tests.llm import helpers as h


def test_components(spark):
    rng = random.Random(1)
    for n, m in ((30, 25), (200, 150), (60, 400)):
        links = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)] + [(1000 + i, 1001 + i) for i in range(40)]
        want = h.components({x for e in links for x in e}, links)
        got = dict(map(tuple, components(spark.createDataFrame(links, "a bigint, b bigint")).collect()))
        alone = {x for x in want if want[x] == x and x not in got}
        assert {**got, **{x: x for x in alone}} == want
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def near_copies(rng, base, n, edits):
    out = []
    for _ in range(n):
        w = base.split(" ")
        for _ in range(rng.randrange(edits)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def test_near_duplicates_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 16)      # groups and lists are split here as hot ones are at scale
    rng = random.Random(5)
    passage = h.sentence(rng, 40, 10**6)
    texts = [h.sentence(rng, rng.randrange(2, 60)) for _ in range(80)]
    texts += near_copies(rng, h.sentence(rng, 90, 10**6), 60, 9) + near_copies(rng, h.sentence(rng, 30, 10**6), 25, 4)
    texts += [passage + " " + h.sentence(rng, rng.randrange(1, 60), 10**6) for _ in range(50)]
    texts += [texts[90]] * 30 + [None, "", " ", "one", "One", "one", "a b", "B a"]
    want = h.near_duplicates(dict(enumerate(texts)))
    got = {r[0]: tuple(r[1:]) for r in neardup.near_duplicates(h.docs_of(spark, texts), words=2).collect()}
    assert got == want
    assert sum(not v[2] for v in want.values()) > 60


def test_near_duplicates_with_a_shared_passage_are_compared_once(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(neardup, "BLOCK", 16)
    hits = neardup.Sets.hits

    def counted(self, i, n=None, *rest):
        rows = len(self.size[:n])
        with open(tmp_path / f"{os.getpid()}", "a") as f:
            f.write(f"{rows}\n")
        return hits(self, i, *([] if n is None else [n]), *rest)

    monkeypatch.setattr(neardup.Sets, "hits", counted)
    rng = random.Random(11)
    passage = h.sentence(rng, 22, 10**6)
    texts = [passage + " " + h.sentence(rng, 18, 10**6) for _ in range(300)]
    texts += [t + " end" for t in texts[:20]] + near_copies(rng, h.sentence(rng, 90, 10**6), 60, 9)
    want = h.near_duplicates(dict(enumerate(texts)))
    got = {r[0]: tuple(r[1:]) for r in neardup.near_duplicates(h.docs_of(spark, texts), words=2).collect()}
    assert got == want
    assert sum(not v[2] for v in want.values()) > 40
    pairs = sum(int(x) for p in tmp_path.iterdir() for x in p.read_text().split())
    assert 0 < pairs < 2 * len(texts) ** 2         # probes that were compared with each other in every block came to over ten times that


def test_sets_are_told_apart_by_bits_without_loss():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 64, 5000, dtype=np.uint64)
    sets = []
    for n in [1, 4, 5, 30, 400, 3000] * 12:
        new = rng.integers(0, 1 << 64, rng.integers(0, n // 4 + 2), dtype=np.uint64)
        sets.append(np.unique(np.concatenate([base[:n][rng.random(n) < 0.97], new, base[:1]])))
    g = neardup.Sets(pa.array([x.view(np.int64) for x in sets], pa.list_(pa.int64())), 80)
    both = [[len(np.intersect1d(x, y)) for y in sets] for x in sets]
    want = np.array([[100 * both[i][j] >= 80 * (len(x) + len(y) - both[i][j]) for j, y in enumerate(sets)] for i, x in enumerate(sets)])
    assert (np.array([g.hits(i) for i in range(len(sets))]) == want).all() and 200 < want.sum() < want.size


@pytest.mark.parametrize("window,split", [(40, 2000), (40, 3)])
def test_repeats_against_brute_force(spark, monkeypatch, window, split):
    monkeypatch.setattr(repeats, "SPLIT", split)   # 3: nearly every anchor is hot
    rng = random.Random(7)
    passage = "".join(rng.choice("abcdé \n") for _ in range(150))
    texts = ["".join(rng.choice("abcdefgé ") for _ in range(rng.randrange(0, 300))) for _ in range(60)]
    texts += [t[:50] + passage[rng.randrange(40):rng.randrange(60, 150)] + t[50:] for t in texts[:40]]
    texts += near_copies(rng, h.sentence(rng, 60), 20, 6) + [texts[70]] * 5 + ["ab" * 100, None, "", "short", "a" * 40, "a" * 39]
    got = {r[0]: tuple(r[1:]) for r in repeats.remove_repeats(h.docs_of(spark, texts), window=window, gram=12).collect()}
    assert got == h.removed(dict(enumerate(texts)), window)


def test_repeat_groups_are_maximal_and_complete():
    rng = random.Random(2)
    for _ in range(60):
        n = rng.randrange(2, 9)
        left = ["".join(rng.choice("ab") for _ in range(rng.randrange(4, 9))).encode() for _ in range(n)]
        right = ["".join(rng.choice("ab") for _ in range(rng.randrange(4, 9))).encode() for _ in range(n)]
        if len(set(zip(left, right))) < n:
            continue
        got = {(a, b, tuple(sorted(m))) for a, b, m in repeats.repeat_groups(left, right, 7)}
        lcp = lambda x, y: next((i for i, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))
        want = set()
        for i in range(n):
            for j in range(i + 1, n):
                a, b = lcp(left[i], left[j]), lcp(right[i], right[j])
                if a + b >= 7:
                    want.add((a, b, tuple(k for k in range(n) if left[k][:a] == left[i][:a] and right[k][:b] == right[i][:b] and len(left[k]) >= a and len(right[k]) >= b)))
        assert want <= got and all(sum(1 for _ in m) > 1 for _, _, m in got)


def test_repeat_occurrences_name_all_places(spark):
    rng = random.Random(9)
    p = "".join(rng.choice("abcdefgh ") for _ in range(300))
    texts = ["xx" + p, p + "yy", "q" + p + "z", "".join(rng.choice("abcdefgh ") for _ in range(500))]
    found = repeats.Repeats(h.docs_of(spark, texts))
    keys = {r[0]: r[1] for r in h.docs_of(spark, texts).select(F.xxhash64("doc_id", "text"), "doc_id").collect()}
    cover = {i: set() for i in range(4)}
    for r in found.occurrences().collect():
        cover[keys[r["u"]]] |= set(range(r["start"], r["start"] + r["length"]))
    assert cover == {0: set(range(2, 302)), 1: set(range(300)), 2: set(range(1, 301)), 3: set()}


def test_without_repeats_keeps_whole_characters(spark):
    p = "é" * 150
    out = {r[0]: r[1] for r in repeats.without_repeats(h.docs_of(spark, ["a" + p + "ü", "ñ" + p, None, "kept"])).select("doc_id", "text").collect()}
    assert out[2] is None and out[3] == "kept" and out[0] in ("aü", "a") and out[1] == "ñ"


def test_language_spans(spark):
    rng = random.Random(4)
    sound = {"en": "the of and ing tion", "de": "der und sch ich ung", "ru": "сло вод про ние ост"}
    make = lambda lang, n: " ".join("".join(rng.choices(sound[lang].split(), k=2)) for _ in range(n))
    train = spark.createDataFrame([(i, make(lang, 60), lang, "s", 0) for i, lang in enumerate(["en", "de", "ru"] * 20)], h.DOCS)
    model = language.fit(train, F.lit(True))
    assert model.langs == ["de", "en", "ru"]
    assert not model.allowed[language.SCRIPTS.index("Cyrillic"), :2].any()
    mixed = make("en", 30) + " " + make("de", 40) + " " + make("ru", 12)
    texts = [make("en", 25), make("de", 3), mixed, None, "", "12 ++", make("ru", 5), "漢字"]
    got = {r["doc_id"]: r for r in language.spans(h.docs_of(spark, texts), model).collect()}
    assert [got[i]["lang_pred"] for i in range(8)][:7] == ["en", "de", got[2]["lang_pred"], "und", "und", "und", "ru"]
    assert [s["lang"] for s in got[2]["spans"]] == ["en", "de", "ru"]
    assert mixed.encode()[got[2]["spans"][1]["start"]:].decode().startswith(mixed.split(" ")[30])
    assert got[7]["lang_pred"] in model.langs and all(0 <= r["score"] <= 1 for r in got.values())


def test_viterbi_against_all_paths():
    import itertools
    rng = np.random.default_rng(3)
    row = np.array([0] * 5 + [1] + [2] * 4)
    score = rng.normal(size=(10, 3))
    path = language.viterbi(score, row, 0.8)
    for r in range(3):
        at = np.flatnonzero(row == r)
        value = lambda p: sum(score[at[i], s] for i, s in enumerate(p)) - 0.8 * sum(a != b for a, b in zip(p, p[1:]))
        assert value(path[at]) == pytest.approx(max(map(value, itertools.product(range(3), repeat=len(at)))))


def test_decontamination_against_brute_force(spark):
    rng = random.Random(6)
    items = [h.sentence(rng, n, 60) for n in (1, 3, 13, 14, 40, 40)] + [None, "", "..."]
    texts = [h.sentence(rng, rng.randrange(0, 80), 60) for _ in range(60)] + [h.sentence(rng, 10, 60) + ". " + items[4] + "! " + h.sentence(rng, 9, 60), items[3].upper(), items[4][:60], None]
    cut = lambda t: [w for w in __import__("re").split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(h.LOW)) if w]
    want = {}
    for i, t in enumerate(texts):
        w, hit, ids = cut(t), set(), set()
        for q, item in enumerate(items):
            b = cut(item)
            n = min(len(b), 13)
            for k in range(len(b) - n + 1 if b else 0):
                for p in range(len(w) - n + 1):
                    if w[p:p + n] == b[k:k + n]:
                        hit |= set(range(p, p + n))
                        ids.add(str(q))
        import hashlib
        want[i] = (len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w))
    bench = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    got = {r[0]: tuple(r[1:]) for r in decontaminate.contamination(h.docs_of(spark, texts), bench).collect()}
    assert got == want


def test_proximity(spark):
    docs = h.docs_of(spark, ["zero alpha filler beta end", "alpha beta", "beta x x x x x x alpha", "nothing"])
    wins = decontaminate.windows(spark.createDataFrame([(1, "alpha beta")], "item_id bigint, text string"))
    terms = wins.select(F.explode("iw").alias("term")).distinct()
    wins = decontaminate.rarest_terms(wins, decontaminate.term_counts(docs, terms))
    index = decontaminate.postings(docs, terms, F.col("doc_id"))
    assert {r["u"] for r in decontaminate.proximity(index, wins, 0).collect()} == {1}
    assert {r["u"] for r in decontaminate.proximity(index, wins, 2).collect()} == {0, 1}
    assert {r["u"] for r in decontaminate.proximity(index, wins, 9).collect()} == {0, 1, 2}


def test_targets_and_mix(spark):
    rng = random.Random(8)
    rows = [(i, h.sentence(rng, rng.randrange(1, 50)), None, rng.choice(["a", "b", "b", "b", "c", "d", None]), 0) for i in range(3000)]
    docs = spark.createDataFrame(rows, h.DOCS)
    size = docs.select("doc_id", "source", mixing.word_count("text").alias("size"))
    plan = mixing.targets(size, [3, 1, 2], 1.5, 2.0)
    t = {r["source"]: (r["source_size"], r["target"]) for r in plan.collect()}
    weight, free, left = dict(zip(["a", "b", "c", "d", None], [3, 1, 2, 3, 1])), set(t), 1.5 * sum(v[0] for v in t.values())
    want = {}
    while free:       # deal, fix what is over its cap, deal the rest again
        total = sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / total > 2 * t[s][0]}
        if not over:
            want |= {s: left * weight[s] / total for s in free}
            break
        want |= {s: 2.0 * t[s][0] for s in over}
        left -= sum(2.0 * t[s][0] for s in over)
        free -= over
    assert {s: v[1] for s, v in t.items()} == pytest.approx(want)
    c = mixing.sample_copies(size, plan).collect()
    assert sorted(map(tuple, c), key=str) == sorted(map(tuple, mixing.sample_copies(size, plan).collect()), key=str)
    assert max(r["copies"] for r in c) <= 2 and len(c) == 3000
    for s, (_, target) in t.items():
        assert sum(r["copies"] * r["size"] for r in c if r["source"] == s) == pytest.approx(target, rel=0.03, abs=100)
    mixed = mixing.mix_documents(docs)
    assert mixed.count() == sum(r["copies"] for r in c)


def test_token_counts_are_the_library_s(spark):
    P = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    rng = random.Random(1)
    odd = ["it's I'LL  done\t\n don't", "<|endoftext|> a<|startoftext|>b", "é ́x  y z\x1cq\x85r", "", None, "漢字かな 1234 ++--", "a" * 3000]
    long = [h.sentence(rng, 9000, 10**6), "x" * 70_000, ("ab " * 30_000), " " * 50_000, "word\n" * 20_000 + "end"]
    texts = odd + long
    got = {r["doc_id"]: r for r in tokens.count_tokens(h.docs_of(spark, texts), P.path("word_bpe_49k.json")).collect()}
    for i, x in enumerate(texts):
        n = len(t.encode(x or "", add_special_tokens=False).ids)
        assert (got[i]["n_tokens"], got[i]["n_bytes"], got[i]["over_limit"]) == (n, len((x or "").encode()), n > 2048)
    for chunk, overlap in ((60, 8), (200, 40)):
        encode = lambda s: t.encode(s, add_special_tokens=False).offsets
        assert tokens.splice(long[0][:5000], encode, chunk, overlap) == len(encode(long[0][:5000]))


def test_warc_round_trip(spark, tmp_path):
    big = "<p>" + "é" * 800
    rows = [(1, "http://a/\n%0Ax", big), (5, "http://b/", big), (3, None, big), (4, "u", "small"), (6, "v", "small"), (7, "w", None), (None, "x", big), (5, "http://b/", big), (8, "y", "\r\n\r\n" * 500)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    folder = f"file://{tmp_path}/w"
    index = warc.write(warc.revisits(pages), folder, file_bytes=2000)
    got = {(r["page_id"], r["url"]): r for r in warc.read(index, folder, gap=100, most=700).collect()}
    assert {k for k in got} == {(i, u) for i, u, _ in rows}
    for i, u, x in rows:
        r = got[i, u]
        revisit = x == big and i != 5
        assert r["record_type"] == ("revisit" if revisit else "response") and r["refers_to"] == (5 if revisit else None)
        assert r["payload_bytes"] == len((x or "").encode()) and (r["payload"] is None if revisit else bytes(r["payload"]).decode() == (x or ""))
    one = warc.read(index.where("page_id = 4"), folder).collect()
    assert len(one) == 1 and bytes(one[0]["payload"]) == b"small"
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_embeddings_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK", 8)
    rng = np.random.default_rng(2)
    base = rng.normal(size=(12, 16))
    vecs = [base[i % 12] + rng.normal(size=16) * 0.09 * (i % 7) for i in range(240)] + [base[0]] * 20 + [base[0] * 3]
    rows = [(i, [float(np.float32(x)) for x in v], int(i % 12 // 6)) for i, v in enumerate(vecs)]
    odd = [(900, None, 0), (901, [0.0] * 16, 0), (902, [None] + [1.0] * 15, 0), (903, [float("nan")] * 16, 0), (904, [float("inf")] + [0.0] * 15, 0), (905, rows[0][1], None), (906, [1.0], 0), (907, [2.0], 0), (908, [], 0)]
    df = spark.createDataFrame(rows + odd, "vec_id bigint, embedding array<float>, label int")
    got = {r[0]: tuple(r[1:]) for r in embeddings.near_duplicate_vectors(df, tables=40).collect()}
    x = {i: np.array(v, np.float64) / np.linalg.norm(v) for i, v, _ in rows}
    label = {i: c for i, _, c in rows}
    links = [(a, b) for a in x for b in x if a < b and label[a] == label[b] and x[a] @ x[b] >= 0.93] + [(906, 907)]
    comp = h.components([*x, *[r[0] for r in odd]], links)
    count = {i: sum(i in e for e in links) for i in comp}
    assert got == {i: (count[i], comp[i], comp[i] == i) for i in comp}


def test_urls(spark):
    day = lambda n: dt.date(2024, 1, n)
    entries = spark.createDataFrame([("host", "a.example.com", "block", day(5), 1), ("host", "a.example.com", "remove", day(9), 2), ("host", "a.example.com", "allow", day(9), 3),
                                     ("domain", "example.com", "block", day(1), 4), ("prefix", "b.example.com/x", "allow", day(3), 5), ("domain", "example.com", "remove", day(20), 6),
                                     ("host", None, "block", day(1), 7), ("host", "c.org", "block", None, 8)], "kind string, value string, action string, day date, entry_id int")
    caps = [(1, "http://A.example.com/p", day(6)), (2, "http://a.example.com", day(9)), (3, "https://u@b.example.com:80/x/y?z", day(4)), (4, "https://b.example.com/y", day(4)), (5, "http://b.example.com/x", day(2)),
            (6, "http://a.example.com/", day(25)), (7, "http://b.example.com/y", day(25)), (8, None, day(4)), (9, "nonsense", day(4)), (10, "http://c.org/", None), (1, "http://A.example.com/p", day(6))]
    got = urlfilter.evaluate(spark.createDataFrame(caps, "page_id bigint, url string, day date"), entries, bucket_days=4)
    assert sorted((r["page_id"], r["verdict"], r["kind"]) for r in got.collect()) == [(1, "block", "host"), (1, "block", "host"), (2, "allow", "host"), (3, "allow", "prefix"), (4, "block", "domain"),
                                                                                    (5, "block", "domain"), (6, "allow", "host"), (7, "none", None), (8, "none", None), (9, "none", None), (10, "none", None)]
    assert urlfilter.evaluate(spark.createDataFrame(caps, "page_id bigint, url string, day date").limit(0), entries).count() == 0


def test_quality_ranks_held_out_rows(spark):
    rng = random.Random(3)
    good = lambda: ". ".join(h.sentence(rng, 12).capitalize() for _ in range(6)) + "."
    junk = lambda: rng.choice([lambda: " ".join([f"w{rng.randrange(9)}x,"] * 40), lambda: " | ".join(h.sentence(rng, 1) for _ in range(60)), lambda: "%%% ### " * 30])()
    label = [int(rng.random() < 0.7) for _ in range(600)]
    texts = [good() if q else junk() for q in label] + [None, ""]
    docs = h.docs_of(spark, texts)
    labels = spark.createDataFrame([(i, q, 0) for i, q in enumerate(label) if i % 2] + [(None, 1, 0), (1, None, 0), (3, label[3], 0)], "doc_id bigint, quality int, toxic int")
    got = {r["doc_id"]: r for r in quality.classify(docs, labels, F.col("doc_id") % 3 != 1).collect()}
    assert len(got) == 602 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got.values())
    held = [i for i in range(600) if i % 3 == 1]
    assert sum(got[i]["predicted"] == label[i] for i in held) > 0.9 * len(held)
    assert min(np.mean([got[i]["score"] for i in held if label[i]]), 1) > np.mean([got[i]["score"] for i in held if not label[i]]) + 0.3


def test_a_row_measures_the_same_alone_and_in_any_batch():
    rng = random.Random(4)
    texts = ["a b\nc\nd", "x\ny\n", "\nx.\ny", "x.\n\n", "\n", "\n\n", "", "x.", "a.\n\na.\nb", " \n.", "é\r\né\r\n"]
    texts += ["".join(rng.choice("ab. \n") for _ in range(rng.randrange(12))) for _ in range(60)]

    def measure(some):
        raw = [t.encode() for t in some]
        return quality.measure(np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64))

    alone = np.concatenate([measure([t]) for t in texts])
    for _ in range(5):
        order = rng.sample(range(len(texts)), len(texts))
        assert np.array_equal(measure([texts[i] for i in order]), alone[order])
    n, distinct, bare = (quality.FEATURES.index(f) for f in ("lines", "distinct_lines", "lines_without_stop"))
    for t, x in zip(texts, alone):
        lines = (t[:-1] if t.endswith("\n") else t).split("\n") if t else []
        want = [np.log1p(len(lines)), len(set(lines)) / max(len(lines), 1), sum(not v.endswith(".") for v in lines) / max(len(lines), 1)]
        assert x[[n, distinct, bare]] == pytest.approx(want, rel=1e-6)
    assert measure([]).shape == (0, len(quality.FEATURES))


def test_risk_stays_non_negative():
    rng = np.random.default_rng(1)
    z = np.eye(6)[rng.integers(0, 6, 500)]
    p = z[z[:, :3].any(1)]
    mean, second = {0: z.mean(0), 1: p.mean(0)}, {0: z.T @ z / len(z), 1: p.T @ p / len(p)}
    for prior in (0.5, 0.9):
        w = quality.fit_moments(mean, second, prior)
        assert np.isfinite(w).all() and w[:3].min() > w[3:].max()


ODD = {
    "near": lambda d, s: neardup.near_duplicates(d),
    "repeats": lambda d, s: repeats.remove_repeats(d),
    "cut": lambda d, s: repeats.without_repeats(d),
    "language": lambda d, s: language.spans(d, language.fit(d, F.lit(True))),
    "decontaminate": lambda d, s: decontaminate.contamination(d, s.createDataFrame([(None, "same words here"), (1, None), (2, "word")], "item_id bigint, text string")),
    "copies": lambda d, s: mixing.sample_copies(d.select("doc_id", "source", mixing.word_count("text").alias("size")), mixing.targets(d.select("source", mixing.word_count("text").alias("size")), [3, 1, 2], 1.5, 2.0)),
    "mix": lambda d, s: mixing.mix_documents(d).dropDuplicates(),
    "quality": lambda d, s: quality.classify(d, s.createDataFrame([(5, 1, 0), (8, 0, 0)], "doc_id bigint, quality int, toxic int"), F.lit(True)),
}


@pytest.mark.parametrize("name", ODD)
def test_odd_rows_and_empty_tables(spark, name):
    d = h.odd_documents(spark)
    got = ODD[name](d, spark).collect()
    if name != "mix":
        assert len(got) == d.count()
    assert ODD[name](d.limit(0), spark).count() == 0


ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.mark.parametrize("of_texts", [repeats.without_repeats, repeats.remove_repeats, lambda d: neardup.near_duplicates(d),
                                      lambda d: language.keep_known(d, language.fit(d, F.lit(True)))], ids=["without", "removed", "near", "language"])
def test_batches_of_texts_are_bounded_by_bytes(spark, of_texts):
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], ["n", "size"])

    long = spark.range(0, 4000, 1, 1).select("id", F.expr("repeat(cast(id as string), 8000 div length(cast(id as string)))").alias("text"))
    had = spark.conf.get(ARROW_BYTES, None)
    try:
        spark.conf.unset(ARROW_BYTES)
        of_texts(h.docs_of(spark, ["one text", "another"]))
        got = long.mapInArrow(sizes, "n bigint, size bigint").collect()
        assert sum(r.n for r in got) == 4000 and max(r["size"] for r in got) < 6 << 20
        spark.conf.set(ARROW_BYTES, "1048576")                    # a session's own bound stays
        of_texts(h.docs_of(spark, ["one text", "another"]))
        assert spark.conf.get(ARROW_BYTES) == "1048576"
    finally:
        spark.conf.unset(ARROW_BYTES) if had is None else spark.conf.set(ARROW_BYTES, had)
