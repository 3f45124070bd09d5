"""Personal data, spelling variants and hard negatives against brute force on small and odd tables."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from brisa.llm import negatives, pii, spelling
from tests.llm import helpers as h

PII_TEXTS = [None, "", "no data", "a@b.co", "a@b-c.d_e@f.gh x@y", "..a@b.c.d.. mail c%d+e@x-1.y-2.z", "é漢😀 a.b@c.de 😀 +49 (30) 1234-5678", "1.2.3.4.5.6.7.8 999.1.1.1 0001.002.3.255 1.2.3",
             "4111 1111 1111 1111 and 4111-1111-1111-1112", "4111 1111 1111 1111 4111111111111111", "+1 (743) 555-3824 +1 ((((( +12345678901234567890 +1-2", "5 5  5- 5",
             "a@a@a.b@c.d", "x" * 2_000 + "@y.zz", "7" * 2_000 + " 1.1.1.1", ".1" * 3_000, "+1" + "(" * 2_000, "a@b" + ".c" * 3_000, "@".join("ab" * 2_000)]


def spans_of(spark, texts):
    d = pii.find_pii(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string"))
    return {r["doc_id"]: [(s["start"], s["rank"], s["stop"], s["kind"]) for s in r["pii"]] for r in d.collect()}


def test_base_kinds_against_plain_patterns(spark):
    rng = random.Random(5)
    texts = PII_TEXTS + ["".join(rng.choice(["1", "22", "255", "4111111111111111", ".", "@", "a", "b.c", "-", " ", "+", "(", ")", "é", "😀", "\n"]) for _ in range(rng.randrange(60))) for _ in range(400)]
    got = spans_of(spark, texts)
    for i, t in enumerate(texts):
        assert [s for s in got[i] if s[1] < 4] == h.base_pii(t), t


def test_added_kinds_need_their_checksum_and_context(spark):
    texts = ["account DE89 3704 0044 0532 0130 00 AND MORE", "account DE89 3704 0044 0532 0130 01", "xDE89370400440532013000", "GB82WEST12345698765432.", "ssn 123-45-6789", "part 123-45-6789",
             "ssn 000-45-6789", "call (555) 123-4567 now", "order (555) 123-4567", "phone +1 (555) 123-4567", "phone order 555-123-4567"]
    got = {i: [(s[3], s[0], s[2]) for s in v if s[1] > 3] for i, v in spans_of(spark, texts).items()}
    assert got == {0: [("iban", 8, 35 - 0)], 1: [], 2: [], 3: [("iban", 0, 22)], 4: [("ssn", 4, 15)], 5: [], 6: [], 7: [("local_phone", 5, 19)], 8: [], 9: [], 10: []}


def test_scores_and_masks(spark):
    d = pii.find_pii(spark.createDataFrame([(1, "visa 4111 1111 1111 1111, order a@b.co"), (2, None), (3, "😀 a@b.co 1.2.3.4")], "doc_id int, text string"))
    rows = {r["doc_id"]: r for r in pii.masked(d).collect()}
    assert rows[1]["text"] == "visa [card], order [email]" and rows[2]["text"] is None and rows[3]["text"] == "😀 [email] [ip]"
    assert [s["score"] for s in rows[1]["pii"]] == [0.8, 0.6]  # card and order stand near the first, order near the second


def test_many_spans_in_one_text(spark):
    text = " ".join(f"u{k}@host{k}.org" for k in range(3000))
    assert spans_of(spark, [text])[0] == h.base_pii(text)


def test_very_long_runs(spark):
    got = spans_of(spark, ["x" * 1_000_000 + "@y.zz", "7" * 1_000_000, "+1" + "(" * 1_000_000, "a@b" + ".c" * 500_000, "A" * 1_000_000])
    assert [[(s[0], s[2], s[3]) for s in got[i]] for i in range(5)] == [[(0, 1_000_005, "email")], [], [], [(0, 1_000_003, "email")], []]


def test_personal_data_on_odd_rows(spark):
    docs = h.odd_documents(spark).withColumn("pii", F.lit(1)).withColumn("start", F.lit("x"))
    out = pii.find_pii(docs)
    assert set(out.columns) == set(docs.columns) and out.count() == docs.count()
    assert pii.find_pii(docs.limit(0)).count() == 0


def as_words(spark, words):
    return spark.createDataFrame([(w, 1) for w in words], "word string, n int")


def variants_of(spark, words, **more):
    return {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in spelling.group_variants(as_words(spark, words), **more).collect()}


@pytest.mark.parametrize("block", [3, 512])
def test_variants_against_brute_force(spark, block):
    rng = random.Random(11)
    base = ["".join(rng.choice("abé") for _ in range(rng.randrange(7, 12))) for _ in range(150)]
    words = []
    for w in base:
        words += [w] * rng.choice([1, 2, 30, 400])
        k = rng.randrange(len(w))
        for v in (w[:k] + w[k + 1:], w[:k] + "z" + w[k:], w[:k] + "q" + w[k + 1:]):
            words += [v] * rng.choice([1, 2, 3])
    # one half in common for many words
    words += [w for k in range(300) for w in ["commonhalf" + str(k)] * 2]
    words = [w for w in words if len(w) >= 7]
    assert variants_of(spark, words, block=block) == h.variants(words)


def test_variants_follow_forms_to_the_last(spark):
    chain = ["aaaaaaab", "aaaaaabb", "aaaaabbb", "aaaabbbb", "aaabbbbb"]
    words = [w for k, w in enumerate(chain) for _ in range(2 * 10 ** k)]
    counts = spark.createDataFrame([(w, 2 * 10 ** k) for k, w in enumerate(chain)], "word string, times int")
    occurrences = counts.select("word", F.explode(F.sequence(F.lit(1), "times")))
    got = {r["word"]: r["root"] for r in spelling.group_variants(occurrences).collect()}
    assert got == {w: chain[-1] for w in chain} and len(words) > 10_000


def test_variants_on_odd_words(spark):
    long = "x" * 40_000
    words = [None, "", "short", "漢字漢字漢字漢字", "漢字漢字漢字漢", long, long, long + "y", long + "y", "漢字漢字漢字漢字", "漢字漢字漢字漢"] + ["漢字漢字漢字漢"] * 18
    got = variants_of(spark, words)
    assert got == {"漢字漢字漢字漢字": (2, 1, "漢字漢字漢字漢", 20, "漢字漢字漢字漢"), "漢字漢字漢字漢": (20, 1, None, None, "漢字漢字漢字漢"), long: (2, 1, None, None, long), long + "y": (2, 1, None, None, long + "y")}
    assert variants_of(spark, []) == {} and variants_of(spark, ["lonelyword"] * 2) == {"lonelyword": (2, 0, None, None, "lonelyword")}


def test_damaged_words(spark):
    docs = h.odd_documents(spark)
    rng = random.Random(2)
    more = h.docs_of(spark, [" ".join(rng.choice(["Übergröße", "ABCDEFGHÄ", "seventh", "naïvetés", "a×b÷cdef"]) for _ in range(200)) for _ in range(20)])
    d = docs.select("doc_id", "text").unionByName(more.select("doc_id", "text"))
    got = sorted(r["word"] for r in spelling.damaged_words(d).collect() if len(r["word"]) >= 7)
    assert got == sorted(h.damaged([tuple(r) for r in d.collect()]))
    assert spelling.group_variants(spelling.damaged_words(docs)).count() >= 0


def test_exact_products():
    rng = np.random.default_rng(1)
    for size, top in ((3, 5), (64, 300), (200, 10_000), (130, 2 ** 23), (0, 1)):
        a, b = (rng.integers(-top, top + 1, (n, size)).astype(np.float64) for n in (7, 9))
        assert (negatives.exact_products(a, b) == a.astype(np.int64) @ b.astype(np.int64).T).all()


def mined(spark, rows, **more):
    d = spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<double>").withColumn("row", F.lit(1)).withColumn("id", F.lit("x"))
    return sorted(tuple(r) for r in negatives.hard_negatives(d, **more).collect())


@pytest.mark.parametrize("blocks", [(2, 5), (2048, 4096)])
def test_negatives_against_brute_force(spark, blocks):
    rng = random.Random(4)
    # few values, so that scores tie
    rows = [(i, rng.choice([0, 0, 0, 1, 2]), [rng.choice([0.0, 0.25, 0.5, 1.0]) for _ in range(6)]) for i in range(0, 900, 5)]
    want = h.hard_negatives([(i, c, [int(256 * x) for x in v]) for i, c, v in rows])
    assert len(want) > 50 and mined(spark, rows, anchor_block=blocks[0], candidate_block=blocks[1]) == sorted(want)


def test_negatives_on_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(0, 1, [1.0, 1.0]), (5, 1, [1.0, 0.5]), (6, 2, [0.5, 0.25]), (7, 2, [0.5, 0.25]), (8, None, [1.0, 1.0]), (9, 2, None), (10, 2, [nan, 1.0]), (11, 2, [inf, 1.0]), (12, 2, [None, 1.0]),
            (13, 2, [1.0]), (14, 2, []), (None, 2, [0.5, 0.25]), (15, 3, [1e300, 1.0]), (100, 4, [1.0, 1.0]), (200, 5, [])]
    want = h.hard_negatives([(i, c, [int(256 * x) for x in v]) for i, c, v in [*good[:4], good[9], good[10], good[13], good[14]]])
    assert mined(spark, good) == sorted(want) and len(want) > 1
    assert mined(spark, good + good[:4]) == sorted(want)
    assert mined(spark, []) == []
    assert mined(spark, [(0, 1, [-1.0, 0.0]), (1, 1, [1.0, 0.0]), (2, 2, [1.0, 0.0])]) == []


def test_risk_against_direct_minimisation():
    from brisa.llm import quality

    rng = np.random.default_rng(5)
    z = np.concatenate([np.ones((400, 1)), np.eye(5)[rng.integers(0, 5, 400)]], 1)
    pos = z[(z[:, 1:3].any(1)) & (rng.random(400) < 0.6)]
    mean, second = {0: z.mean(0), 1: pos.mean(0)}, {0: z.T @ z / len(z), 1: pos.T @ pos / len(pos)}
    prior, ridge = 0.4, 1e-3

    def risk(w):
        f_u, f_p = z @ w, pos @ w
        rest = ((1 + f_u) ** 2).mean() / 4 - prior * ((1 + f_p) ** 2).mean() / 4
        return prior * ((1 - f_p) ** 2).mean() / 4 + max(rest, 0) + ridge * (w ** 2).sum() / 4

    w = quality.fit_moments(mean, second, prior, ridge)
    best = risk(w)
    for _ in range(300):
        assert risk(w + rng.standard_normal(6) * rng.choice([1e-3, 1e-2, 0.1, 1])) >= best - 1e-6


def test_occurrences_keep_their_gram(spark):
    from brisa.llm import repeats

    rng = random.Random(8)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(400))
    texts = ["".join(rng.choice("xyz") for _ in range(50)) + passage + "".join(rng.choice("uvw") for _ in range(50)) for _ in range(3)]
    docs = h.docs_of(spark, texts)
    for gram in (48, 100):
        found = repeats.Repeats(docs, gram=gram).occurrences().collect()
        cover = {}
        for r in found:
            cover.setdefault(r["u"], set()).update(range(r["start"], r["start"] + r["length"]))
        # neighbours of the passage may be equal by chance
        assert len(cover) == 3 and all(set(range(50, 450)) <= c and len(c) < 410 for c in cover.values())


def test_a_capture_far_in_the_future_costs_no_rows(spark):
    import datetime as dt

    from brisa.llm import urlfilter

    day = dt.date
    entries = spark.createDataFrame([("host", "a.org", day(2024, 1, 5), "block", 1), ("host", "a.org", day(2024, 3, 1), "remove", 2), ("domain", "a.org", day(2024, 2, 1), "allow", 3)],
                                    "kind string, value string, day date, action string, entry_id int")
    caps = [(1, "http://a.org/x", day(2024, 1, 4)), (2, "http://a.org/x", day(2024, 1, 5)), (3, "http://a.org/x", day(9999, 1, 1)), (4, "http://a.org/x", day(2024, 2, 29)), (5, "http://b.net", day(2024, 2, 2)),
            (6, None, day(2024, 2, 2)), (7, "http://a.org/x", None)]
    d = spark.createDataFrame(caps, "page_id int, url string, day date").selectExpr("*", "1 as cell", "'x' as entry", "2 as own", "'k' as kind")
    for days in (1, 32):
        got = {r["page_id"]: (r["verdict"], r["kind"]) for r in urlfilter.evaluate(d, entries, bucket_days=days).collect()}
        assert got == {1: ("none", None), 2: ("block", "host"), 3: ("allow", "domain"), 4: ("block", "host"), 5: ("none", None), 6: ("none", None), 7: ("none", None)}


def test_other_operators_on_clashing_names_and_empty_tables(spark):
    import public_tokenizers

    from brisa.llm import embeddings, tokens, warc

    docs = h.odd_documents(spark).selectExpr("*", "1 as n_tokens", "2 as n_bytes", "3 as over_limit")
    path = public_tokenizers.path("word_bpe_49k.json")
    assert tokens.count_tokens(docs, path).count() == docs.count() and tokens.count_tokens(docs.limit(0), path).count() == 0
    vecs = spark.createDataFrame([(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, None, 1), (3, [0.0, 0.0], 2), (None, [1.0, 0.0], 1), (4, [float("nan"), 1.0], None)], "vec_id bigint, embedding array<double>, label int")
    vecs = vecs.selectExpr("*", "'a' as id", "1 as n", "2 as v", "3 as keys", "4 as tab")
    assert embeddings.near_duplicate_vectors(vecs).count() == 6 and embeddings.near_duplicate_vectors(vecs.limit(0)).count() == 0
    pages = spark.createDataFrame([(1, "http://a.b", "x" * 2000), (2, None, "x" * 2000), (3, "u", None), (None, "u", ""), (5, "u", "é" * 600)], "page_id bigint, url string, html string").selectExpr("*", "1 as payload_digest", "'x' as offset", "2 as length")
    assert warc.round_trip(pages).count() == 5 and warc.round_trip(pages.limit(0)).count() == 0
