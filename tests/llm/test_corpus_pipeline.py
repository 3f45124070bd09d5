"""Stages of the corpus pipeline on planted rows and in sequence."""

from __future__ import annotations

import random

import corpus_pipeline
from tests.llm import helpers as h


def near_by(texts: dict[int, str | None], n: int) -> set[int]:
    """Ids that stay if documents are linked by shingles of ``n`` words at 0.8 and the smallest id of each group is kept."""
    sets = {}
    for i, t in texts.items():
        w = h.words(t)
        sets[i] = set(zip(*(w[k:] for k in range(n)))) if len(w) >= n else {tuple(w)} if w else set()
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    comp = h.components(sets, links)
    return {i for i in sets if comp[i] == i}


def test_near_stage_takes_five_words(spark, sf):
    rng = random.Random(1)
    base = [f"b{i}" for i in range(100)]
    five = [f"e{i}" if i % 20 == 10 else w for i, w in enumerate(base)]     # about 0.82 by two words, 0.59 by five
    one = ["x" if i == 50 else w for i, w in enumerate(base)]
    texts = [" ".join(w) for w in (base, five, one)] + [h.sentence(rng, 40, 10**6), "", None, "a b c", "a b c"]
    docs = h.docs_of(spark, texts)
    kept = {r["doc_id"] for r in corpus_pipeline.near_duplicate_stage(spark, docs, sf).collect()}
    assert kept == near_by(dict(enumerate(texts)), 5) == {0, 1, 3, 4, 5, 6}


def test_near_stage_on_the_given_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = {r["doc_id"] for r in corpus_pipeline.near_duplicate_stage(spark, docs, sf).collect()}
    assert kept == near_by({r["doc_id"]: r["text"] for r in docs.collect()}, 5)


def test_stored_twice_stays_once(spark, sf):
    rng = random.Random(2)
    twice, unnamed, near, other, alone, same = (h.sentence(rng, 90, 10**6) for _ in range(6))
    rows = [(1, twice, "en", "s0"), (1, twice, "en", "s0"), (1, twice, "en", "s1"), (None, unnamed, "en", "s0"), (None, unnamed, "en", "s0"), (None, unnamed, None, "s0"), (None, unnamed, "s0", None),
            (5, near, "en", "s0"), (6, other, "en", "s0"), (6, near + " end", "en", "s0"), (None, near + " more", "en", "s0"), (None, alone, "en", "s0"), (8, same, "en", "s0"), (3, same, "en", "s0")]
    bare = [(9, None, "en", "s0"), (9, None, "en", "s0"), (None, " ", "en", "s0")]
    docs = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows + bare], h.DOCS)
    docs = docs.repartition(3)
    near_out = corpus_pipeline.near_duplicate_stage(spark, docs, sf)
    assert near_out.columns == docs.columns
    want = [(1, twice), (None, unnamed), (5, near), (6, other), (None, alone), (3, same), *[r[:2] for r in bare]]
    order = lambda got: sorted(((r[0], r[1]) for r in got), key=str)
    assert order(near_out.collect()) == order(want)
    path = spark.conf.get("spark.checkpoint.dir") + "/stored-twice"
    near_out.write.parquet(path)
    assert order(corpus_pipeline.repeats_stage(spark, spark.read.parquet(path), sf).collect()) == order(want)
    assert corpus_pipeline.near_duplicate_stage(spark, docs.limit(0), sf).count() == 0


def odd(spark):
    """Odd rows whose extra columns have the names that stages use inside."""
    d = h.odd_documents(spark)
    return d.selectExpr("*", "11 as _row", "12 as row", "13 as was_empty", "'c' as copies", "14 as nth", "15 as n_source", "16 as copy", "17 as place", "18 as text_", "19 as _copies")


def test_stages_on_odd_rows_in_sequence(spark, sf):
    docs = odd(spark).repartition(3)
    plain = [c for c in docs.columns if c not in ("doc_id", "text", "lang", "source", "n_chars")]
    marks = docs.select(*plain).distinct().collect()
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), sf).count() == 0
        out = stage(spark, docs, sf)
        path = f"{spark.conf.get('spark.checkpoint.dir')}/odd-{name}"
        if name == "mixing":
            assert out.columns == [c for c in docs.columns if c != "copy"] + ["copy"]
        else:
            assert out.columns == docs.columns and {tuple(r) for r in out.select(*plain).distinct().collect()} <= {tuple(r) for r in marks}
        out.write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        assert docs.count() <= 2 * before.count()
    assert docs.count() > 0


def test_language_stage_keeps_mixed_texts_and_rejects_noise(spark, sf):
    rng = random.Random(4)
    given = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    some = {r["lang"]: " ".join(r["text"].split()[:60]) for r in given.where("n_chars > 600").collect()}
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = [(10 ** 9 + i, t, None, "s", 1) for i, t in enumerate([" ".join(some.values()), "\n".join(some.values()), " ".join("".join(rng.choice(letters) for _ in range(7)) for _ in range(40)),
                                                                  "Toto je krásný český text o zvířatech a lidech, kteří žijí v lese", None, "", "12 345", "漢字かな混じり文"])]
    docs = given.unionByName(spark.createDataFrame(rows, given.schema))
    kept = {r["doc_id"] for r in corpus_pipeline.language_stage(spark, docs, sf).collect()}
    assert {i for i in kept if i >= 10 ** 9} == {10 ** 9, 10 ** 9 + 1}
    assert len(kept) - 2 >= 0.98 * given.count()


def test_mix_gives_out_the_words_that_were_taken(spark):
    from brisa.llm import mixing
    rng = random.Random(6)
    rows = [(i, " ".join(["w"] * n), "en", rng.choice(["a", "b", None]), 0) for i in range(60) for n in (10, 1000)] + [(None, " ".join(["v"] * n), None, "a", 0) for n in (5, 5, 300, 301)]
    docs = spark.createDataFrame(rows + rows[:20], h.DOCS)
    out = mixing.mix_documents(docs, [3, 1, 2], 1.5, 2.0)
    sizes = docs.select("doc_id", "source", mixing.word_count("text").alias("size"))
    target = {r["source"]: r["target"] for r in mixing.targets(sizes, [3, 1, 2], 1.5, 2.0).collect()}
    words = {r["source"]: r["sum(n)"] for r in out.select("source", mixing.word_count("text").alias("n")).groupBy("source").sum("n").collect()}
    for s, t in target.items():
        assert abs(words[s] - t) <= 1001
    assert {tuple(r)[:4] for r in out.collect()} <= {tuple(r)[:4] for r in docs.collect()}
    assert sorted(map(str, out.collect())) == sorted(map(str, mixing.mix_documents(docs.repartition(5), [3, 1, 2], 1.5, 2.0).collect()))


def test_hash_tells_thue_morse_words_apart(spark):
    from brisa.llm import neardup
    t = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
    u = t.translate(str.maketrans("ab", "ba"))
    docs = h.docs_of(spark, [t, u, t])
    assert {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(docs).collect()} == {0: 0, 1: 1, 2: 0}
