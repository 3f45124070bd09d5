"""Registered queries against their SQL twins, the pipeline against its stages' rules."""

from __future__ import annotations

import hashlib
import math

import duckdb
import pytest

import corpus_pipeline
from brisa.llm.queries import QUERIES, SQL
from tests.llm import helpers as h
from tools.check import TABLES, rows_of


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
    return con


PAGES, VECTORS, DOCUMENTS = ("pages", "page_id"), ("embeddings", "vec_id"), ("documents", "doc_id")
# table and key of the queries that give one row per row of a table
PER_ROW = {1: PAGES, 2: DOCUMENTS, 3: DOCUMENTS, 4: DOCUMENTS, 5: DOCUMENTS, 6: PAGES, 7: VECTORS, 8: DOCUMENTS, 9: DOCUMENTS, 10: DOCUMENTS, 11: DOCUMENTS}


@pytest.mark.parametrize("name", [n for n in QUERIES if n != "pipeline"])
def test_query(spark, duck, sf, name):
    df = QUERIES[name](spark, sf)
    cols, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    number = int(name.split("_")[0].removeprefix("op"))
    if number in PER_ROW:
        table, key = PER_ROW[number]
        assert len(got) == duck.execute(f"select count(*) from {table}").fetchone()[0] and key in df.columns
    if name in SQL:
        rel = duck.execute(SQL[name])
        ocols, want = rows_of([c[0] for c in rel.description], rel.fetchall())
        assert cols == ocols
        assert got == want


def test_near_duplicates_and_repeats_on_the_given_table(spark, duck, sf):
    texts = dict(duck.execute("select doc_id, text from documents").fetchall())
    assert {r[0]: tuple(r[1:4]) for r in QUERIES["op5_minhash_near_dedup"](spark, sf).collect()} == h.near_duplicates(texts)
    assert {r[0]: tuple(r[1:5]) for r in QUERIES["op2_suffix_dedup"](spark, sf).collect()} == h.removed(texts, 200)


def test_personal_data_on_the_given_table(spark, duck, sf):
    texts = dict(duck.execute("select doc_id, text from documents").fetchall())
    for r in QUERIES["op11_pii"](spark, sf).collect():
        base = h.base_pii(texts[r["doc_id"]])
        counts = [sum(s[3] == k for s in base) for k in ("email", "ip", "card", "phone")]
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == counts
        assert r["base_sha256"] == hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, _, b, k in base).encode()).hexdigest()
        assert {f"{k}:{a}:{b}" for a, _, b, k in base} <= set(r["spans"].split(","))| {""}


def test_spelling_variants_and_negatives_on_the_given_table(spark, duck, sf):
    got = {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in QUERIES["op12_spelling_variants"](spark, sf).collect()}
    assert got == h.variants(h.damaged(duck.execute("select doc_id, text from documents").fetchall()))
    rows = [(i, (c + 1) % 10 if i % 7 == 0 else c, [math.floor(256 * float(x)) for x in v]) for i, c, v in duck.execute("select vec_id, label, embedding from embeddings").fetchall()]
    assert sorted(tuple(r) for r in QUERIES["op13_hard_negatives"](spark, sf).collect()) == sorted(h.hard_negatives(rows))


def test_pipeline(spark, duck, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        path = spark.conf.get("spark.checkpoint.dir") + f"/pipeline-test-{name}"
        out.write.parquet(path)
        if name != "mixing":
            assert out.columns == docs.columns
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        docs = spark.read.parquet(path)
        rows = docs.collect()
        kept[name] = {r["doc_id"]: r["text"] for r in rows}
        if name == "near_duplicates":
            assert set(kept[name]) == {i for i, v in h.near_duplicates(before, corpus_pipeline.SHINGLE).items() if v[2]}
        if name == "repeats":
            cut = h.removed(before, 200)
            assert all(len(kept[name][i].encode()) <= cut[i][0] - cut[i][1] for i in kept[name])
            assert all(kept[name][i] == before[i] for i in before if not cut[i][1])
        if name == "mixing":
            assert set(kept[name]) <= set(before) and len(rows) > len(before)
    assert len(kept["language"]) > 150
