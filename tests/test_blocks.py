"""Block helpers against brute force in plain Python."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from brisa.operators import blocks


def test_windowed_matches_plain_window_across_block_edges(spark):
    rows = [("a", h, float(h * h % 17)) for h in range(100)] + [("b", h, float(h)) for h in range(5, 60)]
    df = spark.createDataFrame(rows, "k string, h bigint, v double")
    got = blocks.windowed(df, ["k"], "h", lambda w: {"s": F.sum("v").over(w.rowsBetween(-3, 2)), "p": F.lag("v", 3).over(w)},
                          before=3, after=2, block=7)
    by = {}
    for k, h, v in rows:
        by.setdefault(k, []).append((h, v))
    want = {}
    for k, xs in by.items():
        for i, (h, _) in enumerate(xs):
            want[(k, h)] = (sum(v for _, v in xs[max(0, i - 3):i + 3]), xs[i - 3][1] if i >= 3 else None)
    out = {(r.k, r.h): (r.s, r.p) for r in got.collect()}
    assert out == want


@pytest.mark.parametrize("hot", [False, True])
def test_ranged_positions_with_hot_key_and_copies(spark, hot):
    rng = random.Random(3)
    rows = [("hot" if hot or rng.random() < 0.5 else f"k{rng.randrange(4)}", rng.randrange(6), rng.randrange(3)) for _ in range(400)]
    rows += [("hot", 1, 1)] * 150
    df = spark.createDataFrame(rows, "k string, a int, b int")
    got = sorted((r.k, r.pos, r.a, r.b) for r in blocks.ranged_positions(df, ["k"], ["a", "b"]).collect())
    want = []
    for k in {r[0] for r in rows}:
        want += [(k, i + 1, a, b) for i, (_, a, b) in enumerate(sorted(r for r in rows if r[0] == k))]
    assert got == sorted(want)


def test_ranged_positions_keeps_payload(spark):
    rows = [(i, f"p{i}") for i in range(50)]
    out = blocks.ranged_positions(spark.createDataFrame(rows, "i int, p string"), [], ["i"]).collect()
    assert sorted((r.i, r.p, r.pos) for r in out) == [(i, f"p{i}", i + 1) for i in range(50)]


def test_running_total(spark):
    rows = [(i, (i * 7) % 5 + 1) for i in range(60)]
    out = blocks.running_total(spark.createDataFrame(rows, "i int, w int"), ["i"], F.floor(F.col("i") / 8), F.col("w"), "c").collect()
    want = np.cumsum([w for _, w in rows])
    assert [r.c for r in sorted(out, key=lambda r: r.i)] == want.tolist()


def test_exact_quantiles(spark):
    rng = np.random.default_rng(5)
    vals = {"x": np.concatenate([rng.normal(size=500), np.full(250, 1.5)]), "y": rng.integers(0, 6, 90).astype(float), "z": np.array([4.0])}
    df = spark.createDataFrame([(k, float(v)) for k, vs in vals.items() for v in vs], "k string, v double")
    counts = blocks.settle(blocks.value_counts(df, ["k"], "v"), "c")
    probs = [0.0, 0.05, 0.25, 0.5, 0.9, 1.0]
    got = {(r.k, r.p): r.q for r in blocks.exact_quantiles(counts, ["k"], probs).collect()}
    assert set(got) == {(k, p) for k in vals for p in probs}
    for (k, p), q in got.items():
        assert q == pytest.approx(np.quantile(vals[k], p), abs=1e-12), (k, p)


def test_exact_quantiles_without_keys(spark):
    vals = [float((i * 37) % 101) for i in range(300)]
    counts = blocks.settle(blocks.value_counts(spark.createDataFrame([(v,) for v in vals], "v double"), [], "v"), "c")
    got = {r.p: r.q for r in blocks.exact_quantiles(counts, [], [0.25, 0.5]).collect()}
    assert got == {p: pytest.approx(np.quantile(vals, p)) for p in (0.25, 0.5)}
