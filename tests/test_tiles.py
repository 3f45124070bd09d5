"""Tiled grids, manifests, containment, function metrics and hour-vector roll-forward against plain computations."""

from __future__ import annotations

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from brisa.catalog import QUERIES
from brisa.functions import clock, metrics
from brisa.operators import align, grid, prep, tiles, vectors, verify
from brisa.session import work_path
from brisa.sources import manifest, sinks

T0 = dt.datetime(2024, 1, 30)


def field(spark, n_lat=7, n_lon=10, hours=60):
    rng = random.Random(1)
    rows = [(T0 + dt.timedelta(hours=h), v, i, j, 18.0 + 0.1 * i, -99.0 + 0.1 * j, None if rng.random() < 0.05 else rng.random() * 9)
            for h in range(0, hours, 5) for v in ("T2", "U10") for i in range(n_lat) for j in range(n_lon) if not (i == 6 and j == 8)]
    return spark.createDataFrame(rows, "ts timestamp_ntz, var string, i int, j int, lat double, lon double, value double")


@pytest.fixture(scope="module")
def store(spark):
    return tiles.write(field(spark), work_path(spark, "store"), side=3)


def values(df, *cols):
    return sorted((tuple(r[c] if not isinstance(r[c], float) else round(r[c], 9) for c in cols) for r in df.collect()), key=str)


def test_cells_survive_the_round_trip(spark, store):
    want = field(spark).filter("value is not null")
    assert values(tiles.cells(store.tiles(), 3), "ts", "var", "i", "j", "value") == values(want, "ts", "var", "i", "j", "value")
    assert store.shape() == (7, 10)


@pytest.mark.parametrize("box", [(18.15, 18.55, -98.85, -98.25), (0.0, 99.0, -200.0, 0.0), (18.3, 18.5, -98.9, -98.2)])
def test_crop_reads_its_tiles_only(spark, store, box):
    want = grid.crop(field(spark), box, *store.axes()).filter("value is not null")
    got = store.crop(box)
    assert values(got, "ts", "var", "i", "j", "value") == values(want, "ts", "var", "i", "j", "value")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "ti" in plan.split("PushedFilters")[1].split("]")[0]


def test_bilinear_subsample_and_stack_equal_those_on_cells(spark, store):
    lat, lon = store.axes()
    a, b = grid.axis_weights(lat, 17.95, 18.65, 0.07), grid.axis_weights(lon, -99.05, -98.1, 0.06)
    cols = ("ts", "var", "row", "col", "lat", "lon", "value")
    assert values(tiles.bilinear(store.tiles(), a, b, 3), *cols) == values(grid.bilinear(field(spark), a, b), *cols)
    got, want = tiles.subsample(store.tiles(), 2, 3, store), grid.subsample(field(spark), 2, 3, lat, lon)
    assert values(got, "ts", "var", "row", "col", "value") == values(want, "ts", "var", "row", "col", "value")
    flat = {(r.ts, r.pos): r.value for r in tiles.stack(store.tiles(), ["T2", "U10"], store).collect()}
    cube = {}
    for r in field(spark).collect():
        cube[(r.ts, ["T2", "U10"].index(r["var"]) * 70 + r.i * 10 + r.j)] = r.value or 0.0
    assert {k: v for k, v in flat.items() if v} == {k: v for k, v in cube.items() if v} and len(flat) == 12 * 140


def test_axes_come_from_the_catalogue(store):
    lat, lon = store.axes()
    w = grid.axis_weights(lat, 18.0, 18.4, 0.1)
    assert w.count() and "tiles" not in "".join(w.inputFiles()) + "".join(lon.inputFiles())


def test_scan_opens_only_the_files_that_count(spark, store):
    everything = store.tiles()
    some = store.tiles("2024-01-30", "2024-01-31", ["T2"])
    assert len(everything.inputFiles()) == 4 and len(some.inputFiles()) == 1
    assert {r.ts for r in some.select("ts").collect()} == {T0 + dt.timedelta(hours=h) for h in range(0, 24, 5)}
    assert store.tiles("2030-01-01", "2031-01-01").count() == 0


def test_manifest_days_and_zero_days(spark):
    w = field(spark, hours=24).unionByName(field(spark, hours=24).withColumn("ts", clock.shift_hours(F.col("ts"), 96)))
    s = tiles.write(w, work_path(spark, "gap"), side=4)
    first = (T0 - dt.datetime(1970, 1, 1)).days
    assert sorted(r.day for r in manifest.days(s.manifest()).collect()) == [first, first + 4]
    assert manifest.days(s.manifest(), 6).count() == 0
    made = tiles.zero_days(s, ["T2"])
    assert made.count() == 3 * 24 * 70 and {r.ts.day for r in made.select("ts").distinct().collect()} == {31, 1, 2}


def test_manifest_of_a_grid_table(spark):
    path = work_path(spark, "plain")
    sinks.write_grid(field(spark), path)
    m = manifest.build(spark, path)
    assert len(manifest.files(m, "2024-02-01")) == 1 and manifest.scan(spark, path, m, "2024-01-31", "2024-02-01").count() == field(spark).filter("ts >= '2024-01-31' and ts < '2024-02-01'").count()


def test_contained_names_against_every_pair(spark):
    rng = random.Random(2)
    needles = ["", "a", "ab", "abc", "model", "model_1", "zz", "é", "éa"] + ["".join(rng.choice("abé_") for _ in range(rng.randrange(1, 7))) for _ in range(60)]
    hay = ["", "model_12", "a"] + ["x" + "".join(rng.choice("abé_") for _ in range(rng.randrange(1, 14))) for _ in range(80)]
    got = align.contained(spark.createDataFrame([(x,) for x in needles], "n string"), spark.createDataFrame([(x,) for x in hay], "h string"), "n", "h")
    assert {tuple(r) for r in got.select("n", "h").collect()} == {(n, x) for n in needles for x in hay if n and n in x}


def test_match_configs_takes_the_same_name_then_the_first(spark):
    models = spark.createDataFrame([("abc_1",), ("zzz",), ("abc",), ("q",)], "model string")
    configs = spark.createDataFrame([("abc_1_long", 5), ("abc", 7), ("bc_1", 6), ("zz", 3), ("yzzzy", 2)], "config string, ord int")
    assert {r.model: r.config for r in align.match_configs(models, configs).collect()} == {"abc_1": "abc_1_long", "zzz": "yzzzy", "abc": "abc", "q": None}
    assert {r.config for r in align.match_configs(models.limit(1), configs.unionByName(spark.createDataFrame([("", 1)], "config string, ord int"))).collect()} == {""}


def test_function_metric_and_its_bound(spark):
    d = spark.createDataFrame([("a", 1.0, 2.0), ("a", 5.0, 1.0), ("a", 3.0, None), ("b", 1.0, 1.5), ("c", None, 1.0)], "g string, target double, pred double")
    metrics.register_function("largest", lambda t, p: np.abs(t - p).max())
    assert {r.g: r.largest for r in verify.apply_metrics(d, ["g"], ["largest"]).collect()} == {"a": 4.0, "b": 0.5}
    metrics.register_function("small_groups", lambda t, p: 0.0, max_rows=1)
    with pytest.raises(Exception, match="a group has 3 rows, the bound is 1"):
        verify.apply_metrics(d, ["g"], ["small_groups"]).collect()


def test_function_metric_query_beyond_the_bound(spark, tmp_path):
    n = metrics.MAX_ROWS + 1001
    k = F.col("id")
    lines = spark.range(n).select(F.lit("A").alias("l_returnflag"), k.alias("l_orderkey"), F.lit(10).cast("bigint").alias("l_suppkey"),
                                  F.date_add(F.lit("1992-01-01").cast("date"), (k % 3600).cast("int")).alias("l_shipdate"),
                                  ((k + 1) * 500).cast("double").alias("l_extendedprice"), F.lit(0.5).alias("l_discount"), F.lit(0.0).alias("l_tax"))
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    got = {r.split: (r.median_error, r.mae) for r in QUERIES["function_metric"](spark, str(tmp_path)).collect()}
    assert set(got) == {"all", "train", "val", "test"} and got["all"] == ((n + 1) / 4, (n + 1) / 4)


def test_ranked_function_metric_against_a_sort(spark):
    rng = random.Random(8)
    values = [0.0, -0.0, 1.0, 1.0 + 2 ** -52, -1e300, 5e-324, float("inf"), -3.5, None, float("nan")]
    rows = [(rng.choice(["a", "b", None]), rng.choice(values) if k % 3 else rng.gauss(0, 5), rng.choice([1.0, 2.5, None]) if k % 5 else rng.gauss(0, 5)) for k in range(600)]
    rows += [("same", 3.0, 4.0)] * 50 + [("one", 1.0, 1.25), ("none", 1.0, None), ("odd", float("inf"), float("inf")), ("odd", 1.0, 2.0), ("two", 1.0, 1.0), ("two", 1.0, 4.0)]
    d = spark.createDataFrame(rows, "g string, target double, pred double").repartition(5)
    for q in (0.0, 0.3, 0.5, 1.0):
        metrics.register_function("ranked", lambda t, p: p - t, max_rows=10, quantile=q)
        got = {r.g: (r.ranked, r.mae) for r in verify.apply_metrics(d, ["g"], ["ranked", "mae"]).collect()}
        assert set(got) == {"a", "b", None, "same", "one", "none", "odd", "two"} and got["none"] == (None, None)
        for g in set(got) - {"none"}:
            v = sorted(p - t for k, t, p in rows if k == g and t is not None and p is not None and t == t and p == p)
            h = (len(v) - 1) * q
            lo, hi = v[int(h)], v[-int(-h // 1)]
            want = float("nan") if any(x != x for x in v) else lo if lo == hi else lo * (1 - h % 1) + hi * (h % 1)
            assert got[g][0] == pytest.approx(want, rel=1e-12, abs=0, nan_ok=True), (g, q)
    total = verify.apply_metrics(d.where("g in ('same', 'two')"), [], ["ranked"]).collect()
    assert [tuple(r) for r in total] == [(3.0,)]
    metrics.register_function("short", lambda t, p: p[:1], quantile=0.5)
    with pytest.raises(Exception, match="values for"):
        verify.apply_metrics(d.coalesce(1), ["g"], ["short"]).collect()


COLUMNS = prep.model_columns(["S0", "S1"], ["co"])


def samples(spark, n=5, prev=4, errors=()):
    rng = np.random.default_rng(0)
    rows = [(100 + k, rng.random((prev, len(COLUMNS))).tolist() if k not in errors else None, rng.random((12, 2)).tolist(), "no data" if k in errors else None) for k in range(n)]
    return rows, spark.createDataFrame(rows, "h bigint, x array<array<double>>, weather array<array<double>>, error string")


def test_model_columns_keep_their_places():
    full = prep.model_columns([f"S{k}" for k in range(30)], ["co", "nodos", "pmdiez", "pmdoscinco", "nox", "no", "sodos", "pmco"])
    assert len(full) == 66 and full[30:42] == clock.time_names() and full[42:45] == ["cont_co_mean", "cont_co_min", "cont_co_max"]
    assert vectors.target_positions(full) == [*range(30), *range(42, 66)] and vectors.time_positions(full) == list(range(30, 42))


def test_roll_positions_against_a_plain_loop(spark):
    rows, d = samples(spark)
    model = vectors.column_model(COLUMNS)
    got = {(r.h, r.horizon, r.position): r.value for r in vectors.roll_positions(d, model, COLUMNS, steps=6, width=3).collect()}
    targets, time = vectors.target_positions(COLUMNS), vectors.time_positions(COLUMNS)
    stamps = {r.h: [r[n] for n in clock.time_names()] for r in spark.range(100, 120).select(F.col("id").alias("h"), *[c.alias(n) for n, c in clock.time_features(clock.hour_stamp(F.col("id"))).items()]).collect()}
    for h, x, w, _ in rows:
        x, w = np.array(x), np.array(w)
        for k in range(6):
            y = model(x[None], w[None, k:k + 3], k, np.array([h + k]))[0]
            assert [got[h, k + 1, p] for p in range(len(targets))] == pytest.approx(list(y))
            row = np.zeros(len(COLUMNS))
            row[targets], row[time] = y, stamps[h + k]
            x = np.vstack([x[1:], row])


def test_a_failing_origin_keeps_its_rows_with_the_reason(spark):
    _, d = samples(spark, errors=(1,))
    plain = vectors.column_model(COLUMNS)

    def model(x, w, k, hours):
        if k == 2 and (hours - k == 103).any():
            raise RuntimeError("no weights")
        return plain(x, w, k, hours)

    out = vectors.roll_positions(d, model, COLUMNS, steps=3, width=3).groupBy("h").agg(F.count("value").alias("n"), F.count(F.lit(1)).alias("rows"), F.max("error").alias("error"))
    got = {r.h: (r.n, r.rows, r.error) for r in out.collect()}
    assert got == {100: (15, 15, None), 101: (0, 15, "no data"), 102: (15, 15, None), 103: (0, 15, "RuntimeError: no weights"), 104: (15, 15, None)}


def test_sample_matrix_windows_and_gaps(spark):
    hours = [h for h in range(1000, 1060) if h != 1030]
    d = spark.createDataFrame([(h, [float(h * 100 + c) for c in range(len(COLUMNS))], [h % 2] * 5) for h in hours], "h bigint, vector array<double>, mask array<int>")
    got = {r.h: r for r in vectors.sample_matrix(d, COLUMNS, prev=5, next_weather=2, steps=3).collect()}
    want = [h for h in hours if all(x in hours for x in range(h - 5, h + 6))]
    assert sorted(got) == want
    t = vectors.target_positions(COLUMNS)
    for h in want:
        assert [row[0] for row in got[h].x] == [x * 100.0 for x in range(h - 5, h)]
        assert [list(row) for row in got[h].y] == [[x * 100.0 + c for c in t] for x in range(h, h + 3)] and [m[0] for m in got[h].y_mask] == [x % 2 for x in range(h, h + 3)]
