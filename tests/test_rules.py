"""Hand-computed cases for the behaviour rules."""

from __future__ import annotations

import datetime as dt
import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from brisa.functions import air, clock, metrics, names
from brisa.operators import align, experiments, forecast, grid, impute, panel, prep, stats, verify, windows

T0 = dt.datetime(2024, 1, 1)


def hours(n, start=T0):
    return [start + dt.timedelta(hours=i) for i in range(n)]


def obs_df(spark, rows):
    return spark.createDataFrame(rows, "fecha timestamp_ntz, pollutant string, id_est string, val double")


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def scalar(spark, col, **values):
    names_, vals = zip(*values.items()) if values else (("x",), (1,))
    return spark.createDataFrame([tuple(vals)], list(names_)).select(col.alias("r")).first()[0]


# ---- gap filling -----------------------------------------------------------------------

def _persist(spark):
    rows = [(T0 + dt.timedelta(hours=7), "otres", "A", 5.0)]
    return impute.start_flags(panel.fill_calendar(obs_df(spark, rows), start="2024-01-01 07:00:00", end="2024-01-04 07:00:00"))


def test_persistence_chain(spark):
    out = {r.fecha: (r.val, r.flag) for r in impute.fill_persistence_chain(_persist(spark)).filter(F.hour("fecha") == 7).collect()}
    assert [out[T0 + dt.timedelta(days=k, hours=7)] for k in range(4)] == [(5.0, "none")] + [(5.0, "last_day_same_hour")] * 3


def test_persistence_day(spark):
    out = {r.fecha: (r.val, r.flag) for r in impute.fill_persistence_day(_persist(spark)).filter(F.hour("fecha") == 7).collect()}
    assert [out[T0 + dt.timedelta(days=k, hours=7)] for k in range(4)] == [
        (5.0, "none"), (5.0, "last_day_same_hour"), (None, "missing"), (None, "missing")]


@pytest.mark.parametrize("valid,expected", [(6, (3.5, "row_avg")), (5, (None, "missing"))])
def test_row_average_needs_more_than_five(spark, valid, expected):
    rows = [(T0, "otres", f"S{i}", float(i)) for i in range(1, valid + 1)] + [(T0 + dt.timedelta(hours=1), "otres", "S9", 1.0)]
    full = impute.start_flags(panel.fill_calendar(obs_df(spark, rows)))
    a = impute.fill_row_average(full, impute.row_average(obs_df(spark, rows)))
    b = impute.fill_row_average_here(full)
    for d in (a, b):
        r = one(d.filter((F.col("id_est") == "S9") & (F.col("fecha") == F.lit(T0).cast("timestamp_ntz"))))
        assert (r.val, r.flag) == expected


def test_row_average_trimmed(spark):
    rows = [(T0, "otres", s, v) for s, v in (("a", 10.0), ("b", 20.0), ("c", 30.0), ("d", 0.0))]
    assert one(impute.row_average_trimmed(obs_df(spark, rows))).row_val == 15.0
    assert impute.row_average_trimmed(obs_df(spark, rows[:2])).count() == 0


def test_quality_limits(spark):
    rows = [(T0, "otres", s, v) for s, v in (("a", -1.0), ("b", 500.0), ("c", 501.0))] + [
        (T0, "pmdiez", "a", 1000.0), (T0, "pmdiez", "b", 1001.0), (T0, "co", "a", float("nan"))]
    out = {(r.pollutant, r.id_est): r.val for r in impute.apply_quality(obs_df(spark, rows)).collect()}
    assert out == {("otres", "a"): None, ("otres", "b"): 500.0, ("otres", "c"): None, ("pmdiez", "a"): 1000.0, ("pmdiez", "b"): None, ("co", "a"): None}


def test_climatology_edges_and_leap_day(spark):
    pts = {(1, 1, 0): 3.0, (1, 1, 1): 6.0, (12, 31, 22): 9.0, (12, 31, 23): 12.0, (2, 29, 5): 7.0}
    rows = [(dt.datetime(2020, m, d, h), "otres", "A", v) for (m, d, h), v in pts.items()]
    c = {(r.month, r.day, r.hour): r.val for r in impute.climatology(obs_df(spark, rows)).collect()}
    assert len(c) == 8784
    a0, a1, y, z = 4.5, 4.5, (9 + 12) / 2, (9 + 12) / 2
    first = (z + a0 + a1) / 3
    assert c[(1, 1, 0)] == pytest.approx(first)
    assert c[(12, 31, 23)] == pytest.approx((y + z + first) / 3)
    assert c[(2, 29, 6)] == 7.0 and c[(6, 1, 0)] is None


def test_climatology_flag_only_with_value(spark):
    rows = [(T0, "otres", "A", 5.0)]
    full = impute.start_flags(panel.fill_calendar(obs_df(spark, rows), end="2024-01-01 03:00:00"))
    table = spark.createDataFrame([("otres", "A", 1, 1, 1, 9.0), ("otres", "A", 1, 1, 2, None)], "pollutant string, id_est string, month int, day int, hour int, val double")
    out = [(r.val, r.flag) for r in impute.fill_lookup(full, table, "climatology").orderBy("fecha").collect()]
    assert out == [(5.0, "none"), (9.0, "climatology"), (None, "missing"), (None, "missing")]


def test_historical_average_needs_five_positive_rows(spark):
    rows = [(dt.datetime(y, 3, 1, 4), "otres", "A", v) for y, v in zip(range(2018, 2024), (10.0, 20.0, 30.0, 40.0, 50.0, -5.0))]
    assert one(impute.historical_average(obs_df(spark, rows), "2024-01-01", years=7)).val == 30.0
    assert impute.historical_average(obs_df(spark, rows), "2024-01-01", years=5).count() == 0


def test_pipeline_invariants(spark):
    rows = [(h, "otres", f"S{s}", float((i * 7 + s * 3) % 50 + 1)) for s in range(8) for i, h in enumerate(hours(80)) if (i * s + i) % 4]
    obs = obs_df(spark, rows)
    out = impute.training_pipeline(obs).collect()
    seen = {(r[0], r[2]): r[3] for r in rows}
    assert len(out) == len({r[2] for r in rows}) * len({r.fecha for r in out})
    for r in out:
        if r.flag == "none":
            assert r.val == seen[(r.fecha, r.id_est)]
        else:
            assert (r.fecha, r.id_est) not in seen
            assert (r.val is None) == (r.flag == "missing")
    s = impute.summary(spark.createDataFrame([(r.pollutant, r.id_est, r.flag) for r in out], "pollutant string, id_est string, flag string")).collect()
    assert all(x.n == x.original + x.imputed + x.missing for x in s)


# ---- indices and time ------------------------------------------------------------------

def nowcast(spark, vals, pollutant):
    c = air.nowcast(F.array(*[F.lit(float(v)) for v in vals]), air.NOWCAST_FACTOR[pollutant])
    v = scalar(spark, c)
    return v, None if v is None else scalar(spark, air.aq_category(F.lit(v), F.lit(pollutant)))


def test_nowcast(spark):
    v, cat = nowcast(spark, [80, 90, 100, 95, 85, 75, 70, 60, 55, 50, 45, 40], "PM10")
    assert v == pytest.approx(61.229641, abs=1e-6) and cat == "Mala"
    v, cat = nowcast(spark, [10, 15, 20, 25, 22, 18, 15, 13, 12], "PM2.5")
    assert v == pytest.approx(9.716, abs=1e-3) and cat == "Buena"
    assert nowcast(spark, [1, 2], "PM10")[0] is None


@pytest.mark.parametrize("value,index,category", [(0.090, 90, "Regular"), (0.070, 50, "Buena"), (0.0705, 50, "Buena")])
def test_imeca(spark, value, index, category):
    assert scalar(spark, air.imeca(F.lit(value), F.lit("O3"))) == index
    assert scalar(spark, air.imeca_category(F.lit(value), F.lit("O3"))) == category
    assert scalar(spark, air.imeca(F.lit(value), F.lit("unknown"))) is None


def test_time_features_and_flip(spark):
    ts = F.lit(dt.datetime(2024, 1, 1, 7)).cast("timestamp_ntz")
    got = spark.range(1).select(*[c.alias(n) for n, c in clock.time_features(ts).items()]).first().asDict()
    want = dict(half_sin_day=.793353, half_cos_day=.608761, half_sin_week=.937542, half_cos_week=.347871, half_sin_year=.001692, half_cos_year=.999999,
                sin_day=.965926, cos_day=-.258819, sin_week=-.652287, cos_week=-.757972, sin_year=.003383, cos_year=.999994)
    assert got == {k: pytest.approx(v, abs=2e-6) for k, v in want.items()}
    flip = spark.range(1).select(*[c.alias(n) for n, c in clock.time_features(ts, True).items()]).first().asDict()
    assert flip["sin_week"] == got["sin_year"] and flip["sin_year"] == got["sin_week"] and flip["sin_day"] == got["sin_day"]


def test_date_onehot_week_53(spark):
    ts = F.lit(dt.datetime(2020, 12, 31, 5)).cast("timestamp_ntz")
    r = spark.range(1).select(*[c.alias(n) for n, c in clock.date_onehot(ts).items()]).first().asDict()
    assert sum(v for k, v in r.items() if k.startswith("week_") and not k.startswith("week_day")) == 0
    assert r["week_day_3"] == 1 and r["hour_5"] == 1 and r["year"] == pytest.approx(40 / 60) and len(r) == 83


def test_round_hour_half_even(spark):
    for minute, want in ((30, 0), (31, 1)):
        t = dt.datetime(2024, 1, 1, 0, minute)
        assert scalar(spark, clock.round_hour(F.lit(t).cast("timestamp_ntz"))) == T0 + dt.timedelta(hours=want)
    assert scalar(spark, clock.round_hour(F.lit(dt.datetime(2024, 1, 1, 1, 30)).cast("timestamp_ntz"))) == T0 + dt.timedelta(hours=2)


def test_relative_humidity(spark):
    assert scalar(spark, air.relative_humidity(F.lit(293.15), F.lit(0.008), F.lit(78000.0))) == pytest.approx(42.384683, abs=1e-6)


def test_parse_mixed(spark):
    assert scalar(spark, clock.parse_mixed(F.lit("2024-01-01"))) == T0
    assert scalar(spark, clock.parse_mixed(F.lit("2024-01-01 05:00:00"))) == T0 + dt.timedelta(hours=5)
    assert scalar(spark, clock.parse_mixed(F.lit("x"))) is None


def test_names(spark):
    def get(c):
        return spark.range(1).select(c.alias("r")).first().r
    assert get(names.param_table(F.lit("PMCO_x"))) == "cont_pmco" and get(names.param_table(F.lit("NOX"))) == "cont_nox"
    assert get(names.param_table(F.lit("what"))) is None
    assert get(names.series_pollutant(F.lit("i_cont_pmdiez_PED"))) == "pmdiez" and get(names.strip_lead(F.lit("plus_05_cont_otres_X"))) == "cont_otres_X"
    assert get(names.forecast_hour(F.lit("/a/Model_forecast_8.csv"))) == 8 and get(names.forecast_hour(F.lit("/a/run_12.csv"))) == 12
    assert get(names.station_label(F.lit("PED"))) == "Pedregal" and get(names.station_label(F.lit("??"))) == "Station ID not found"


# ---- parameters ------------------------------------------------------------------------

def test_prefix_parameters_are_not_inverse(spark):
    # Shipped parameters of the codes involved.
    shipped = [("co", 0.7127712660418022, 0.4848537095507402), ("no", 29.299234076065016, 26.575794597604833), ("nodos", 25.551422740337987, 12.97303161250568)]
    p = spark.createDataFrame([(n, m, s, n) for n, m, s in shipped], "name string, mean double, std double, ord string")
    d = stats.prefix_chain(p, p.select(F.col("name").alias("pollutant"))).withColumn("z", stats.prefix_zscore(F.lit(30.0), F.col("chain")))
    d = d.withColumn("back", stats.prefix_denormalize(F.col("z"), F.col("chain")))
    out = {r.pollutant: (r.z, r.back) for r in d.collect()}
    assert out["nodos"] == (pytest.approx(-1.967547, abs=1e-6), pytest.approx(-272.697284, abs=1e-6))
    assert out["co"][1] == pytest.approx(30.0) and out["no"][1] == pytest.approx(30.0)


def test_prefix_pooling_and_exact_params(spark):
    rows = [(h, p, "A", v + i) for p, v in (("no", 1.0), ("nox", 11.0)) for i, h in enumerate(hours(3))]
    exact = {r.name: r.mean for r in stats.norm_params(obs_df(spark, rows)).collect()}
    pooled = {r.name: r.mean for r in stats.norm_params(obs_df(spark, rows), compat="prefix").collect()}
    assert exact == {"no": 2.0, "nox": 12.0} and pooled == {"no": 7.0, "nox": 12.0}


def test_zscore_roundtrip(spark):
    rows = [(h, "co", "A", float(i)) for i, h in enumerate(hours(5))]
    o = obs_df(spark, rows)
    p = stats.norm_params(o)
    back = stats.denormalize(stats.zscore(o, p, fill=None).drop("val"), p)
    assert sorted(r.val for r in back.collect()) == pytest.approx([0, 1, 2, 3, 4])


# ---- verification ----------------------------------------------------------------------

def test_confusion_counts(spark):
    rows = [("m", 1, T0, "S", t, p) for t, p in ((95.0, 96.0), (95.0, 80.0), (70.0, 91.0), (10.0, 20.0), (None, 95.0))]
    fc = spark.createDataFrame(rows, "model string, predicted_hour int, ts timestamp_ntz, station string, target double, pred double")
    r = one(verify.confusion(fc, thresholds=[90]))
    assert (r.tp, r.fn, r.fp, r.tn) == (1, 1, 1, 1)
    m = one(verify.class_metrics(verify.confusion(fc.filter("target is null"), thresholds=[90]).unionByName(
        verify.confusion(fc.filter(F.col("target") > 1e9), thresholds=[90]))).agg(F.count("*").alias("n")))
    assert m.n == 0


def test_metric_suite_against_numpy(spark):
    import numpy as np
    rng = np.random.default_rng(1)
    t, p = rng.normal(50, 15, 200), rng.normal(50, 15, 200)
    fc = spark.createDataFrame(pd.DataFrame({"g": "a", "target": t, "pred": p}))
    r = one(verify.metric_suite(fc, ["g"]))
    ioa = 1 - ((t - p) ** 2).sum() / ((abs(p - t.mean()) + abs(t - t.mean())) ** 2).sum()
    assert (r.mae, r.mse, r.ioa) == (pytest.approx(abs(t - p).mean()), pytest.approx(((t - p) ** 2).mean()), pytest.approx(ioa))
    assert r.r2 == pytest.approx(1 - ((t - p) ** 2).sum() / ((t - t.mean()) ** 2).sum()) and r.corr == pytest.approx(np.corrcoef(t, p)[0, 1])
    flat = one(verify.metric_suite(spark.createDataFrame([("a", 3.0, 3.0)], "g string, target double, pred double"), ["g"]))
    assert flat.ioa is None and flat.r2 is None


def test_target_time(spark):
    k = 5
    stored = T0 + dt.timedelta(hours=2 * k)
    assert scalar(spark, verify.realign_stored(F.lit(stored).cast("timestamp_ntz"), F.lit(k + 1))) == T0 + dt.timedelta(hours=k)
    assert scalar(spark, verify.target_time(F.lit(T0).cast("timestamp_ntz"), F.lit(k + 1))) == T0 + dt.timedelta(hours=k)


def test_daily_blocks_pad_the_tail(spark):
    rows = [("m", T0 + dt.timedelta(hours=i), None if i == 3 else 10.0 + i, 12.0 + i) for i in range(30)]
    fc = spark.createDataFrame(rows, "model string, ts timestamp_ntz, target double, pred double")
    r = one(verify.daily_block_error(fc, ["model"], ["ts"]))
    ta = [0 if i == 3 else 10.0 + i for i in range(30)]
    pa = [0 if i == 3 else 12.0 + i for i in range(30)]
    errs = [sum(ta[:24]) / 24 - sum(pa[:24]) / 24, sum(ta[24:]) / 24 - sum(pa[24:]) / 24]
    assert r.blocks == 2 and r.max_err_mean == -2.0 and r.mean_err_mean == pytest.approx(sum(errs) / 2)


def test_user_metric(spark):
    metrics.register("bias", lambda t, p: F.avg(p - t))
    assert "bias" in metrics.known()
    d = spark.createDataFrame([("a", 1.9, 3.9), ("a", None, 1.0)], "g string, target double, pred double")
    assert one(verify.apply_metrics(d, ["g"], ["bias"], integers=True)).bias == 2.0
    with pytest.raises(KeyError):
        metrics.get("nothing")


# ---- alignment, windows, splits --------------------------------------------------------

def test_asof_nearest_ties_ends_and_tolerance(spark):
    hs = spark.createDataFrame([("a", h) for h in range(0, 40)], "k string, h bigint")
    steps = [("a", 3), ("a", 7), ("a", 30)]
    for block in (5, 768):
        got = {r.h: r.step_h for r in align.asof_nearest(hs, spark.createDataFrame(steps, "k string, h bigint"), ["k"], block=block).collect()}
        assert got == {h: min((3, 7, 30), key=lambda s: (abs(s - h), s)) for h in range(40)}
    near = align.asof_nearest(hs, spark.createDataFrame(steps, "k string, h bigint"), ["k"], tolerance=2)
    assert {r.h for r in near.collect() if r.step_h is None} == {h for h in range(40) if min(abs(s - h) for s in (3, 7, 30)) > 2}


def test_sample_origins(spark):
    rows = [(h, "otres", "A", float(i)) for i, h in enumerate(hours(40))]
    full = impute.start_flags(panel.fill_calendar(obs_df(spark, rows)))
    s = windows.sample_windows(full, prev=24, next_weather=2, steps=8).orderBy("h").collect()
    assert [int(r.y[0]) for r in s] == [24, 25, 26, 27, 28, 29]
    assert all(r.x == [float(v) for v in range(int(r.y[0]) - 24, int(r.y[0]))] and r.mask == [0] * 8 for r in s)


def test_roll_forward_multi_series(spark):
    rows = [("a", 10, [float(v) for v in range(6)])]
    df = spark.createDataFrame(rows, "k string, h bigint, x array<double>")

    def model(win, wx, k, hrs):
        assert win.shape == (1, 3, 2) and hrs[0] == 10 + k
        return win[:, -1] + 1

    out = forecast.roll_forward(df, model, steps=3, n_series=2, keys=["k"]).orderBy("horizon", "series_idx").collect()
    assert [(r.horizon, r.series_idx, r.value) for r in out] == [(1, 0, 5), (1, 1, 6), (2, 0, 6), (2, 1, 7), (3, 0, 7), (3, 1, 8)]


def test_roll_forward_weather_window_moves(spark):
    df = spark.createDataFrame([("a", 0, [1.0, 1.0], [float(v) for v in range(9)])], "k string, h bigint, x array<double>, w array<double>")
    out = forecast.roll_forward(df, lambda win, wx, k, hrs: wx[:, 0] + 10 * wx.shape[1], steps=3, keys=["k"], weather="w", width=7)
    assert [r.value for r in out.orderBy("horizon").collect()] == [70.0, 71.0, 72.0]


def test_rain(spark):
    d = spark.createDataFrame([("f", i, v) for i, v in enumerate((0.0, 2.0, 5.0, 4.0))], "f string, t int, acc double")
    assert [r.rain for r in windows.rain_deaccumulate(d, ["f"], "t", "acc").orderBy("t").collect()] == [0, 2, 3, 0]
    assert [r.rain for r in windows.rain_forward_diff(d, ["f"], "t", "acc").orderBy("t").collect()] == [2, 3, 0, 4]


def test_tail_split(spark):
    d = spark.createDataFrame([(h, 1.0) for h in hours(25)], "fecha timestamp_ntz, weight double")
    out = prep.tail_split(d, 0.1, ["fecha"], weights="weight").collect()
    val = sorted(r.fecha for r in out if r.split == "val")
    assert val == hours(25)[-2:] and all(r.weight is None for r in out if r.split == "val")


def test_random_split_sizes_and_repeatable(spark):
    d = spark.range(101).withColumnRenamed("id", "i")
    a = {r.i: r.split for r in prep.random_split(d, ["i"], seed=1).collect()}
    b = {r.i: r.split for r in prep.random_split(d.repartition(7), ["i"], seed=1).collect()}
    assert a == b
    assert sorted(pd.Series(a).value_counts().to_dict().items()) == [("test", 11), ("train", 79), ("val", 11)]


def test_weighted_resample_sizes_shares_and_repeats(spark, monkeypatch):
    n = 600
    d = spark.createDataFrame([(h, 20 if i % 50 == 0 else 1) for i, h in enumerate(hours(n))] + [(None, 0), (hours(1)[0], None)], "fecha timestamp_ntz, weight int")
    results = []
    for rows_of_leaf in (4096, 8):      # one range, and a tree of them
        monkeypatch.setattr(prep, "LEAF_ROWS", rows_of_leaf)
        monkeypatch.setattr(prep, "SPLIT_BITS", 3)
        out = prep.weighted_resample(d, seed=7).collect()
        assert len(out) == n + 2 and {r.weight for r in out} == {1, 20}
        total = 12 * 20 + n - 12
        assert abs(sum(r.weight == 20 for r in out) / len(out) - 12 * 20 / total) < 0.08
        heavy = pd.Series([r.fecha for r in out if r.weight == 20]).value_counts()
        assert len(heavy) >= 11 and heavy.max() < 60
        results.append(sorted(map(str, out)))
        assert results[-1] == sorted(map(str, prep.weighted_resample(d.repartition(5), seed=7).collect()))
    assert prep.weighted_resample(d.limit(0)).count() == 0


def test_weighted_resample_follows_the_weights(spark):
    d = spark.range(40).select("id", (F.col("id") % 4 + 1).alias("weight"))
    got = {w: 0 for w in range(1, 5)}
    for seed in range(6):
        for r in prep.weighted_resample(d, seed=seed).collect():
            got[r.weight] += 1
    assert all(abs(got[w] / 240 - w / 10) < 0.1 for w in got)


def test_rank_row_and_split_against_sorting(spark):
    import random

    from brisa.operators import ranks

    rng = random.Random(3)
    words = ["", "a", "ab", "abc" * 20, "abc" * 20 + "d", "é", "漢", None]
    rows = [(rng.choice([None, 1.5, -2.0, float("nan"), float("inf"), 1e-320, 1e300, 3.0]), rng.choice(words), rng.choice(hours(3) + [None]), rng.randrange(-3, 4) * 10 ** rng.randrange(17)) for _ in range(400)]
    d = spark.createDataFrame(rows, "x double, s string, t timestamp_ntz, n bigint")
    first = lambda v: (v is not None, v != v, 0 if v is None or v != v else v)
    key = {"x": lambda r: first(r[0]), "s": lambda r: (r[1] is not None, (r[1] or "").encode()), "t": lambda r: (r[2] is not None, r[2] or T0), "n": lambda r: r[3]}
    at = {"x": 0, "s": 1, "t": 2, "n": 3}
    for order in (["x", "s", "t", "n"], ["s", "n"]):
        want = sorted(rows, key=lambda r: tuple(key[c](r) for c in order))
        for rank in (57, 400):
            got = ranks.rank_row(d, order, rank, few=5)
            assert [str(got[c]) for c in order] == [str(want[rank - 1][at[c]]) for c in order], (order, rank)
        out = ranks.split_at(d, order, 123, "a", "b").collect()
        assert sum(r.split == "a" for r in out) == 123 and len(out) == 400
        cut = tuple(key[c](want[122]) for c in order)
        assert all(tuple(key[c](tuple(r)[:4]) for c in order) <= cut for r in out if r.split == "a")
        assert all(tuple(key[c](tuple(r)[:4]) for c in order) >= cut for r in out if r.split == "b")
    same = spark.range(50).select(F.lit(1).alias("a"), F.lit("x").alias("b"))
    assert sorted(r.split for r in ranks.split_at(same, ["a"], 20, "p", "q").collect()) == ["p"] * 20 + ["q"] * 30


def test_contiguous_runs_cross_blocks(spark):
    gap = {5, 6, 900}
    rows = [(h, "otres", "A", 1.0) for i, h in enumerate(hours(1700)) if i not in gap]
    out = [(r.start_ts, r.hours) for r in windows.contiguous_runs(obs_df(spark, rows)).orderBy("start_ts").collect()]
    assert out == [(T0, 5), (T0 + dt.timedelta(hours=7), 893), (T0 + dt.timedelta(hours=901), 799)]


def test_replicate_high(spark):
    rows = [(h, "otres", "A", 100.0 if i == 5 else 1.0) for i, h in enumerate(hours(10))]
    out = windows.replicate_high(panel.fill_calendar(obs_df(spark, rows)), 50.0, ahead=2, factor=3)
    n = {r.fecha.hour: r.n for r in out.groupBy("fecha").agg(F.count("*").alias("n")).collect()}
    assert n == {h: 4 if h in (3, 4, 5) else 1 for h in range(10)}


def test_require_weather_days(spark):
    o = obs_df(spark, [(h, "otres", "A", 1.0) for h in hours(96)])
    d0 = (T0 - dt.datetime(1970, 1, 1)).days
    days = spark.createDataFrame([(d0,), (d0 + 1,), (d0 + 3,)], "day bigint")
    assert {r.fecha.day for r in align.require_weather_days(o, days, align.days_needed(24)).collect()} == {1}
    assert align.days_needed(23) == 1 and align.days_needed(24) == 2


def test_weather_leads_zero_when_days_missing(spark):
    o = obs_df(spark, [(T0, "otres", "A", 1.0), (T0 + dt.timedelta(days=1), "otres", "A", 1.0)])
    wx = spark.createDataFrame([(h, "T2", float(i)) for i, h in enumerate(hours(48))], "ts timestamp_ntz, var string, value double")
    out = align.weather_leads(o, wx, leads=24).orderBy("fecha", "lead").collect()
    assert [r.value for r in out[:24]] == [float(i) for i in range(24)] and [r.value for r in out[24:]] == [0.0] * 24


def test_match_configs(spark):
    m = spark.createDataFrame([("abc_1",), ("abc",), ("zzz",), ("bc",)], "model string")
    c = spark.createDataFrame([("abc", 2), ("c_1", 1), ("xbcx", 3), ("bc", 4)], "config string, ord int")
    assert {r.model: r.config for r in align.match_configs(m, c).collect()} == {"abc_1": "c_1", "abc": "abc", "zzz": None, "bc": "bc"}


def test_required_days(spark):
    t = spark.createDataFrame([(dt.datetime(2024, 1, 10, 20),)], "target_ts timestamp_ntz")
    out = align.required_days(t).orderBy("day_utc").collect()
    assert [r.day_utc.day for r in out] == [9, 10, 11, 12, 13] and [r.purpose for r in out] == ["historical"] * 2 + ["forecast"] * 3


def test_param_grid(spark):
    nine = ["co", "nodos", "otres", "pmdiez", "pmdoscinco", "nox", "no", "sodos", "pmco"]
    base = spark.range(1).select(F.lit(8).alias("attention_heads"), F.lit(6).alias("weather_blocks"), F.lit(6).alias("pollution_blocks"),
                                 F.lit(8).alias("auto_regresive_steps"), F.lit(2).alias("next_weather_hours"), F.array(*[F.lit(x) for x in nine]).alias("pollutants"))
    g = experiments.derived(experiments.param_grid(base, {
        "prev_pollutant_hours": F.array(F.lit(24), F.lit(36)), "bootstrap_threshold": F.array(F.lit(1.5), F.lit(2.0), F.lit(3.0)),
        "prev_weather_hours": F.array(F.lit(4), F.lit(6))})).collect()
    assert len(g) == 12 and {r.input_features for r in g} == {66} and len({r.name for r in g}) == 12


# ---- grids -----------------------------------------------------------------------------

@pytest.mark.parametrize("n,k,want", [(8, 2, [(0, 4), (4, 7)]), (8, 4, [(0, 2), (2, 4), (4, 6), (6, 7)]), (8, 3, [(0, 3), (3, 6), (6, 7)])])
def test_even_split(n, k, want):
    assert grid.even_split(n, k) == want
    assert grid.even_split(n, k, include_last=True)[-1][1] == n


def test_even_split_nearest():
    assert grid.even_split(4, 4) == [(0, 1), (1, 2), (2, 3), (3, 4)]


def cells(spark, n=4, m=5, steps=2):
    rows = [(T0 + dt.timedelta(hours=t), t, "T2", i, j, 10.0 + i, 20.0 + 2 * j, t * 100 + i * 3.0 + j * j) for t in range(steps) for i in range(n) for j in range(m)]
    return spark.createDataFrame(rows, "ts timestamp_ntz, t int, var string, i int, j int, lat double, lon double, value double")


def test_bilinear_inside_on_points_outside_and_null(spark):
    wx = cells(spark)
    la, lo = grid.axes(wx)
    a, b = grid.axis_weights(la, 9.5, 14.0, 0.5), grid.axis_weights(lo, 20.0, 29.0, 1.0)
    out = {(r.ts.hour, r.lat, r.lon): r.value for r in grid.bilinear(wx, a, b).collect()}
    assert len(out) == 2 * 9 * 9
    assert out[(0, 9.5, 20.0)] is None and out[(0, 13.5, 20.0)] is None and out[(0, 13.0, 28.0)] == 9.0 + 16.0
    assert out[(1, 11.5, 23.0)] == pytest.approx(100 + 4.5 + (1 + 4) / 2)
    hole = wx.withColumn("value", F.when((F.col("i") == 1) & (F.col("j") == 1), None).otherwise(F.col("value")))
    out = {(r.ts.hour, r.lat, r.lon): r.value for r in grid.bilinear(hole, a, b).collect()}
    assert out[(0, 11.5, 21.0)] is None and out[(0, 12.0, 21.0)] is not None


def test_crop_drops_last_cell(spark):
    wx = cells(spark, 6, 6, 1)
    la, lo = grid.axes(wx)
    got = {(r.i, r.j) for r in grid.crop(wx, (11.0, 14.0, 0.0, 99.0), la, lo).collect()}
    assert got == {(i, j) for i in (1, 2) for j in range(6)}


def test_frame_out_of_range(spark):
    wx = cells(spark)
    assert {r.t for r in grid.frame(wx, 1).collect()} == {1}
    with pytest.raises(Exception, match="out of range"):
        grid.frame(wx, 9).collect()


def test_zero_fill_and_combine(spark):
    wx = cells(spark, 2, 2, 60).filter((F.col("t") < 24) | (F.col("t") >= 48)).drop("t")
    z = grid.zero_fill_days(wx)
    assert z.count() == 60 * 4 and z.filter("is_synthetic = 1").agg(F.sum("value")).first()[0] == 0.0
    assert grid.combine_days([wx], 30).count() == 24 * 4


def test_stack_order_and_nulls(spark):
    wx = cells(spark, 2, 2, 1).withColumn("value", F.when(F.col("i") == 0, F.col("value")))
    assert one(grid.stack(wx, ["T2"])).cells == [0.0, 1.0, 0.0, 0.0]


# ---- losses ----------------------------------------------------------------------------

def test_losses(spark):
    d = spark.createDataFrame([(1.0, 0.5, 0, [0.1, 0.7, 0.2], 1), (2.0, 4.0, 1, [0.5, 0.3, 0.2], 2)], "t double, p double, m int, s array<double>, y int")
    t, p, m = F.col("t"), F.col("p"), F.col("m")
    r = d.agg(metrics.asymmetric_mse(t, p, m).alias("a"), metrics.huber(t, p).alias("h"), metrics.masked_mse(t, p, m).alias("mm"),
              metrics.masked_mse_loss(t, p, m).alias("ml"), F.avg(metrics.top_k_hit(F.col("s"), F.col("y"), 1)).alias("k1"),
              F.avg(metrics.top_k_hit(F.col("s"), F.col("y"), 3)).alias("k3"), metrics.nll(F.transform("s", lambda x: F.log(x)), F.col("y")).alias("nll")).first()
    assert (r.a, r.h, r.mm, r.ml, r.k1, r.k3) == (0.25, pytest.approx((0.125 + 1.5) / 2), 2.0, 0.125, 0.5, 1.0)
    assert r.nll == pytest.approx(-(math.log(0.7) + math.log(0.2)) / 2)
