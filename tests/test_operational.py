"""The operational plan on a small network: shared panel, faults of origins, reads of the sources."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from brisa.operators import impute, panel, vectors
from brisa.plans import operational as op
from brisa.session import settle, work_path

T0 = dt.datetime(2024, 1, 10)
SETUP = op.Setup(["S0", "S1", "S2", "S3"], ["co"], ["T2", "U10"], prev=6, steps=3, hours_back=30, min_hours=10)


@pytest.fixture(scope="module")
def sources(spark):
    obs = [(T0 + dt.timedelta(hours=h), p, f"S{s}", float((h * 7 + s * 3 + len(p)) % 50 + 1)) for h in range(120) for p in ("otres", "co") for s in range(4)
           if (h * 5 + s) % 7 and not (p == "otres" and s == 3 and h < 40)]
    wx = [(T0 + dt.timedelta(hours=h), v, i, float(h % 24 + i)) for h in range(0, 101, 6) for v in ("T2", "U10") for i in range(2)]
    paths = work_path(spark, "op-obs"), work_path(spark, "op-wx")
    spark.createDataFrame(obs, "fecha timestamp_ntz, pollutant string, id_est string, val double").write.parquet(paths[0])
    spark.createDataFrame(wx, "ts timestamp_ntz, var string, i int, value double").write.parquet(paths[1])
    return paths


def origins_of(spark, hours):
    return spark.createDataFrame([(T0 + dt.timedelta(hours=h),) for h in hours], "origin timestamp_ntz")


def params_of(spark):
    return spark.createDataFrame([("pollutant", "otres", 20.0, 10.0), ("pollutant", "co", 25.0, 5.0), ("weather", "T2", 10.0, 4.0), ("weather", "U10", 0.0, 1.0)], "kind string, name string, mean double, std double")


def test_every_origin_has_its_outcome(spark, sources):
    o, w = (spark.read.parquet(p) for p in sources)
    inputs = op.model_inputs(o, w, origins_of(spark, [4, 36, 60, 80, 94, 110]), params_of(spark), SETUP)
    got = {r.h - 24 * 19732: r.error for r in inputs.collect()}
    assert [got[h][:6] if got[h] else None for h in (4, 36, 60, 80, 94, 110)] == ["no hay", "1 colu", None, None, None, "wrf: 9"]
    fc = op.run_forecast(inputs, vectors.column_model(SETUP.columns), params_of(spark), SETUP)
    report = {r.category: (r.n_origins, r.n_values) for r in op.sweep_report(settle(op.sweep_status(fc), "status")).collect()}
    assert report == {"ok": (3, 3 * 3 * 7), "datos_insuficientes": (1, 0), "datos_faltantes": (1, 0), "errores_wrf": (1, 0)}
    rows = op.delivery_rows(fc, SETUP).collect()
    assert len(rows) == 3 * (4 + 3) and {r.fecha for r in rows} == {T0 + dt.timedelta(hours=h) for h in (60, 80, 94)}


def test_sources_are_not_read_by_the_result(spark, sources):
    o, w = (spark.read.parquet(p) for p in sources)
    inputs = op.model_inputs(o, w, origins_of(spark, [60, 66]), params_of(spark), SETUP)
    files = "".join(inputs.inputFiles())
    assert all(p.rsplit("/", 1)[1] not in files for p in sources)


def test_origins_share_one_panel(spark, sources):
    """An origin sees the same hours whether it is asked for alone or with others."""
    o, w = (spark.read.parquet(p) for p in sources)
    both = {r.h: r.x for r in op.model_inputs(o, w, origins_of(spark, [60, 75]), params_of(spark), SETUP).collect()}
    alone = op.model_inputs(o, w, origins_of(spark, [75]), params_of(spark), SETUP).first()
    assert both[alone.h] == alone.x and len(alone.x) == SETUP.prev and len(alone.x[0]) == len(SETUP.columns)


def test_trimmed_row_average_here_equals_the_joined_one(spark, sources):
    o = spark.read.parquet(sources[0])
    full = impute.start_flags(panel.fill_calendar(o))
    a = impute.fill_row_average(full, impute.row_average_trimmed(o))
    b = impute.fill_row_average_trimmed_here(full)
    key = lambda d: sorted((r.pollutant, r.id_est, r.h, None if r.val is None else round(r.val, 9), r.flag) for r in d.collect())
    assert [x for x in key(a)] == [x for x in key(b)]


def test_history_fills_from_the_years_before(spark):
    rows = [(dt.datetime(y, 3, 1, 5), "otres", "S0", float(v)) for y, v in ((2018, 99), (2019, 1), (2020, 2), (2021, 3), (2022, 4), (2023, 5))]
    past = spark.createDataFrame(rows, "fecha timestamp_ntz, pollutant string, id_est string, val double")
    full = spark.createDataFrame([(dt.datetime(2024, 3, 1, 5), "otres", "S0", None, "missing"), (dt.datetime(2024, 3, 1, 6), "otres", "S0", None, "missing")],
                                 "fecha timestamp_ntz, pollutant string, id_est string, val double, flag string").withColumn("h", F.hour("fecha").cast("long"))
    got = {r.h: (r.val, r.flag) for r in impute.fill_history(full, past).collect()}
    assert got == {5: (3.0, "historical_avg"), 6: (None, "missing")}
