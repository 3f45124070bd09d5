"""Streaming jobs over several micro-batches against their batch results."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from brisa.operators import impute, panel, windows
from brisa.session import work_path
from brisa.sources import sinks
from brisa.streaming import jobs

T0 = dt.datetime(2024, 1, 1)


def obs(spark):
    rows = [(T0 + dt.timedelta(hours=i), "otres", f"S{s}", float((i * 13 + s * 5) % 70 + 1)) for s in range(3) for i in range(120) if (i * 7 + s) % 5 > 1]
    return spark.createDataFrame(rows, "fecha timestamp_ntz, pollutant string, id_est string, val double")


def feed(spark, df, name, step, cuts, job):
    """Append the rows of each time slice and run the job after every slice."""
    folder, out, state = (work_path(spark, f"{name}-{x}") for x in ("in", "out", "state"))
    res = None
    for lo, hi in zip(cuts, cuts[1:]):
        df.filter((F.col(step) >= lo) & (F.col(step) < hi)).coalesce(1).write.mode("append").parquet(folder)
        res = job(jobs.file_stream(spark, folder, df.schema), out, state)
    return res


def test_nowcast_stream_equals_batch(spark):
    o = obs(spark)
    h = jobs.with_hour(o)
    h0 = int((T0 - dt.datetime(1970, 1, 1)).total_seconds() // 3600)
    out = feed(spark, h, "nc", "h", [h0, h0 + 30, h0 + 31, h0 + 75, h0 + 200], lambda s, o_, c: jobs.nowcast(s, o_, c))
    full = windows.nowcast12(panel.fill_calendar(o)).filter(F.col("val").isNotNull())
    want = {(r.id_est, r.h): r.nowcast for r in full.collect()}
    got = {(r.id_est, r.h): r.nowcast for r in out.collect()}
    assert got.keys() == want.keys()
    for k, x in want.items():
        assert got[k] == (None if x is None else pytest.approx(x))


def test_nowcast_state_sees_late_rows(spark):
    o = jobs.with_hour(obs(spark)).filter("id_est = 'S0'")
    h0 = o.agg(F.min("h")).first()[0]
    late = h0 + 20
    folder, out, state = (work_path(spark, f"late-{x}") for x in ("in", "out", "state"))
    row = o.filter(F.col("h") >= late).orderBy("h").limit(1).first()
    for part in (o.filter((F.col("h") <= h0 + 25) & (F.col("h") != row.h)), o.filter(F.col("h") == row.h)):
        part.coalesce(1).write.mode("append").parquet(folder)
        res = jobs.nowcast(jobs.file_stream(spark, folder, o.schema), out, state)
    full = windows.nowcast12(panel.fill_calendar(obs(spark).filter("id_est = 'S0'"))).filter(F.col("h") == row.h).first().nowcast
    assert res.filter(F.col("h") == row.h).first().nowcast == pytest.approx(full)


def test_persistence_stream_equals_batch(spark):
    o = obs(spark)
    h = jobs.with_hour(o)
    h0 = h.agg(F.min("h")).first()[0]
    out = feed(spark, h, "pf", "h", [h0, h0 + 40, h0 + 41, h0 + 200], lambda s, o_, c: jobs.persistence(s, o_, c))
    full = impute.fill_persistence_chain(impute.start_flags(panel.fill_calendar(o)))
    last = o.groupBy("id_est").agg(F.max("fecha").alias("last"))
    want = full.join(last, "id_est").filter((F.col("fecha") <= F.col("last")) & F.col("val").isNotNull())
    assert {(r.id_est, r.h, r.val, r.flag) for r in out.collect()} == {(r.id_est, r.h, r.val, r.flag) for r in want.collect()}


@pytest.mark.parametrize("job", ["nowcast", "persistence"])
def test_any_split_and_order_gives_the_batch_result(spark, job):
    o = jobs.with_hour(obs(spark))
    folder = work_path(spark, "mixed")
    o.withColumn("f", F.pmod(F.xxhash64("h", "id_est"), F.lit(5))).repartition(5, "f").drop("f").write.parquet(folder)
    run = getattr(jobs, job)
    one = run(jobs.file_stream(spark, folder, o.schema), work_path(spark, "one"), work_path(spark, "one-state"))
    many = run(jobs.file_stream(spark, folder, o.schema, files_per_batch=1), work_path(spark, "many"), work_path(spark, "many-state"))
    key = lambda r: (r.id_est, r.h)
    assert sorted(map(tuple, one.collect()), key=str) == sorted(map(tuple, many.collect()), key=str)
    assert {key(r) for r in o.collect()} <= {key(r) for r in many.collect()}


def test_later_hours_of_a_day_do_not_wipe_earlier_ones(spark):
    path = work_path(spark, "patch")
    rows = lambda xs: spark.createDataFrame(xs, "k int, month int, a double, b double")
    sinks.upsert_table(spark, path, rows([(1, 1, 1.0, None), (2, 1, 2.0, 5.0)]), ["k"], "month", patch=True)
    sinks.upsert_table(spark, path, rows([(1, 1, None, 3.0), (2, 1, 7.0, None)]), ["k"], "month", patch=True)
    assert sorted((r.k, r.a, r.b) for r in spark.read.parquet(path).collect()) == [(1, 1.0, 3.0), (2, 7.0, 5.0)]


def test_deliver_is_idempotent_and_replaces(spark):
    path = work_path(spark, "up")

    def rows(xs):
        return spark.createDataFrame(xs, "k int, month int, v double")

    sinks.upsert_table(spark, path, rows([(1, 1, 1.0), (2, 1, 2.0), (3, 2, 3.0)]), ["k"], "month")
    for _ in range(2):
        sinks.upsert_table(spark, path, rows([(2, 1, 20.0), (4, 3, 4.0)]), ["k"], "month")
    assert sorted((r.k, r.v) for r in spark.read.parquet(path).collect()) == [(1, 1.0), (2, 20.0), (3, 3.0), (4, 4.0)]


def test_ingest_drops_copies_and_late_rows_go_to_corrections(spark):
    def rows(xs):
        return spark.createDataFrame([(T0 + dt.timedelta(hours=h), s) for h, s in xs], "fecha timestamp, id_est string")

    folder, out, state = (work_path(spark, f"in-{x}") for x in ("in", "out", "state"))
    for part in (rows([(0, "a"), (0, "a"), (30, "a")]), rows([(1, "a"), (29, "b"), (30, "a")])):
        part.coalesce(1).write.mode("append").parquet(folder)
        done = jobs.run_available(jobs.ingest(jobs.file_stream(spark, folder, part.schema), ["fecha", "id_est"], "fecha"), out, state)
    got = sorted(((r.fecha - T0).total_seconds() / 3600, r.id_est) for r in done.collect())
    assert got == [(0, "a"), (29, "b"), (30, "a")]
    late = jobs.late_rows(spark.read.parquet(folder), done, ["fecha", "id_est"]).collect()
    assert [((r.fecha - T0).total_seconds() / 3600, r.id_est) for r in late] == [(1, "a")]


def events(spark, rows):
    return spark.createDataFrame([(i, T0 + dt.timedelta(minutes=m), s, float(v)) for i, (m, s, v) in enumerate(rows)], "event_id int, ts timestamp, id_est string, value double")


def files_of(spark, parts):
    """One file for each part, read one for each micro-batch in this order."""
    folder = work_path(spark, "parts")
    for p in parts:
        p.coalesce(1).write.mode("append").parquet(folder)
    return jobs.file_stream(spark, folder, parts[0].schema, files_per_batch=1)


JOBS = {"hourly": (lambda e: jobs.hourly_stats(e, ["id_est"], "ts", "value"), jobs.keep_windows, (1,)),
        "sliding": (lambda e: jobs.sliding_max(e, ["id_est"], "ts", "value"), jobs.keep_windows, (24,)),
        "sessions": (lambda e: jobs.high_sessions(e, ["id_est"], "ts", "value", 5.0), jobs.keep_sessions, ())}


@pytest.mark.parametrize("name", list(JOBS))
def test_late_readings_correct_closed_windows(spark, name):
    job, run, more = JOBS[name]
    # months apart, out of order; minute 45 joins the sessions around 0 and 90; the last part repeats the first
    rows = [(0, "a", 9), (90, "a", 7), (40_000, "b", 8), (100_000, "a", 6), (45, "a", 12), (30_010, "a", 3), (40_050, "b", 6), (40_100, "b", 2), (5, "a", 4), (39_950, "b", 30)]
    e = events(spark, rows)
    parts = [e.filter(F.col("event_id").isin(x)) for x in ([0, 1, 2, 7], [3, 5, 9], [4, 6, 8, 0])]
    got = run(files_of(spark, parts), work_path(spark, name), work_path(spark, f"{name}-state"), job, "event_id", "ts", ["id_est"], *more)
    want = job(e)
    assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("job", ["nowcast", "persistence"])
def test_two_readings_of_an_hour_in_any_order(spark, job):
    rows = [("otres", "S0", h, str(i), v) for i, (h, v) in enumerate([(100, 5.0), (100, 9.0), (101, 4.0), (102, 3.0), (1000, 2.0), (101, 8.0), (126, 1.0), (1001, 6.0), (1002, 7.0)])]
    d = spark.createDataFrame(rows, "pollutant string, id_est string, h bigint, k string, val double")
    orders = [[[0, 2, 3, 4], [1, 5, 6, 7, 8]], [[7, 8, 1, 5], [6, 0], [0, 2, 3, 4]]]
    out = []
    for n, order in enumerate(orders):
        parts = [d.filter(F.col("k").isin([str(i) for i in x])) for x in order]
        out.append(sorted(map(str, getattr(jobs, job)(files_of(spark, parts), work_path(spark, f"{job}{n}"), work_path(spark, f"{job}{n}-state")).collect())))
    assert out[0] == out[1] and len(out[0]) > 3
    if job == "persistence":
        assert any("h=100, val=7.0" in x for x in out[0])


def test_a_batch_reads_only_partitions_it_can_change(spark):
    path, state = work_path(spark, "pruned"), work_path(spark, "pruned-state")
    rows = [("otres", "S0", h, "k", float(h % 7)) for h in range(0, 744 * 6, 5)]
    d = spark.createDataFrame(rows, "pollutant string, id_est string, h bigint, k string, val double")
    folder = work_path(spark, "pruned-in")
    d.coalesce(1).write.parquet(folder)
    jobs.nowcast(jobs.file_stream(spark, folder, d.schema), path, state)
    import glob
    import os
    stamp = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/*/part=*/*.parquet")}
    d.filter("h = 800").withColumn("k", F.lit("late")).withColumn("val", F.lit(50.0)).coalesce(1).write.mode("append").parquet(folder)
    jobs.nowcast(jobs.file_stream(spark, folder, d.schema), path, state)
    kept = {f for f in glob.glob(f"{path}/*/part=*/*.parquet") if f in stamp}
    assert {f for f in stamp if "part=1/" in f}.isdisjoint(kept) and len(kept) == len([f for f in stamp if "part=1/" not in f])
