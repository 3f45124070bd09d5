"""Streaming jobs over the event files, checked against batch SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from brisa.catalog import views as v
from brisa.catalog.base import query, r, rounded
from brisa.functions import clock
from brisa.session import work_path
from brisa.sources import sinks
from brisa.streaming import jobs

STATION_SQL = "concat('S', lpad(cast(user_id % 12 as varchar), 2, '0'))"


def _events(spark, d):
    schema = v.table(spark, d, "events").schema
    return _shape(jobs.file_stream(spark, d, schema, "events.parquet"))


def _batch(spark, d):
    return _shape(v.table(spark, d, "events"))


def _shape(s):
    return s.select("event_id", F.col("ts").cast("timestamp").alias("ts"), F.concat(F.lit("S"), F.lpad((F.col("user_id") % 12).cast("string"), 2, "0")).alias("id_est"),
                    "event_type", "value")


def _ntz(df, *cols):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


def _run(spark, df, name, partition=()):
    return jobs.run_available(df, work_path(spark, name), work_path(spark, f"{name}-state"), partition)


@query("stream_ingest", f"select {STATION_SQL} as id_est, count(distinct event_id) as n, round(sum(value) @6) as total, max(value) as top from events group by 1")
def stream_ingest(spark, d):
    out = _run(spark, jobs.ingest(_events(spark, d), ["event_id"], "ts"), "ingest")
    return out.groupBy("id_est").agg(F.count(F.lit(1)).alias("n"), r(F.sum("value")).alias("total"), F.max("value").alias("top"))


def _files(spark, df, name, hash_of):
    """Four files whose rows are mixed in time, read one for each micro-batch."""
    path = work_path(spark, name)
    df.withColumn("_f", F.pmod(F.xxhash64(*hash_of), F.lit(4))).repartition(4, "_f").drop("_f").write.parquet(path)
    return jobs.file_stream(spark, path, spark.read.parquet(path).schema, files_per_batch=1)


def _kept(spark, d, name, run, job, *args):
    return run(_files(spark, _batch(spark, d), f"events-{name}", ["event_id"]), work_path(spark, name), work_path(spark, f"{name}-state"), job, "event_id", "ts", ["id_est"], *args)


@query("stream_hourly_stats", f"""select date_trunc('hour', ts) as hour, {STATION_SQL} as id_est, count(value) as n, round(avg(value) @6) as mean, min(value) as min, max(value) as max
from events group by 1, 2""")
def stream_hourly_stats(spark, d):
    """Four files out of time order: hours that were given out are corrected by what comes later."""
    out = _kept(spark, d, "hourly", jobs.keep_windows, lambda e: jobs.hourly_stats(e, ["id_est"], "ts", "value"), 1)
    return rounded(_ntz(out, "hour"), "mean")


@query("stream_sliding_max", f"""select date_trunc('hour', ts) - to_hours(k) as start, date_trunc('hour', ts) - to_hours(k) + interval 24 hour as "end", {STATION_SQL} as id_est, max(value) as max
from events, generate_series(0, 23) g(k) group by 1, 2, 3""")
def stream_sliding_max(spark, d):
    out = _kept(spark, d, "sliding", jobs.keep_windows, lambda e: jobs.sliding_max(e, ["id_est"], "ts", "value"), 24)
    return _ntz(out, "start", "end")


@query("stream_sessions", f"""with e as (select ts, {STATION_SQL} as id_est, value from events where value > 120),
g as (select *, case when ts - lag(ts) over w <= interval 1 hour then 0 else 1 end as new from e window w as (partition by id_est order by ts, value)),
s as (select *, sum(new) over (partition by id_est order by ts, value rows unbounded preceding) as sid from g)
select id_est, min(ts) as start, max(ts) + interval 1 hour as "end", count(value) as n, max(value) as top from s group by id_est, sid""")
def stream_sessions(spark, d):
    """Four files out of time order: a later reading may join two sessions that were given out."""
    out = _kept(spark, d, "sessions", jobs.keep_sessions, lambda e: jobs.high_sessions(e, ["id_est"], "ts", "value", 120.0))
    return _ntz(out, "start", "end")


@query("stream_windows_live", f"""select date_trunc('hour', ts) as hour, {STATION_SQL} as id_est, count(value) as n, round(avg(value) @6) as mean, min(value) as min, max(value) as max
from events group by 1, 2""")
def stream_windows_live(spark, d):
    """The same hours from Spark's own windows with a watermark, with those that a run leaves open."""
    job = lambda e: jobs.hourly_stats(e, ["id_est"], "ts", "value")
    out = jobs.with_open(_run(spark, job(_events(spark, d)), "hourly-live"), _batch(spark, d), job, "ts", F.col("hour") + F.expr("interval 1 hour"), "1 hour")
    return rounded(_ntz(out, "hour"), "mean")


def _obs_stream(spark, d, name):
    """Single readings in four files: hours, and the readings of one hour, are spread over the files."""
    e = _batch(spark, d).select(F.lit("otres").alias("pollutant"), "id_est", F.col("ts").alias("fecha"), F.col("value").alias("val"), "event_id")
    return _files(spark, jobs.with_hour(e, "event_id"), name, ["k"])


NOWCAST_SQL = f"""with {v.OBS12_FULL},
a as (select fecha, id_est, val, list_filter(list(val) over (partition by id_est order by fecha rows between 11 preceding and current row), lambda x: x is not null) as vals from full_panel),
b as (select *, case when len(vals) >= 3 then greatest(round_even(case when list_max(vals) = 0 then 0 else list_min(vals) / list_max(vals) end, 2), 0.5) end as w from a where val is not null)
select fecha, id_est, round(case when w is not null then list_sum(list_transform(vals, lambda x, i: x * power(w, i - 1))) / list_sum(list_transform(vals, lambda x, i: power(w, i - 1))) * 0.714 end @6) as nowcast from b"""


@query("stream_nowcast", NOWCAST_SQL)
def stream_nowcast(spark, d):
    out = jobs.nowcast(_obs_stream(spark, d, "obs-nowcast"), work_path(spark, "nowcast"), work_path(spark, "nowcast-state"))
    return out.select(clock.hour_stamp(F.col("h")).alias("fecha"), "id_est", r("nowcast").alias("nowcast"))


@query("stream_nowcast_state", NOWCAST_SQL)
def stream_nowcast_state(spark, d):
    """Four files in order of time, one for each micro-batch; a series' last hours are kept as state."""
    from brisa.streaming import state
    e = _batch(spark, d).select(F.lit("otres").alias("pollutant"), "id_est", "ts", F.floor(F.unix_seconds("ts") / 3600).alias("h"), F.col("value").alias("val"))
    path = work_path(spark, "in-time")
    day = F.dayofmonth("ts")
    for n in range(4):
        e.filter((day > 8 * n) & (day <= 8 * n + 8)).coalesce(1).write.mode("append").parquet(path)
    stream = jobs.file_stream(spark, path, e.schema, files_per_batch=1)
    out = state.nowcast_state(stream, work_path(spark, "nowcast-live"), work_path(spark, "nowcast-live-state"))
    return out.select(clock.hour_stamp(F.col("h")).alias("fecha"), "id_est", r("nowcast").alias("nowcast"))


@query("stream_persistence", f"""with {v.OBS12_FULL}, p as (select *, last_value(val ignore nulls) over (partition by id_est, hour(fecha) order by fecha rows between unbounded preceding and 1 preceding) as prev,
  max(case when val is not null then fecha end) over (partition by id_est) as last_seen from full_panel)
select fecha, id_est, round(coalesce(val, prev) @6) as val, case when val is not null then 'none' else 'last_day_same_hour' end as flag from p where coalesce(val, prev) is not null and fecha <= last_seen""")
def stream_persistence(spark, d):
    out = jobs.persistence(_obs_stream(spark, d, "obs-fill"), work_path(spark, "fill"), work_path(spark, "fill-state"))
    return out.select(clock.hour_stamp(F.col("h")).alias("fecha"), "id_est", r("val").alias("val"), "flag")


@query("stream_deliver", f"""with {v.OBS12}, f as (select date_trunc('day', fecha) as origin, id_est, hour(fecha) + 1 as horizon, val as value from obs12)
select origin as fecha, id_est, {', '.join(f"round(max(value + 1e-9) filter (horizon = {h}), 2) as hour_p{h:02d}" for h in range(1, 25))} from f group by 1, 2""")
def stream_deliver(spark, d):
    stations = [f"S{k:02d}" for k in range(12)]

    def make(batch):
        f = batch.select(F.timestamp_seconds(F.floor(F.col("h") / 24) * 86400).cast("timestamp_ntz").alias("origin"), "pollutant", "id_est",
                         (F.col("h") % 24 + 1).alias("horizon"), (F.col("val") + 1e-9).alias("value"))
        return sinks.deliver_stations(f, stations).withColumn("month", F.month("fecha"))

    obs = _files(spark, jobs.with_hour(v.obs12(spark, d)), "obs-deliver", ["h", "id_est"])
    out = jobs.deliver(obs, make, work_path(spark, "delivered"), work_path(spark, "deliver-state"), ["fecha", "id_est"], "month")
    return out.select("fecha", "id_est", *[f"hour_p{h:02d}" for h in range(1, 25)])


@query("stream_late", """select event_id, ts from events where event_type = 'error' and ts <= (select max(ts) - interval 6 hour from events where event_type <> 'error')""")
def stream_late(spark, d):
    raw, out, state = work_path(spark, "arrivals"), work_path(spark, "on-time"), work_path(spark, "on-time-state")
    e = v.table(spark, d, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type", "value")
    for late in (False, True):
        e.filter((F.col("event_type") == "error") == late).write.mode("append").parquet(raw)
        done = jobs.run_available(jobs.ingest(jobs.file_stream(spark, raw, e.schema), ["event_id"], "ts"), out, state)
    return _ntz(jobs.late_rows(spark.read.parquet(raw), done, ["event_id"]).select("event_id", "ts"), "ts")
