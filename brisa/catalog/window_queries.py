"""Window features, samples, roll-forward, splits and vectors."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from brisa.catalog import views as v
from brisa.catalog.base import query, r, rounded
from brisa.functions import clock
from brisa.operators import forecast, impute, panel, prep, stats, windows


def full12(spark, d):
    return panel.fill_calendar(v.obs12(spark, d))


LAGS = ", ".join(f"round(lag(val, {k}) over w @6) as minus_{k:02d}" for k in range(1, 25))
LEADS = ", ".join(f"round(lead(val, {k}) over w @6) as plus_{k:02d}" for k in range(1, 25))
W = "window w as (partition by pollutant, id_est order by fecha)"


@query("lag_features", f"with {v.OBS12_FULL} select fecha, id_est, {LAGS} from full_panel {W}")
def lag_features(spark, d):
    f = windows.lag_features(full12(spark, d))
    return rounded(f.select("fecha", "id_est", *[f"minus_{k:02d}" for k in range(1, 25)]), *[f"minus_{k:02d}" for k in range(1, 25)])


@query("lead_targets", f"with {v.OBS12_FULL} select fecha, id_est, {LEADS} from full_panel {W}")
def lead_targets(spark, d):
    f = windows.lead_targets(full12(spark, d))
    return rounded(f.select("fecha", "id_est", *[f"plus_{k:02d}" for k in range(1, 25)]), *[f"plus_{k:02d}" for k in range(1, 25)])


@query("rolling_all", f"""with {v.OBS_ALL_FULL} select fecha, id_est,
  round(avg(val) over (partition by pollutant, id_est order by fecha rows between 1 preceding and 1 following) @6) as rolling from all_panel""")
def rolling_all(spark, d):
    return rounded(windows.rolling_mean(panel.fill_calendar(v.obs_all(spark, d))).select("fecha", "id_est", "rolling"), "rolling")


@query("rolling_mean3", f"""with {v.OBS12_FULL} select fecha, id_est,
  round(avg(val) over (partition by pollutant, id_est order by fecha rows between 1 preceding and 1 following) @6) as rolling from full_panel""")
def rolling_mean3(spark, d):
    return windows.rolling_mean(full12(spark, d)).select("fecha", "id_est", r("rolling").alias("rolling"))


@query("nowcast12", f"""with {v.OBS12_FULL},
a as (select fecha, id_est, list_filter(list(val) over (partition by pollutant, id_est order by fecha rows between 11 preceding and current row), lambda x: x is not null) as vals from full_panel),
b as (select *, case when len(vals) >= 3 then greatest(round_even(case when list_max(vals) = 0 then 0 else list_min(vals) / list_max(vals) end, 2), 0.5) end as w from a),
c as (select fecha, id_est, case when w is not null then
        list_sum(list_transform(vals, lambda x, i: x * power(w, i - 1))) / list_sum(list_transform(vals, lambda x, i: power(w, i - 1))) * 0.714 end as nc from b)
select fecha, id_est, round(nc @6) as nowcast, case when nc is null then null when nc <= 45 then 'Buena' when nc <= 60 then 'Aceptable' when nc <= 132 then 'Mala'
  when nc <= 213 then 'Muy Mala' else 'Extremadamente Mala' end as category from c""")
def nowcast12(spark, d):
    return windows.nowcast12(full12(spark, d)).select("fecha", "id_est", r("nowcast").alias("nowcast"), "category")


RAIN_SQL = f"""{v.WX}, acc as (select t // 24 as file, t, i, j, sum(case when var = 'RAINC' then abs(value) else 0 end) as c, sum(case when var = 'RAINNC' then value else 0 end) as n
  from wx where var in ('RAINC', 'RAINNC') group by 1, 2, 3, 4),
run as (select file, t, i, j, sum(c + n) over (partition by file, i, j order by t) as total from acc)"""


def rain_total(spark, d):
    w = v.wx(spark, d).filter(F.col("var").isin("RAINC", "RAINNC")).withColumn("file", F.floor(F.col("t") / 24))
    x = F.when(F.col("var") == "RAINC", F.abs("value")).otherwise(F.col("value"))
    from pyspark.sql import Window
    return (w.groupBy("file", "t", "i", "j").agg(F.sum(x).alias("x"))
            .withColumn("total", F.sum("x").over(Window.partitionBy("file", "i", "j").orderBy("t").rowsBetween(Window.unboundedPreceding, 0))))


@query("rain_deaccumulate", f"""with {RAIN_SQL} select t, i, j, round(greatest(coalesce(total - lag(total) over (partition by file, i, j order by t), 0), 0) @6) as rain from run""")
def rain_deaccumulate(spark, d):
    return windows.rain_deaccumulate(rain_total(spark, d), ["file", "i", "j"], "t", "total").select("t", "i", "j", r("rain").alias("rain"))


@query("rain_forward_diff", f"""with {RAIN_SQL} select t, i, j, round(greatest(coalesce(lead(total) over (partition by file, i, j order by t) - total, total), 0) @6) as rain from run""")
def rain_forward_diff(spark, d):
    return windows.rain_forward_diff(rain_total(spark, d), ["file", "i", "j"], "t", "total").select("t", "i", "j", r("rain").alias("rain"))


@query("contiguous_runs", f"""with {v.OBS12}, g as (select id_est, fecha, fecha - to_hours(row_number() over (partition by id_est order by fecha)) as grp from obs12)
select 'otres' as pollutant, id_est, min(fecha) as start_ts, max(fecha) as end_ts, count(*) as hours from g group by id_est, grp having count(*) >= 3""")
def contiguous_runs(spark, d):
    return windows.contiguous_runs(v.obs12(spark, d), 3)


FILLED_SQL = f"""{v.OBS12_FULL},
filled as (select pollutant, id_est, fecha, coalesce(val, last_value(val ignore nulls) over (partition by pollutant, id_est, hour(fecha) order by fecha
             rows between unbounded preceding and 1 preceding), 50) as val, case when val is null then 1 else 0 end as m from full_panel),
pos as (select *, datediff('hour', (select min(fecha) from filled), fecha) as i, datediff('hour', (select min(fecha) from filled), (select max(fecha) from filled)) + 1 as n from filled)"""


def filled12(spark, d):
    f = impute.fill_persistence_chain(impute.start_flags(full12(spark, d)))
    return f.withColumn("val", F.coalesce("val", F.lit(50.0)))


def wsum(col):
    """Position-weighted sum of an array."""
    return F.aggregate(F.transform(col, lambda x, i: x * (i + 1)), F.lit(0.0), lambda a, x: a + x)


SAMPLES_SQL = f"""{FILLED_SQL},
samples as (select pollutant, id_est, fecha as origin, i, n, list(val) over (partition by pollutant, id_est order by fecha rows between 24 preceding and 1 preceding) as x,
       list(val) over (partition by pollutant, id_est order by fecha rows between current row and 7 following) as y,
       list(m) over (partition by pollutant, id_est order by fecha rows between current row and 7 following) as mask from pos)"""


@query("sample_windows", f"""with {SAMPLES_SQL}, {v.WX}, mw as (select ts, var, avg(value) as value from wx group by 1, 2),
ww as (select ts, var, list(value) over (partition by var order by ts range between interval 4 hour preceding and interval 9 hour following) as weather from mw),
wz as (select ts as origin, count(*) as n_weather, sum(list_sum(list_transform(weather, lambda v, k: v * k))) as w from ww where len(weather) = 14 group by 1)
select id_est, s.origin, len(x) as x_len, round(list_sum(list_transform(x, lambda v, k: v * k)) @6) as x_sum, round(list_sum(list_transform(y, lambda v, k: v * k)) @6) as y_sum,
       cast(list_sum(mask) as bigint) as mask_sum, n_weather::double as n_weather, round(w @6) as weather_sum
from samples s left join wz using (origin) where i >= 24 and i < n - 10""")
def sample_windows(spark, d):
    s = windows.sample_windows(filled12(spark, d))
    m = v.wx(spark, d).groupBy(clock.hour_index(F.col("ts")).alias("h"), "var").agg(F.avg("value").alias("value"))
    w = windows.weather_windows(m).groupBy("h").agg(F.count(F.lit(1)).alias("n_weather"), F.sum(wsum("weather")).alias("w"))
    mask = F.aggregate("mask", F.lit(0).cast("bigint"), lambda a, x: a + x)
    return s.join(w, "h", "left").select("id_est", "origin", F.size("x").alias("x_len"), r(wsum("x")).alias("x_sum"), r(wsum("y")).alias("y_sum"),
                                         mask.alias("mask_sum"), F.col("n_weather").cast("double").alias("n_weather"), r("w").alias("weather_sum"))


@query("weather_step_window", f"""with {v.WX}, mw as (select ts, var, avg(value) as value from wx group by 1, 2),
ww as (select ts, var, list(value) over (partition by var order by ts range between interval 4 hour preceding and interval 9 hour following) as weather from mw)
select var, ts as origin, cast(s as int) as step, round(list_sum(list_transform(weather[s + 1 : s + 7], lambda v, k: v * k)) @6) as window_sum
from ww, generate_series(0, 7) g(s) where len(weather) = 14""")
def weather_step_window(spark, d):
    m = v.wx(spark, d).groupBy(clock.hour_index(F.col("ts")).alias("h"), "var").agg(F.avg("value").alias("value"))
    st = windows.weather_steps(windows.weather_windows(m))
    return st.select("var", clock.hour_stamp(F.col("h")).alias("origin"), "step", r(wsum("window")).alias("window_sum"))


@query("input_vector_stats", f"""with {v.OBS12_FULL}, {v.WX},
f as (select fecha, 'pollution_cont_' || pollutant || '_' || id_est as s, last_value(val) over w as l, avg(val) over w as a, stddev_samp(val) over w as sd, min(val) over w as mn, max(val) over w as mx
      from full_panel window w as (partition by pollutant, id_est order by fecha rows between 24 preceding and 1 preceding)),
u as (select fecha, s as name, l as value from f union all select fecha, s || '_mean', a from f union all select fecha, s || '_std', sd from f
      union all select fecha, s || '_min', mn from f union all select fecha, s || '_max', mx from f
      union all select ts + to_hours(4 - k), printf('weather_%s_t%d_lat%.2f_lon%.2f', var, k, lat, lon), value from wx, generate_series(0, 6) g(k)
        where ts + to_hours(4 - k) in (select fecha from full_panel))
select fecha, count(*) as n_names, count(value) as n_values, round(sum(value) @6) as total, round(sum(value * (ascii(right(name, 1)) + length(name))) @4) as weighted from u group by 1""")
def input_vector_stats(spark, d):
    x = windows.input_vectors(full12(spark, d), v.wx(spark, d))
    weight = F.ascii(F.right("name", F.lit(1))) + F.length("name")
    return x.groupBy(clock.hour_stamp(F.col("h")).alias("fecha")).agg(
        F.count(F.lit(1)).alias("n_names"), F.count("value").alias("n_values"), r(F.sum("value")).alias("total"),
        r(F.sum(F.col("value") * weight), 4).alias("weighted"))


@query("autoregressive", f"""with recursive {SAMPLES_SQL},
roll(id_est, origin, x, horizon, value) as (
  select id_est, origin, x, 0, cast(null as double) from samples where i >= 24 and i < n - 10
  union all
  select id_est, origin, list_append(x[2:24], 0.6 * x[24] + 0.3 * x[1] + 4.0), horizon + 1, 0.6 * x[24] + 0.3 * x[1] + 4.0 from roll where horizon < 24)
select id_est, origin, horizon, round(value @6) as value from roll where horizon > 0""")
def autoregressive(spark, d):
    s = windows.sample_windows(filled12(spark, d))
    f = forecast.roll_forward(s, forecast.linear_model())
    return f.select("id_est", clock.hour_stamp(F.col("h")).alias("origin"), "horizon", r("value").alias("value"))


@query("sweep_plan", f"""with {v.OBS12}, o as (select unnest(generate_series(timestamp '2024-01-01', (select max(fecha) from obs12), interval 6 hour)) as origin),
hrs as (select distinct fecha from obs12 where val is not null),
val as (select origin, count(*) as history_hours from o join hrs on fecha >= origin - interval 60 hour and fecha < origin where year(origin) >= 2020 group by 1 having count(*) >= 15)
select origin, history_hours from val where origin not in (select fecha from obs12 where id_est = 'S00' and fecha < timestamp '2024-01-10')""")
def sweep_plan(spark, d):
    from brisa.operators import align
    o = v.obs12(spark, d)
    ok = panel.valid_origins(forecast.origins_at(o, "6H").select("origin"), o)
    done = o.filter((F.col("id_est") == "S00") & (F.col("fecha") < F.lit("2024-01-10").cast("timestamp_ntz"))).select(F.col("fecha").alias("origin"))
    return align.remaining_origins(ok, done)


SERIES12 = [f"S{k:02d}" for k in range(12)]


@query("sweep_wide", f"""with recursive {SAMPLES_SQL},
roll(id_est, origin, x, horizon, value) as (
  select id_est, origin, x, 0, cast(null as double) from samples where i >= 24 and i < n - 10 and hour(origin) % 6 = 0
  union all
  select id_est, origin, list_append(x[2:24], 0.6 * x[24] + 0.3 * x[1] + 4.0), horizon + 1, 0.6 * x[24] + 0.3 * x[1] + 4.0 from roll where horizon < 24)
select origin, {', '.join(f"round(max(value) filter (id_est = '{s}' and horizon = {h}) @6) as {s}_h_plus_{h:02d}" for s in SERIES12 for h in range(1, 25))}
from roll where horizon > 0 group by 1""")
def sweep_wide(spark, d):
    s = windows.sample_windows(filled12(spark, d))
    s = s.join(forecast.origins_at(v.obs12(spark, d), "6H").select("h"), "h", "left_semi")
    f = forecast.roll_forward(s, forecast.linear_model()).select(clock.hour_stamp(F.col("h")).alias("origin"), "horizon", F.col("id_est").alias("series"), "value")
    w = forecast.wide_forecast(f, SERIES12)
    return rounded(w)


@query("replicate_high", f"""with {v.OBS12_FULL}, t as (select *, max(val) over (partition by pollutant, id_est order by fecha rows between current row and 3 following) as top from full_panel)
select fecha, id_est, cast(k as int) as copy, round(val @6) as val from t, generate_series(1, 3) g(k) where k = 1 or top > 120""")
def replicate_high(spark, d):
    x = windows.replicate_high(full12(spark, d), 120.0, ahead=3, factor=2)
    return x.select("fecha", "id_est", "copy", r("val").alias("val"))


@query("tail_split", f"""with {v.FC}, g as (select model, predicted_hour, ts, station, target, pred, row_number() over (order by ts, model, predicted_hour, station, target, pred) as pos, count(*) over () as n from fc)
select model, case when pos > n - floor(n * 0.1) then 'val' else 'train' end as split, count(*) as n, min(ts) as first_ts, max(ts) as last_ts, round(sum(target) @4) as total from g group by 1, 2""")
def tail_split(spark, d):
    s = prep.tail_split(v.fc_long(spark, d), 0.1, ["ts", "model", "predicted_hour", "station", "target", "pred"])
    return s.groupBy("model", "split").agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), r(F.sum("target"), 4).alias("total"))


@query("random_split")
def random_split(spark, d):
    return prep.random_split(v.obs12(spark, d), ["fecha", "id_est"])


@query("random_split_sizes", f"""with {v.OBS12}, n as (select count(*) as n from obs12)
select s.split, cast(case s.split when 'train' then n - 2 * ceil(n * 0.1::double) else ceil(n * 0.1::double) end as bigint) as size, cast(case s.split when 'train' then n - 2 * ceil(n * 0.1::double) else ceil(n * 0.1::double) end as bigint) as ids
from n, (values ('train'), ('val'), ('test')) s(split)""")
def random_split_sizes(spark, d):
    s = prep.random_split(v.obs12(spark, d), ["fecha", "id_est"])
    return s.groupBy("split").agg(F.count(F.lit(1)).alias("size"), F.count_distinct("fecha", "id_est").alias("ids"))


def _weighted(spark, d):
    o = v.obs12(spark, d)
    return prep.event_weights(o.select("fecha").distinct(), stats.high_events(o))


@query("weighted_resample")
def weighted_resample(spark, d):
    return prep.weighted_resample(_weighted(spark, d))


@query("weighted_resample_checks", f"""with {v.OBS12} select count(distinct fecha) as draws, 1 as known, 1 as heavy_share from obs12""")
def weighted_resample_checks(spark, d):
    """As many draws as hours, only hours of the table, and heavy hours within five deviations of their share."""
    w = _weighted(spark, d)
    got = prep.weighted_resample(w)
    both = got.select("fecha", "weight", F.lit(1).alias("drawn"), F.lit(0).alias("listed")).unionByName(w.select("fecha", "weight", F.lit(0).alias("drawn"), F.lit(1).alias("listed")))
    per = both.groupBy("fecha").agg(F.sum("drawn").alias("drawn"), F.max("listed").alias("listed"), F.max("weight").alias("w"))
    heavy = F.col("w") > 1
    s = per.agg(F.sum("drawn").alias("draws"), F.min(F.when(F.col("drawn") > 0, F.col("listed"))).alias("known"), F.sum("listed").alias("n"),
                F.sum(F.when(heavy, F.col("drawn")).otherwise(0)).alias("heavy"), (F.sum(F.when(heavy, F.col("w")).otherwise(0)) / F.sum("w")).alias("p"))
    near = F.abs(F.col("heavy") - F.col("n") * F.col("p")) <= 5 * F.sqrt(F.col("n") * F.col("p") * (1 - F.col("p"))) + 1
    return s.select("draws", "known", near.cast("int").alias("heavy_share"))


@query("sampling_info", f"""with {v.OBS12}, t as (select avg(val) + 2 * stddev_pop(val) as thr from obs12),
w as (select fecha, case when max(val) > max(thr) then 20 else 1 end as weight from obs12, t group by 1)
select count(*) as total_samples, cast(count_if(weight > 1) as bigint) as high_events, min(weight) as min_weight, max(weight) as max_weight, sum(weight)::bigint as total_weight,
       2.0::double as threshold, 20 as repetition from w""")
def sampling_info(spark, d):
    return prep.sampling_info(_weighted(spark, d), 2.0, 20)


def _cyc_sql(ts="fecha"):
    t = f"epoch({ts})"
    half, full = [], []
    for n, p in clock.CYCLES.items():
        half += [(f"half_sin_{n}", f"abs(sin({t} * ({math.pi!r} / {p})))"), (f"half_cos_{n}", f"abs(cos({t} * ({math.pi!r} / {p})))")]
        full += [(f"sin_{n}", f"sin({t} * ({2 * math.pi!r} / {p}))"), (f"cos_{n}", f"cos({t} * ({2 * math.pi!r} / {p}))")]
    return half + full


OTHERS = ["co", "no", "nodos", "nox"]
VEC = ([f"coalesce(max(val) filter (pollutant = 'otres' and id_est = 'S{k:02d}'), 0)" for k in range(4)] + [e for _, e in _cyc_sql()]
       + [f"coalesce({f}(val) filter (pollutant = '{p}'), 0)" for p in OTHERS for f in ("avg", "min", "max")])


@query("model_vector", f"""with {v.OBS5X4}, m as (select fecha, [{', '.join(VEC)}] as vec from obs5x4 group by fecha)
select fecha, cast(p - 1 as int) as pos, round(vec[p] @6) as value from m, generate_series(1, {len(VEC)}) g(p)""")
def model_vector(spark, d):
    m = prep.model_vector(stats.station_stats(v.obs5x4(spark, d)), [f"S{k:02d}" for k in range(4)], OTHERS)
    return m.select("fecha", F.posexplode("vector").alias("pos", "value")).select("fecha", "pos", r("value").alias("value"))


@query("time_features", f"with {v.OBS12}, h as (select distinct fecha from obs12) select fecha, {', '.join(f'round({e} @6) as {n}' for n, e in _cyc_sql())} from h")
def time_features(spark, d):
    f = clock.time_features(F.col("fecha"))
    return v.obs12(spark, d).select("fecha").distinct().select("fecha", *[r(c).alias(n) for n, c in f.items()])


ONEHOT = ([f"case when isodow(o_orderdate) - 1 = {x} then 1 else 0 end as week_day_{x}" for x in range(7)]
          + [f"case when hour(o_orderdate) = {x} then 1 else 0 end as hour_{x}" for x in range(24)]
          + [f"case when weekofyear(o_orderdate) = {x} then 1 else 0 end as week_{x}" for x in range(51)])


@query("date_onehot", f"""with h as (select distinct o_orderdate + to_hours(o_orderkey % 24) as o_orderdate from orders)
select o_orderdate as fecha, round((year(o_orderdate) - 1980) / 60.0::double @6) as year, {', '.join(ONEHOT)} from h""")
def date_onehot(spark, d):
    o = v.table(spark, d, "orders").select(clock.shift_hours(F.col("o_orderdate"), F.col("o_orderkey") % 24).alias("fecha")).distinct()
    f = clock.date_onehot(F.col("fecha"))
    return o.select("fecha", *[r(c).alias(n) if n == "year" else c.alias(n) for n, c in f.items()])
