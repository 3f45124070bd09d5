"""Filters, shapes, alignment and panel statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from brisa.catalog import views as v
from brisa.catalog.base import query, r, rounded
from brisa.functions import clock, names
from brisa.operators import align, panel, stats
from brisa.session import settle, work_path

S5 = ["S00", "S01", "S02", "S03"]
P5 = ["co", "no", "nodos", "nox", "otres"]


@query("fetch_obs", f"""with {v.OBS12} select fecha, id_est, round(val @6) as val from obs12
where fecha between timestamp '2024-01-05' and timestamp '2024-01-20' and id_est in ('S01', 'S03', 'S07')""")
def fetch_obs(spark, d):
    return panel.fetch(v.obs12(spark, d), "otres", "2024-01-05", "2024-01-20", ["S01", "S03", "S07"]).select("fecha", "id_est", r("val").alias("val"))


@query("keep_pollutants", f"""with {v.OBS5X4} select fecha, pollutant, id_est, round(val @6) as val from obs5x4 where pollutant in ('no', 'otres')""")
def keep_pollutants(spark, d):
    return panel.keep_pollutants(v.obs5x4(spark, d), ["no", "otres"]).select("fecha", "pollutant", "id_est", r("val").alias("val"))


@query("filter_series", f"""with {v.OBS5X4} select fecha, pollutant, id_est, round(val @6) as val from obs5x4
where pollutant = 'nodos' and id_est = 'S02' and hour(fecha) between 9 and 20""")
def filter_series(spark, d):
    f = panel.filter_series(v.obs5x4(spark, d), "single_pollutant_and_station", "nodos", "S02", (9, 20))
    return f.select("fecha", "pollutant", "id_est", r("val").alias("val"))


@query("detect_groups", f"""with {v.OBS5X4}, s as (select 'cont_' || pollutant || '_' || id_est as series from obs5x4)
select split_part(series, '_', 2) as pollutant, count(distinct series) as n_series from s group by 1""")
def detect_groups(spark, d):
    return panel.detect_groups(v.obs5x4(spark, d).select(names.series_name(F.col("pollutant"), F.col("id_est")).alias("series")))


PIVOT = ", ".join(f"round(max(val) filter (pollutant = '{p}' and id_est = '{s}') @6) as cont_{p}_{s}" for p in P5 for s in S5)


@query("pivot_panel", f"with {v.OBS5X4} select fecha, {PIVOT} from obs5x4 group by 1")
def pivot_panel(spark, d):
    w = panel.pivot(v.obs5x4(spark, d), [(p, s) for p in P5 for s in S5])
    return rounded(w)


@query("unpivot_panel", f"""with {v.OBS5X4_FULL} select fecha, pollutant, id_est, round(val @6) as val from full_panel
where fecha in (select fecha from obs5x4)""")
def unpivot_panel(spark, d):
    return panel.unpivot(panel.pivot(v.obs5x4(spark, d), [(p, s) for p in P5 for s in S5])).select(
        "fecha", "pollutant", "id_est", r("val").alias("val"))


@query("conform_panel", f"""with {v.OBS5X4},
cal as (select p as pollutant, s as id_est, unnest(generate_series(timestamp '2024-01-15' - interval 60 hour, timestamp '2024-01-15', interval 1 hour)) as fecha
        from (values ('otres'), ('nox'), ('pmdiez')) a(p), (values ('S00'), ('S01'), ('S09')) b(s))
select c.fecha, c.pollutant, c.id_est, round(o.val @6) as val from cal c left join obs5x4 o using (pollutant, id_est, fecha)""")
def conform_panel(spark, d):
    want = spark.createDataFrame([(p, s) for p in ("otres", "nox", "pmdiez") for s in ("S00", "S01", "S09")], "pollutant string, id_est string")
    return panel.conform(v.obs5x4(spark, d), want, "2024-01-15 00:00:00", 60).select("fecha", "pollutant", "id_est", r("val").alias("val"))


@query("column_families", f"""with {v.OBS5X4}, c as (
  select distinct 'cont_' || pollutant || '_' || id_est as name from obs5x4 union select distinct 'i_cont_' || pollutant || '_' || id_est from obs5x4
  union select distinct 'T2_' || (hour(fecha)) || '_h' || hour(fecha) from obs5x4 union select 'met_tmp' union select 'half_sin_day' union select 'fecha')
select case when name like 'i_cont_%' then 'flag' when name like 'cont_%' then 'contaminant' when regexp_matches(name, '_h[0-9]+$') then 'weather'
            when name like 'met_%' then 'meteo' when regexp_matches(name, '(day|week|year)$') then 'time' else 'other' end as kind, count(*) as n
from c group by 1""")
def column_families(spark, d):
    o = v.obs5x4(spark, d).select(names.series_name(F.col("pollutant"), F.col("id_est")).alias("s"), F.hour("fecha").alias("h"))
    found = o.select(F.explode(F.array("s", F.concat(F.lit("i_"), "s"), F.format_string("T2_%d_h%d", "h", "h"), F.lit("met_tmp"),
                                       F.lit("half_sin_day"), F.lit("fecha"))).alias("name")).distinct()
    return panel.column_families(found).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


# Fixed values, written out once more: station codes and their names.
CODES = "UIZ AJU ATI CUA SFE SAG CUT PED TAH GAM IZT CCA HGM LPR MGH CAM FAC TLA MER XAL LLA TLI UAX BJU MPA MON NEZ INN AJM VIF XXX YYY".split()
STATION_SQL = """(values ('UIZ', 'UAM Iztapalapa'), ('AJU', 'Ajusco'), ('ATI', 'Atizapan'), ('CUA', 'Cuajimalpa'), ('SFE', 'Santa Fe'), ('SAG', 'San Agustín'),
  ('CUT', 'Cuautitlán'), ('PED', 'Pedregal'), ('TAH', 'Tlahuac'), ('GAM', 'Gustavo A. Madero'), ('IZT', 'Iztacalco'), ('CCA', 'ICAyCC - UNAM'),
  ('HGM', 'Hospital General de México'), ('LPR', 'La Presa'), ('MGH', 'Miguel Hidalgo'), ('CAM', 'Camarones'), ('FAC', 'FES Acatlán'), ('TLA', 'Tlalnepantla'),
  ('MER', 'Merced'), ('XAL', 'Xalostoc'), ('LLA', 'Los Laureles'), ('TLI', 'Tultitlán'), ('UAX', 'UAM Xochimilco'), ('BJU', 'Benito Juárez'),
  ('MPA', 'Milpa Alta'), ('MON', 'Montesillo'), ('NEZ', 'Nezahualcóyotl'), ('INN', 'Investigaciones Nucleares'), ('AJM', 'Ajusco Medio'), ('VIF', 'Villa de las Flores')) t(id_est, nombre)"""


@query("station_names", f"""with s as (select s_suppkey, {CODES}[s_suppkey % 32 + 1] as id_est from supplier), n as (select * from {STATION_SQL})
select s.s_suppkey, s.id_est, coalesce(n.nombre, 'Station ID not found') as nombre from s left join n using (id_est)""")
def station_names(spark, d):
    code = F.element_at(F.array(*[F.lit(c) for c in CODES]), (F.col("s_suppkey") % 32 + 1).cast("int"))
    return panel.station_names(v.table(spark, d, "supplier").select("s_suppkey", code.alias("id_est")))


@query("active_stations", f"with {v.STATIONS} select id, nombre, lastyear, round(lat @6) as lat, round(lon @6) as lon from stations where lastyear >= 2000")
def active_stations(spark, d):
    return panel.active_stations(v.stations(spark, d), 2000).select("id", "nombre", "lastyear", r("lat").alias("lat"), r("lon").alias("lon"))


@query("valid_origins", f"""with {v.OBS12}, h as (select distinct fecha from obs12 where val is not null),
o as (select distinct fecha as origin from obs12 where year(fecha) >= 2020)
select origin, count(*) as history_hours from o join h on h.fecha >= origin - interval 60 hour and h.fecha < origin group by 1 having count(*) >= 15""")
def valid_origins(spark, d):
    o = v.obs12(spark, d)
    return panel.valid_origins(o.select(F.col("fecha").alias("origin")).distinct(), o)


@query("availability", f"""with {v.OBS5X4}, a as (select fecha, pollutant, id_est from obs5x4 union all select fecha, pollutant, 'mean' from obs5x4 where pollutant <> 'otres')
select pollutant, count(distinct id_est) filter (id_est not in ('min', 'max', 'mean')) as n_stations,
       max(case when id_est in ('min', 'max', 'mean') then 1 else 0 end) as has_aggregates,
       case when count(distinct id_est) filter (id_est not in ('min', 'max', 'mean')) > 1 then 1 else 0 end as multi_station from a group by 1""")
def availability(spark, d):
    o = v.obs5x4(spark, d)
    agg = stats.station_stats(o).filter(F.col("id_est") == "mean")
    return panel.availability(o.unionByName(agg.select(o.columns)))


@query("outer_align", f"""with {v.OBS5X4}, m as (select fecha, pollutant, avg(val) as val from obs5x4 group by 1, 2)
select fecha, {', '.join(f"round(max(val) filter (pollutant = '{p}') @6) as {p}" for p in P5)} from m group by 1""")
def outer_align(spark, d):
    m = v.obs5x4(spark, d).groupBy("fecha", "pollutant").agg(F.avg("val").alias("val"))
    return rounded(align.align_long(m, P5, "pollutant"))


@query("union_years", f"""with {v.OBS_DAILY} select fecha, id_est, round(val @6) as val, case when year(fecha) >= 2000 then 'new' end as source from obs_daily""")
def union_years(spark, d):
    o = v.obs_daily(spark, d).select("fecha", "id_est", r("val").alias("val"))
    new = F.year("fecha") >= 2000
    return panel.union_years([o.filter(~new), o.filter(new).withColumn("source", F.lit("new"))])


@query("preview", f"with {v.OBS12} select fecha, id_est, round(val @6) as val from obs12 order by fecha, id_est limit 3")
def preview(spark, d):
    return panel.preview(v.obs12(spark, d), ["fecha", "id_est"], 3).select("fecha", "id_est", r("val").alias("val"))


@query("count_valid", f"with {v.OBS_DAILY} select id_est, count(val) as n from obs_daily where year(fecha) >= 1996 and year(fecha) <= 2000 group by 1")
def count_valid(spark, d):
    return stats.count_valid(v.obs_daily(spark, d), since=1996, until=2000)


@query("daily_max", f"with {v.OBS12} select year(fecha) as year, month(fecha) as month, day(fecha) as day, round(max(val) @6) as max_val from obs12 group by 1, 2, 3")
def daily_max(spark, d):
    return stats.daily_max(v.obs12(spark, d)).select("year", "month", "day", r("max_val").alias("max_val"))


@query("station_stats", f"""with {v.OBS5X4}, a as (select fecha, pollutant, avg(val) as mean, min(val) as min, max(val) as max from obs5x4 where pollutant <> 'otres' group by 1, 2)
select fecha, pollutant, 'mean' as id_est, round(mean @6) as val from a union all select fecha, pollutant, 'min', round(min @6) from a
union all select fecha, pollutant, 'max', round(max @6) from a union all select fecha, pollutant, id_est, round(val @6) from obs5x4 where pollutant = 'otres'""")
def station_stats(spark, d):
    return stats.station_stats(v.obs5x4(spark, d)).select("fecha", "pollutant", "id_est", r("val").alias("val"))


PARAMS_SQL = """per as (select pollutant, id_est, avg(val) as m, stddev_samp(val) as s from obs5x4 group by 1, 2),
params as (select pollutant, avg(m) as mean, avg(s) as std from per group by 1)"""


@query("norm_params", f"""with {v.OBS5X4}, {v.WX}, {PARAMS_SQL}
select 'pollutant' as kind, pollutant as name, round(mean @6) as mean, round(std @6) as std from params
union all select 'weather', var, round(avg(value) @6), round(stddev_pop(value) @6) from wx group by var""")
def norm_params(spark, d):
    return stats.norm_params(v.obs5x4(spark, d), v.wx(spark, d)).select("kind", "name", r("mean").alias("mean"), r("std").alias("std"))


def _params(spark, d):
    return settle(stats.norm_params(v.obs5x4(spark, d)), "params")


@query("zscore", f"""with {v.OBS5X4_FULL}, {PARAMS_SQL}
select f.fecha, f.pollutant, f.id_est, round(coalesce((f.val - mean) / std, 0) @6) as z from full_panel f left join params using (pollutant)""")
def zscore(spark, d):
    full = panel.fill_calendar(v.obs5x4(spark, d)).drop("h")
    return stats.zscore(full, _params(spark, d)).select("fecha", "pollutant", "id_est", r("z").alias("z"))


@query("denormalize", f"""with {v.OBS5X4}, {PARAMS_SQL}
select fecha, pollutant, id_est, round(((val - mean) / std) * std + mean @6) as val from obs5x4 join params using (pollutant)""")
def denormalize(spark, d):
    p = _params(spark, d)
    z = stats.zscore(v.obs5x4(spark, d), p, fill=None).drop("val")
    return stats.denormalize(z, p).select("fecha", "pollutant", "id_est", r("val").alias("val"))


@query("zscore_prefix", f"""with {v.OBS5X4}, {PARAMS_SQL}, n as (select mean as m0, std as s0 from params where pollutant = 'no')
select fecha, pollutant, id_est, round(case when pollutant in ('nodos', 'nox') then ((val - m0) / s0 - mean) / std else (val - mean) / std end @6) as z
from obs5x4 join params using (pollutant), n""")
def zscore_prefix(spark, d):
    o = v.obs5x4(spark, d)
    p = _params(spark, d).select("name", "mean", "std", F.col("name").alias("ord"))
    chain = settle(stats.prefix_chain(p, p.select(F.col("name").alias("pollutant"))), "chain")
    return o.join(chain, "pollutant").select("fecha", "pollutant", "id_est", r(stats.prefix_zscore(F.col("val"), F.col("chain"))).alias("z"))


@query("minmax_scale", f"""with {v.OBS5X4}, p as (select pollutant, min(val) as lo, max(val) as hi from obs5x4 group by 1)
select fecha, pollutant, id_est, round((val - lo) / case when hi > lo then hi - lo else 1 end @6) as scaled from obs5x4 join p using (pollutant)""")
def minmax_scale(spark, d):
    o = v.obs5x4(spark, d)
    p = settle(stats.minmax_params(o, "pollutant", "val"), "minmax")
    return stats.minmax_scale(o, p, "pollutant", "val").select("fecha", "pollutant", "id_est", r("scaled").alias("scaled"))


@query("standard_scale", f"""with {v.OBS5X4}, p as (select pollutant, avg(val) as m, stddev_pop(val) as s from obs5x4 group by 1)
select fecha, pollutant, id_est, round((val - m) / case when s > 0 then s else 1 end @6) as scaled from obs5x4 join p using (pollutant)""")
def standard_scale(spark, d):
    o = v.obs5x4(spark, d)
    p = settle(stats.standard_params(o, "pollutant", "val"), "standard")
    return stats.standard_scale(o, p, "pollutant", "val").select("fecha", "pollutant", "id_est", r("scaled").alias("scaled"))


@query("project_params", f"""with {v.OBS5X4},
p as (select 'cont_' || pollutant || '_' || id_est as name, avg(val) as mean, stddev_pop(val) as std from obs5x4 group by 1),
c as (select printf('plus_%02d_%s', k, name) as col, name from p, generate_series(1, 24) g(k))
select col as "column", p.name, round(mean @6) as mean, round(std @6) as std from c join p using (name)""")
def project_params(spark, d):
    p = stats.standard_params(v.obs5x4(spark, d).withColumn("name", names.series_name(F.col("pollutant"), F.col("id_est"))), "name", "val")
    cols = p.select(F.explode(F.transform(F.sequence(F.lit(1), F.lit(24)), lambda k: F.format_string("plus_%02d_%s", k, F.col("name")))).alias("column"))
    return align.project_params(cols, p).select("column", "name", r("mean").alias("mean"), r("std").alias("std"))


@query("high_events", f"""with {v.OBS12}, t as (select avg(val) + 2 * stddev_pop(val) as thr from obs12)
select fecha, round(max(val) @6) as top, round(max(thr) @6) as threshold from obs12, t group by 1 having max(val) > max(thr)""")
def high_events(spark, d):
    return stats.high_events(v.obs12(spark, d)).select("fecha", r("top").alias("top"), r("threshold").alias("threshold"))


@query("completeness", f"""with {v.OBS5X4_FULL}, per as (select pollutant, id_est, count(*) as n, count(val) as v, avg(val) as m, stddev_samp(val) as s, min(val) as lo, max(val) as hi,
  min(fecha) as t0, max(fecha) as t1 from full_panel group by 1, 2)
select count(*) as n_series, sum(n)::bigint as n_cells, (sum(n) - sum(v))::bigint as n_missing, round(sum(v) * 100.0::double / sum(n) @6) as complete_pct,
       min(t0) as first_ts, max(t1) as last_ts, round(avg(m) @6) as mean_of_means, round(avg(s) @6) as mean_of_stds, min(lo) as min_val, max(hi) as max_val from per""")
def completeness(spark, d):
    c = stats.completeness(panel.fill_calendar(v.obs5x4(spark, d)))
    return c.select(*[r(x).alias(x) if x in ("complete_pct", "mean_of_means", "mean_of_stds") else F.col(x) for x in c.columns])


@query("problem_origins", f"""with {v.OBS12_FULL} select fecha as origin, count(val) as valid, cast(count_if(val is null) as bigint) as missing,
  case when count(val) = 0 then 1 else 0 end as is_problem from full_panel group by 1""")
def problem_origins(spark, d):
    return stats.problem_origins(panel.fill_calendar(v.obs12(spark, d)).select(F.col("fecha").alias("origin"), F.col("val").alias("value")))


PROFILE = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("column_profile", " union all ".join(f"""select '{c}' as "column", count({c}) as "count", count(distinct {c}) as "unique",
  (select {c} from lineitem group by {c} order by count(*) desc, {c} limit 1) as top, (select max(n) from (select count(*) as n from lineitem group by {c})) as freq,
  round(avg({c}) @6) as mean, round(stddev_samp({c}) @6) as std, min({c}) as min, max({c}) as max,
  round(quantile_cont({c}, 0.25) @6) as q25, round(quantile_cont({c}, 0.5) @6) as q50, round(quantile_cont({c}, 0.75) @6) as q75 from lineitem""" for c in PROFILE))
def column_profile(spark, d):
    p = stats.column_profile(v.table(spark, d, "lineitem"), PROFILE)
    return p.select(*[r(c).alias(c) if c in ("mean", "std", "q25", "q50", "q75") else F.col(c) for c in p.columns])


TEXTS = ["l_returnflag", "l_linestatus"]


@query("category_profile", " union all ".join(f"""select '{c}' as "column", count({c}) as "count", count(distinct {c}) as "unique",
  (select {c} from lineitem group by {c} order by count(*) desc, {c} limit 1) as top, (select max(n) from (select count(*) as n from lineitem group by {c})) as freq from lineitem""" for c in TEXTS))
def category_profile(spark, d):
    return stats.category_profile(v.table(spark, d, "lineitem"), TEXTS)


@query("next_target", f"with {v.OBS12} select max(fecha) + interval 1 hour as target_ts from obs12")
def next_target(spark, d):
    return stats.next_target(v.obs12(spark, d), "2024-01-01")


@query("remaining_origins", f"""with {v.OBS12} select distinct fecha as origin from obs12
where fecha not in (select fecha from obs12 where id_est = 'S00' and fecha < timestamp '2024-01-20')""")
def remaining_origins(spark, d):
    o = v.obs12(spark, d)
    done = o.filter((F.col("id_est") == "S00") & (F.col("fecha") < F.lit("2024-01-20").cast("timestamp_ntz"))).select(F.col("fecha").alias("origin"))
    return align.remaining_origins(o.select(F.col("fecha").alias("origin")).distinct(), done)


@query("intersect_times", f"""with {v.OBS12}, {v.wx_sql(7)}
select o.fecha as ts, count(distinct o.id_est) as n_stations, count(distinct w.var) as n_vars from obs12 o join (select distinct ts, var from wx) w on w.ts = o.fecha group by 1""")
def intersect_times(spark, d):
    a, b = align.intersect_times(v.obs12(spark, d).withColumnRenamed("fecha", "ts"), v.wx(spark, d, 7).select("ts", "var").distinct())
    return a.groupBy("ts").agg(F.count_distinct("id_est").alias("n_stations")).join(
        b.groupBy("ts").agg(F.count_distinct("var").alias("n_vars")), "ts")


@query("asof_nearest", f"""with {v.OBS12}, {v.wx_sql(7)}, m as (select ts, var, avg(value) as value from wx group by 1, 2),
h as (select distinct fecha from obs12),
s as (select distinct ts from m),
n as (select h.fecha, (select ts from s order by abs(epoch(s.ts) - epoch(h.fecha)), s.ts limit 1) as ts from h)
select n.fecha, m.var, n.ts as step_ts, round(m.value @6) as value from n join m using (ts)""")
def asof_nearest(spark, d):
    m = v.wx(spark, d, 7).groupBy(clock.hour_index(F.col("ts")).alias("h"), "var").agg(F.avg("value").alias("value"))
    hours = v.obs12(spark, d).select(clock.hour_index(F.col("fecha")).alias("h")).distinct()
    near = align.asof_nearest(hours, m.select("h"), [])
    return near.join(m.select(F.col("h").alias("step_h"), "var", "value"), "step_h").select(
        clock.hour_stamp(F.col("h")).alias("fecha"), "var", clock.hour_stamp(F.col("step_h")).alias("step_ts"), r("value").alias("value"))


@query("require_weather_days", f"""with {v.OBS12}, {v.wx_sql(7)}, days as (select distinct date_trunc('day', ts + case when t >= 30 then interval 3 day else interval 0 day end) as day from wx)
select distinct fecha from obs12 where date_trunc('day', fecha) in (select day from days) and date_trunc('day', fecha) + interval 1 day in (select day from days)""")
def require_weather_days(spark, d):
    """Weather with a gap of three days; its days are told by the manifest of its files."""
    from brisa.sources import manifest, sinks
    path = work_path(spark, "weather")
    w = v.wx(spark, d, 7).withColumn("ts", clock.shift_hours(F.col("ts"), F.when(F.col("t") >= 30, 72).otherwise(0)))
    sinks.write_grid(w.select("ts", "var", "i", "j", "lat", "lon", "value"), path)
    days = manifest.days(settle(manifest.build(spark, path), "manifest"))
    return align.require_weather_days(v.obs12(spark, d).select("fecha").distinct(), days, align.days_needed(24))


LEADS_SQL = f"""m as (select ts, var, avg(value) as value from wx group by 1, 2),
days as (select distinct date_trunc('day', ts) as day from m), hrs as (select distinct fecha from obs12),
g as (select fecha, var, l as lead, (date_trunc('day', fecha) in (select day from days) and date_trunc('day', fecha) + interval 1 day in (select day from days)) as ok
      from hrs, (select distinct var from m), generate_series(0, 23) x(l)),
leads as (select g.fecha, g.lead, g.var, case when ok then coalesce(m.value, 0) else 0 end as value from g left join m on m.ts = g.fecha + to_hours(g.lead) and m.var = g.var)"""


@query("weather_leads", f"with {v.OBS12}, {v.WX}, {LEADS_SQL} select fecha, lead, var, round(value @6) as value from leads")
def weather_leads(spark, d):
    m = v.wx(spark, d).groupBy("ts", "var").agg(F.avg("value").alias("value"))
    return align.weather_leads(v.obs12(spark, d), m).select("fecha", "lead", "var", r("value").alias("value"))


@query("required_days", f"""with {v.OBS12}, t as (select distinct fecha as target_ts, fecha + interval 6 hour as target_utc from obs12)
select target_ts, date_trunc('day', target_utc) + to_days(k) as day_utc, case when k < 0 then 'historical' else 'forecast' end as purpose
from t, (values (-2), (-1), (0), (1), (2)) o(k)""")
def required_days(spark, d):
    return align.required_days(v.obs12(spark, d).select(F.col("fecha").alias("target_ts")).distinct())


@query("match_configs", """with m as (select distinct p_name as model from part),
c as (select p_type as config, min(p_partkey) as ord from part group by 1
      union select split_part(p_name, ' ', 2), min(p_partkey) from part group by 1 union select p_name || ' v2', min(p_partkey) from part group by 1),
u as (select config, min(ord) as ord from c group by 1),
h as (select m.model, u.config, row_number() over (partition by m.model order by case when m.model = u.config then 0 else 1 end, u.ord, u.config) as rn
      from m join u on contains(m.model, u.config) or contains(u.config, m.model))
select m.model, h.config from m left join h on h.model = m.model and h.rn = 1""")
def match_configs(spark, d):
    p = v.table(spark, d, "part")
    c = (p.select(F.col("p_type").alias("config"), "p_partkey")
         .unionByName(p.select(F.split("p_name", " ").getItem(1).alias("config"), "p_partkey"))
         .unionByName(p.select(F.concat("p_name", F.lit(" v2")).alias("config"), "p_partkey"))
         .groupBy("config").agg(F.min("p_partkey").alias("ord")))
    c = c.select("config", F.struct("ord", "config").alias("ord"))
    return align.match_configs(p.select(F.col("p_name").alias("model")), c)


@query("pair_files", """with y as (select distinct year(o_orderdate) as y from orders), z as (select distinct year(l_shipdate) as y from lineitem),
w as (select 'weather_data_' || y || '_to_' || (y + 1) || '.pkl' as path from y), p as (select 'pollution_data_' || y || '_to_' || (y + 1) || '.pkl' as path from z)
select regexp_extract(w.path, 'weather_data_([0-9]{4}_to_[0-9]{4})', 1) as years, w.path as weather_path, p.path as pollution_path
from w join p on regexp_extract(w.path, 'weather_data_([0-9]{4}_to_[0-9]{4})', 1) = regexp_extract(p.path, 'pollution_data_([0-9]{4}_to_[0-9]{4})', 1)""")
def pair_files(spark, d):
    y = v.table(spark, d, "orders").select(F.year("o_orderdate").alias("y")).distinct()
    z = v.table(spark, d, "lineitem").select(F.year("l_shipdate").alias("y")).distinct()

    def name(kind):
        return F.format_string(f"{kind}_data_%d_to_%d.pkl", F.col("y"), F.col("y") + 1).alias("path")

    return align.pair_files(y.select(name("weather")), z.select(name("pollution")))
