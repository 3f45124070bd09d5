"""Weather grids and station profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from brisa.catalog import views as v
from brisa.catalog.base import query, r
from brisa.catalog.impute_queries import CLIM_TAIL
from brisa.functions import air, clock
from brisa.operators import cluster, grid, impute, tiles
from brisa.plans import daily_grid as daily
from brisa.session import settle, work_path

VARS = ["T2", "U10", "V10", "RAINC", "RAINNC"]


def _store(spark, d, cells=None):
    """The fields as tiles of four by four cells."""
    w = v.wx(spark, d) if cells is None else cells
    return tiles.write(w.select("ts", "var", "i", "j", "lat", "lon", "value"), work_path(spark, "tiles"), side=4)


@query("grid_crop", f"""with {v.WX}, a as (select distinct i, lat from wx), b as (select distinct j, lon from wx)
select t, var, i, j, round(value @6) as value from wx where t < 24
 and i >= (select min(i) from a where lat >= 18.82) and i < (select min(i) from a where lat >= 19.02) - 1
 and j >= (select min(j) from b where lon >= -99.72) and j < coalesce((select min(j) from b where lon >= -99.0) - 1, (select max(j) + 1 from b))""")
def grid_crop(spark, d):
    c = _store(spark, d).crop((18.82, 19.02, -99.72, -99.0), "2024-01-01", "2024-01-02")
    t = F.timestamp_diff("HOUR", F.lit("2024-01-01").cast("timestamp_ntz"), F.col("ts")).cast("int")
    return c.select(t.alias("t"), "var", "i", "j", r("value").alias("value"))


def _weights_sql(name, idx, coord, src, lo, hi, step):
    n = grid.target_count(lo, hi, step)
    return f"""{name}_ax as (select distinct {idx} as idx, {coord} as c from {src}),
{name}_seg as (select idx, c, lead(idx) over (order by c) as idx1, lead(c) over (order by c) as c1, lead(c, 2) over (order by c) is null as is_last from {name}_ax),
{name}_k as (select k, {lo}::double + k * {step}::double as target from generate_series(0, {n - 1}) g(k)),
{name}_hit as (select k, target, s.* from {name}_k k join {name}_seg s on s.c1 is not null and target >= c and (target < c1 or (is_last and target <= c1))),
{name}_w as (select k, target, idx, 1 - (target - c) / (c1 - c) as w from {name}_hit where 1 - (target - c) / (c1 - c) > 0
             union all select k, target, idx1, (target - c) / (c1 - c) from {name}_hit where (target - c) / (c1 - c) > 0)"""


BOX = dict(lat=(18.78, 19.15), lon=(-99.80, -99.42), step=0.04)


@query("grid_bilinear", f"""with {v.WX}, {_weights_sql('la', 'i', 'lat', 'wx', 18.78, 19.15, 0.04)}, {_weights_sql('lo', 'j', 'lon', 'wx', -99.80, -99.42, 0.04)},
inner_vals as (select ts, var, a.k as row, b.k as col, sum(a.w * b.w * value) as val from wx join la_w a on a.idx = wx.i join lo_w b on b.idx = wx.j group by 1, 2, 3, 4)
select f.ts, f.var, cast(a.k as int) as row, cast(b.k as int) as col, round(a.target @6) as lat, round(b.target @6) as lon, round(v.val @6) as value
from (select distinct ts, var from wx) f cross join la_k a cross join lo_k b
left join inner_vals v on v.ts = f.ts and v.var = f.var and v.row = a.k and v.col = b.k""")
def grid_bilinear(spark, d):
    s = _store(spark, d)
    lat, lon = s.axes()
    a = grid.axis_weights(lat, *BOX["lat"], BOX["step"])
    b = grid.axis_weights(lon, *BOX["lon"], BOX["step"])
    return tiles.bilinear(s.tiles(), a, b, s.side).select("ts", "var", "row", "col", r("lat").alias("lat"), r("lon").alias("lon"), r("value").alias("value"))


def raw_cells(spark, d):
    """Raw files of up to 48 steps that overlap by a day, with accumulated rain, Kelvin temperatures, and Q2 and PSFC cells."""
    from pyspark.sql import Window
    own = F.floor(F.col("t") / 24)
    w = v.wx(spark, d).withColumn("file", F.explode(F.when(own > 0, F.array(own - 1, own)).otherwise(F.array(own))))
    run = Window.partitionBy("file", "var", "i", "j").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    acc = F.sum(F.abs("value")).over(run)
    w = w.withColumn("value", F.when(F.col("var").isin("RAINC", "RAINNC"), acc).when(F.col("var") == "T2", F.col("value") * 10 + 290).otherwise(F.col("value")))
    extra = F.array(F.struct(F.col("var").alias("var"), F.col("value").alias("value")),
                    F.when(F.col("var") == "T2", F.struct(F.lit("Q2").alias("var"), F.lit(0.008).alias("value"))),
                    F.when(F.col("var") == "T2", F.struct(F.lit("PSFC").alias("var"), F.lit(78000.0).alias("value"))))
    return w.select("file", "ts", "i", "j", "lat", "lon", F.explode(F.array_compact(extra)).alias("e")).select(
        "file", "ts", "i", "j", "lat", "lon", "e.var", "e.value")


RAW_SQL = f"""{v.WX},
side as (select t // 24 as file, t, ts, i, j, lat, lon, 290 + 10 * max(value) filter (var = 'T2') as t2, max(value) filter (var = 'U10') as u10,
           max(value) filter (var = 'V10') as v10, sum(abs(value)) filter (var in ('RAINC', 'RAINNC')) as r from wx group by all),
der as (select *, greatest(coalesce(case when t % 24 = 0 then null else r end, 0), 0) as rain, sqrt(u10 * u10 + v10 * v10) as ws10,
           6.112 * exp(17.67 * (t2 - 273.15) / (t2 - 29.65)) as es from side),
hum as (select *, 0.62198 * es / (780.0::double - es) as ws from der),
cells as (select file, ts, i, j, lat, lon, unnest(['T2', 'U10', 'V10', 'RAIN', 'WS10', 'RH']) as var,
             unnest([t2, u10, v10, rain, ws10, 100 * (0.008::double / (0.62198 + 0.008::double)) * ((0.62198 + ws) / ws)]) as value from hum)"""


@query("daily_grid", f"""with {RAW_SQL},
ok as (select * from cells where file in (select file from side group by 1 having count(distinct ts) = 24)
       and i >= 1 and i < 7 and j >= 0 and j < 8),
{_weights_sql('la', 'i', 'lat', 'ok', 18.8, 19.05, 0.05)}, {_weights_sql('lo', 'j', 'lon', 'ok', -99.74, -99.4, 0.05)},
inner_vals as (select ts, var, a.k as row, b.k as col, sum(a.w * b.w * value) as val from ok join la_w a on a.idx = ok.i join lo_w b on b.idx = ok.j group by 1, 2, 3, 4)
select f.ts - interval 6 hour as ts, date_trunc('day', f.ts) as day, f.var, cast(a.k as int) as row, cast(b.k as int) as col, round(v.val @6) as value
from (select distinct ts, var from ok) f cross join la_k a cross join lo_k b
left join inner_vals v on v.ts = f.ts and v.var = f.var and v.row = a.k and v.col = b.k""")
def daily_grid(spark, d):
    out, _bad = daily.daily_grid(raw_cells(spark, d), (18.78, 19.1, -99.9, 0.0), 0.05, (18.8, 19.05, -99.74, -99.4))
    return out.select("ts", "day", "var", "row", "col", r("value").alias("value"))


@query("daily_grid_incomplete", f"with {v.WX} select t // 24 as file, count(distinct ts) as n_steps from wx group by 1 having count(distinct ts) < 24")
def daily_grid_incomplete(spark, d):
    return daily.daily_grid(raw_cells(spark, d), (18.78, 19.1, -99.9, 0.0), 0.05, (18.8, 19.05, -99.74, -99.4))[1]


@query("grid_subsample", f"""with {v.WX}, la as (select * from (values (0, 0, 3), (1, 3, 6), (2, 6, 7)) s(row, a, b)), lo as (select * from (values (0, 0, 2), (1, 2, 4), (2, 4, 6), (3, 6, 7)) s(col, a, b))
select ts, var, row, col, round(avg(value) @6) as value, round(avg(lat) @6) as lat, round(avg(lon) @6) as lon
from wx join la on i >= la.a and i < la.b join lo on j >= lo.a and j < lo.b group by 1, 2, 3, 4""")
def grid_subsample(spark, d):
    s = _store(spark, d)
    return tiles.subsample(s.tiles(), 3, 4, s).select("ts", "var", "row", "col", *[r(c).alias(c) for c in ("value", "lat", "lon")])


@query("spatial_mean", f"with {v.WX} select ts, var, round(avg(value) @6) as mean, round(min(value) @6) as min, round(max(value) @6) as max from wx group by 1, 2")
def spatial_mean(spark, d):
    return grid.spatial_summary(v.wx(spark, d)).select("ts", "var", *[r(c).alias(c) for c in ("mean", "min", "max")])


@query("grid_info", f"""with {v.WX} select count(distinct ts) as n_times, count(distinct var) as n_vars, count(distinct i) as n_lat, count(distinct j) as n_lon, count(*) as cells,
  count(*) * 8 as bytes, cast(count_if(value is null) as bigint) as nulls from wx""")
def grid_info(spark, d):
    return grid.info(v.wx(spark, d))


@query("grid_check", f"""with {v.WX}, f as (select t // 24 as file, ts, case when var = 'V10' and t // 24 % 2 = 1 then 'RH' else var end as var from wx)
select file, count(distinct ts) as n_steps, 3 - count(distinct var) filter (var in ('T2', 'U10', 'RH')) as n_missing,
  case when count(distinct ts) = 24 and count(distinct var) filter (var in ('T2', 'U10', 'RH')) = 3 then 1 else 0 end as ok from f group by 1""")
def grid_check(spark, d):
    w = v.wx(spark, d).withColumn("file", F.floor(F.col("t") / 24))
    # every other product is complete
    w = w.withColumn("var", F.when((F.col("var") == "V10") & (F.col("file") % 2 == 1), "RH").otherwise(F.col("var")))
    return grid.check(w, ["T2", "U10", "RH"], 24, "file")


@query("scan_grid", f"""with {v.WX} select ts, var, count(*) as n, round(avg(value) @6) as mean, 0::bigint as dup from wx
where ts >= timestamp '2024-01-02' and ts < timestamp '2024-01-05' group by 1, 2""")
def scan_grid(spark, d):
    """Cells of a time range, from the files that the manifest names."""
    from brisa.sources import manifest, sinks
    path = work_path(spark, "grid")
    sinks.write_grid(v.wx(spark, d).select("ts", "var", "i", "j", "lat", "lon", "value"), path)
    g = manifest.scan(spark, path, settle(manifest.build(spark, path), "manifest"), "2024-01-02", "2024-01-05")
    dup = grid.duplicates(g).select(F.count(F.lit(1))).scalar()
    return g.groupBy("ts", "var").agg(F.count(F.lit(1)).alias("n"), r(F.avg("value")).alias("mean")).withColumn("dup", dup)


@query("grid_flatten", f"""with {v.WX} select ts, {', '.join(f"max(round(value, 4)) filter (var = '{x}' and i * 8 + j = {c}) as {x}_{c}" for x in VARS for c in range(64))} from wx group by 1""")
def grid_flatten(spark, d):
    return grid.flatten(v.wx(spark, d), VARS, 64, 8)


@query("grid_stack", f"""with {v.WX} select ts, cast(row_number() over (partition by ts order by list_position(['T2','U10','V10','RAINC','RAINNC'], var), i, j) - 1 as int) as pos, round(coalesce(value, 0) @6) as value from wx""")
def grid_stack(spark, d):
    s = _store(spark, d)
    return tiles.stack(s.tiles(), VARS, s).select("ts", "pos", r("value").alias("value"))


@query("grid_frame", f"with {v.WX}, k as (select ts, dense_rank() over (order by ts) - 1 as n from (select distinct ts from wx)) select ts, var, i, j, round(value @6) as value from wx join k using (ts) where n = 17")
def grid_frame(spark, d):
    return grid.frame(v.wx(spark, d), 17).select("ts", "var", "i", "j", r("value").alias("value"))


GAP_SQL = f"""{v.WX}, g as (select ts + case when t >= 24 then interval 2 day else interval 0 day end as ts, var, i, j, value from wx),
days as (select unnest(generate_series((select min(date_trunc('day', ts)) from g), (select max(date_trunc('day', ts)) from g), interval 1 day)) as day),
gap as (select day from days where day not in (select date_trunc('day', ts) from g)),
made as (select day + to_hours(h) as ts, var, i, j from gap, generate_series(0, 23) x(h), (select distinct var, i, j from g))"""


@query("zero_fill_days", f"""with {GAP_SQL} select ts, var, i, j, round(value @6) as value, 0 as is_synthetic from g union all select ts, var, i, j, 0.0, 1 from made""")
def zero_fill_days(spark, d):
    """The fields with the second day and the third one empty: later ones lie two days on."""
    w = v.wx(spark, d).withColumn("ts", clock.shift_hours(F.col("ts"), F.when(F.col("t") >= 24, 48).otherwise(0)))
    made = tiles.zero_days(_store(spark, d, w), VARS)
    have = w.select("ts", "var", "i", "j", r("value").alias("value"), F.lit(0).alias("is_synthetic"))
    return have.unionByName(made.select(have.columns))


@query("zero_fill_cells", f"""with {GAP_SQL} select ts, var, i, j, round(value @6) as value, 0 as is_synthetic from g union all select ts, var, i, j, 0.0, 1 from made""")
def zero_fill_cells(spark, d):
    """The same from a table of cells without catalogue and manifest."""
    w = v.wx(spark, d).withColumn("ts", clock.shift_hours(F.col("ts"), F.when(F.col("t") >= 24, 48).otherwise(0)))
    return grid.zero_fill_days(w).select("ts", "var", "i", "j", r("value").alias("value"), "is_synthetic")


@query("combine_days", f"with {v.WX} select ts, var, i, j, round(value @6) as value from wx where ts < (select min(ts) from wx) + interval 72 hour")
def combine_days(spark, d):
    w = v.wx(spark, d)
    c = grid.combine_days([w.filter(F.col("t") < 48), w.filter(F.col("t") >= 48)], 72)
    return c.select("ts", "var", "i", "j", r("value").alias("value"))


@query("pollutant_vs_weather", f"""with {v.OBS12}, {v.WX}, m as (select ts, avg(value) as t2 from wx where var = 'T2' group by 1), o as (select fecha, avg(val) as val from obs12 group by 1)
select fecha, round(val @6) as val, round(t2 @6) as t2 from o join m on m.ts = o.fecha""")
def pollutant_vs_weather(spark, d):
    m = grid.spatial_summary(v.wx(spark, d).filter(F.col("var") == "T2"), ["ts"]).select(F.col("ts").alias("fecha"), r("mean").alias("t2"))
    o = v.obs12(spark, d).groupBy("fecha").agg(r(F.avg("val")).alias("val"))
    return o.join(m, "fecha")


@query("wind_speed", f"with {v.WX} select ts, i, j, round(sqrt(max(value) filter (var = 'U10') ** 2 + max(value) filter (var = 'V10') ** 2) @6) as ws10 from wx group by 1, 2, 3")
def wind_speed(spark, d):
    w = v.wx(spark, d).filter(F.col("var").isin("U10", "V10"))
    uv = w.groupBy("ts", "i", "j").agg(*[F.max(F.when(F.col("var") == x, F.col("value"))).alias(x) for x in ("U10", "V10")])
    return uv.select("ts", "i", "j", r(air.wind_speed(F.col("U10"), F.col("V10"))).alias("ws10"))


@query("rel_humidity", f"""with {v.WX}, a as (select ts, i, j, 290 + 10 * value as t2 from wx where var = 'T2'),
b as (select *, 6.112 * exp(17.67 * (t2 - 273.15) / (t2 - 29.65)) as es from a), c as (select *, 0.62198 * es / (780.0::double - es) as ws from b)
select ts, i, j, round(100 * (0.008::double / (0.62198 + 0.008::double)) * ((0.62198 + ws) / ws) @6) as rh from c""")
def rel_humidity(spark, d):
    t = v.wx(spark, d).filter(F.col("var") == "T2").withColumn("t2", F.col("value") * 10 + 290)
    return t.select("ts", "i", "j", r(air.relative_humidity(F.col("t2"), F.lit(0.008), F.lit(78000.0))).alias("rh"))


def _clim(spark, d):
    return settle(impute.climatology(v.obs_daily(spark, d)), "climatology")


def _lloyd_sql(steps):
    """The same steps in SQL, written out: z, starts, then assignment and centers in turn."""
    out = ["""h as (select month, day, hour, avg(val) as m from clim group by 1, 2, 3), f as (select id_est, month, day, hour, coalesce(val, m) as x, m from clim join h using (month, day, hour)),
s as (select month, day, hour, stddev_pop(x) as sd from f group by 1, 2, 3),
z as (select id_est, month, day, hour, case when sd > 0 then (x - m) / sd else 0 end as z from f join s using (month, day, hour)),
r as (select id_est, row_number() over (order by sum(z * z), id_est) - 1 as r, count(*) over () as n from z group by id_est),
c0 as (select k.c as cluster, month, day, hour, z as c from (values (0), (1), (2)) k(c) join r on r.r = floor(k.c * (n - 1) / 2.0::double) join z using (id_est))"""]
    for i in range(1, steps + 1):
        out.append(f"""a{i} as (select id_est, cluster from (select id_est, cluster, row_number() over (partition by id_est order by sum((z - c) * (z - c)), cluster) as nth
  from z join c{i - 1} using (month, day, hour) group by id_est, cluster) where nth = 1)""")
        out.append(f"c{i} as (select cluster, month, day, hour, avg(z) as c from z join a{i} using (id_est) group by 1, 2, 3, 4)")
    return ",\n".join(out)


LLOYD = f"with {v.OBS_DAILY}, {CLIM_TAIL.format(obs='obs_daily')},\n{_lloyd_sql(8)}"


@query("station_clusters", f"{LLOYD} select 'otres' as pollutant, id_est, cluster from a8")
def station_clusters(spark, d):
    return cluster.clusters(_clim(spark, d))


@query("clusters_settled", "select 0 as moved")
def clusters_settled(spark, d):
    """One more step from the result moves no station."""
    c = _clim(spark, d)
    z, a = cluster.standardized(c), cluster.clusters(c)
    again = cluster._nearest(z, settle(cluster.centers_of(z, a), "centers"))
    return again.exceptAll(a).agg(F.count(F.lit(1)).cast("int").alias("moved"))


@query("cluster_profiles", f"{LLOYD} select 'otres' as pollutant, cluster, month, day, hour, round(avg(val) @6) as val from clim join a8 using (id_est) group by 2, 3, 4, 5")
def cluster_profiles(spark, d):
    c = _clim(spark, d)
    return cluster.cluster_profiles(c, cluster.clusters(c)).select("pollutant", "cluster", *cluster.KEY, r("val").alias("val"))


@query("station_distance", f"""with {v.OBS_DAILY}, {CLIM_TAIL.format(obs='obs_daily')},
h as (select month, day, hour, avg(val) as m from clim group by 1, 2, 3), f as (select id_est, month, day, hour, coalesce(val, m) as x, m from clim join h using (month, day, hour)),
s as (select month, day, hour, stddev_pop(x) as sd from f group by 1, 2, 3)
select 'otres' as pollutant, id_est, round(sqrt(sum(case when sd > 0 then ((x - m) / sd) ** 2 else 0 end)) @6) as distance from f join s using (month, day, hour) group by 2""")
def station_distance(spark, d):
    return cluster.distance_to_mean(_clim(spark, d)).select("pollutant", "id_est", r("distance").alias("distance"))
