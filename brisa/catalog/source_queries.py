"""Scans, sinks, listings, delivery tables, name parsing and scalar indices."""

from __future__ import annotations

from pyspark.sql import functions as F

from brisa.catalog import views as v
from brisa.catalog.base import query, r, rounded
from brisa.catalog.window_queries import _cyc_sql
from brisa.functions import air, clock, names
from brisa.operators import experiments, panel
from brisa.plans.merge_panel import merge_panel as merge
from brisa.session import work_path
from brisa.sources import inventory, readers, sinks

S5 = ["S00", "S01", "S02", "S03", "S04"]


# ---- scans and sinks -----------------------------------------------------------------

@query("scan_yearly_csv", f"with {v.OBS_DAILY} select fecha, pollutant, id_est, round(val @6) as val from obs_daily")
def scan_yearly_csv(spark, d):
    base = work_path(spark, "yearly")
    wide = panel.pivot(v.obs_daily(spark, d), [("otres", s) for s in S5])
    text = F.when(F.hour("fecha") == 0, F.date_format("fecha", "yyyy-MM-dd")).otherwise(F.date_format("fecha", "yyyy-MM-dd HH:mm:ss"))
    out = wide.select(text.alias("fecha"), *wide.columns[1:], F.year("fecha").alias("year"))
    # two halves whose columns stand in another order, as in files of different years
    for odd in (True, False):
        cols = ["fecha", *(wide.columns[1:] if odd else wide.columns[:0:-1]), "year"]
        out.filter((F.col("year") % 2 == 1) == odd).select(cols).write.mode("append").option("header", True).partitionBy("year").csv(base)
    back = panel.unpivot(readers.yearly_csv(spark, base))
    return back.filter(F.col("val").isNotNull()).select("fecha", "pollutant", "id_est", r("val").alias("val"))


@query("export_series", f"with {v.OBS5X4} select pollutant, id_est, count(*) as n, round(sum(val) @6) as total from obs5x4 group by 1, 2")
def export_series(spark, d):
    path = work_path(spark, "series")
    sinks.export_series(v.obs5x4(spark, d), path)
    return spark.read.parquet(path).groupBy("pollutant", "id_est").agg(F.count(F.lit(1)).alias("n"), r(F.sum("val")).alias("total"))


@query("snapshot_once", f"with {v.OBS5X4} select pollutant, count(*) as n, round(sum(val) @6) as total from obs5x4 group by 1")
def snapshot_once(spark, d):
    """The second writer finds the first one's table."""
    path, o = work_path(spark, "snapshot"), v.obs5x4(spark, d)
    sinks.snapshot(o, path)
    again = sinks.snapshot(o.withColumn("val", F.lit(0.0)), path)
    return again.groupBy("pollutant").agg(F.count(F.lit(1)).alias("n"), r(F.sum("val")).alias("total"))


@query("params_once", f"with {v.OBS5X4} select pollutant as name, round(avg(val) @6) as mean, round(stddev_pop(val) @6) as std from obs5x4 group by 1")
def params_once(spark, d):
    path = work_path(spark, "params")
    p = v.obs5x4(spark, d).groupBy(F.col("pollutant").alias("name")).agg(F.avg("val").alias("mean"), F.stddev_pop("val").alias("std"))
    sinks.write_params_once(p, path)
    return rounded(sinks.write_params_once(p.withColumn("mean", F.lit(9.0)), path))


@query("copy_table", f"with {v.OBS5X4} select pollutant, id_est, cast(2 * count(*) as bigint) as n, round(2 * sum(val) @6) as total from obs5x4 group by 1, 2")
def copy_table(spark, d):
    """A delivered table copied twice into another store."""
    a, b = work_path(spark, "store-a"), work_path(spark, "store-b")
    v.obs5x4(spark, d).write.parquet(a)
    for _ in range(2):
        sinks.copy_table(spark, a, b, ["pollutant"])
    return spark.read.parquet(b).groupBy("pollutant", "id_est").agg(F.count(F.lit(1)).alias("n"), r(F.sum("val")).alias("total"))


@query("save_columns", f"with {v.OBS12}, s as (select distinct id_est from obs12) select 0 as pos, 'fecha' as name union all select cast(row_number() over (order by id_est) as int), 'cont_otres_' || id_est from s")
def save_columns(spark, d):
    path, o = work_path(spark, "columns"), v.obs12(spark, d)
    stations = sorted(x[0] for x in o.select("id_est").distinct().collect())
    sinks.save_columns(panel.pivot(o, [("otres", s) for s in stations]), path)
    return spark.read.json(path).select(F.col("pos").cast("int").alias("pos"), "name")


@query("export_by_year", f"with {v.OBS_DAILY} select year(fecha) as year, count(*) as n, round(sum(val) @6) as total from obs_daily group by 1")
def export_by_year(spark, d):
    path = work_path(spark, "years")
    sinks.export_by_year(v.obs_daily(spark, d), path)
    return spark.read.parquet(path).groupBy("year").agg(F.count(F.lit(1)).alias("n"), r(F.sum("val")).alias("total"))


@query("export_by_horizon", f"with {v.FC} select predicted_hour, count(*) as n, round(sum(pred) @4) as total from fc group by 1")
def export_by_horizon(spark, d):
    path = work_path(spark, "horizons")
    sinks.export_by_horizon(v.fc_long(spark, d), path)
    return spark.read.parquet(path).groupBy("predicted_hour").agg(F.count(F.lit(1)).alias("n"), r(F.sum("pred"), 4).alias("total"))


@query("scan_obs", f"with {v.OBS5X4} select pollutant, id_est, count(*) as n, round(sum(val) @6) as total from obs5x4 where pollutant = 'nox' and fecha >= timestamp '2024-01-10' group by 1, 2")
def scan_obs(spark, d):
    path = work_path(spark, "obs")
    sinks.write_obs(v.obs5x4(spark, d), path)
    o = panel.fetch(readers.scan_obs(spark, path), "nox", "2024-01-10", "2025-01-01")
    return o.groupBy("pollutant", "id_est").agg(F.count(F.lit(1)).alias("n"), r(F.sum("val")).alias("total"))


PARAM_NAMES = ["O3", "NO2", "NO", "CO", "PM10", "PM2.5", "TMP", "XYZ"]


def _agency_lines(spark, d):
    e = v.table(spark, d, "events")
    h = F.hour("ts") + 1
    param = F.element_at(F.array(*[F.lit(p) for p in PARAM_NAMES]), (F.col("event_id") % 8 + 1).cast("int"))
    value = F.when(F.col("event_id") % 11 == 0, "").when(F.col("event_id") % 13 == 0, "n/a").otherwise(F.col("value").cast("string"))
    data = e.select("event_id", F.concat(F.date_format("ts", "dd/MM/yyyy"), F.lit(" "), h.cast("string"), F.lit(":00,S"), (F.col("user_id") % 9).cast("string"),
                             F.lit(","), param, F.lit(","), value, F.lit(",1")).alias("value"))
    # every 17th line is cut short after its parameter
    data = data.withColumn("value", F.when(F.col("event_id") % 17 == 0, F.regexp_extract("value", "^[^,]*,[^,]*,[^,]*", 0)).otherwise(F.col("value"))).drop("event_id")
    head = spark.range(readers.AGENCY_HEADER_LINES).select(F.concat(F.lit("Network header line "), F.col("id").cast("string")).alias("value"))
    return head.unionByName(data)


AGENCY_SQL = """a as (select event_id, date_trunc('day', ts) + to_hours(hour(ts)) as fecha, 'S' || (user_id % 9) as id_est, value,
  ['cont_otres','cont_nodos','cont_no','cont_co','cont_pmdiez','cont_pmdoscinco','met_tmp',null][event_id % 8 + 1] as tab from events)"""


@query("load_agency_csv", f"""with {AGENCY_SQL} select fecha, tab as "table", id_est, round(value @6) as val from a where tab is not null and event_id % 11 <> 0 and event_id % 13 <> 0 and event_id % 17 <> 0""")
def load_agency_csv(spark, d):
    path = work_path(spark, "agency")
    _agency_lines(spark, d).write.text(path)
    rows, _bad = readers.agency_csv(spark, path)
    return rows.select("fecha", "table", "id_est", r("val").alias("val"))


@query("load_agency_csv_bad", f"""with {AGENCY_SQL} select count(*) as n from a where tab is null or event_id % 17 = 0 or (event_id % 11 <> 0 and event_id % 13 = 0)""")
def load_agency_csv_bad(spark, d):
    path = work_path(spark, "agency")
    _agency_lines(spark, d).write.text(path)
    return readers.agency_csv(spark, path)[1].agg(F.count(F.lit(1)).alias("n"))


FC_STATIONS = [f"S{k:02d}" for k in range(10)]


@query("load_forecast_csvs", f"""with {v.FC}, g as (select model, predicted_hour, ts, station, avg(target) as target, avg(pred) as pred from fc group by 1, 2, 3, 4),
f as (select model, predicted_hour, count(distinct ts) as n_rows from fc group by 1, 2)
select model, '1224_101112' as run, predicted_hour, station, max(n_rows) as n_rows, count(target) as n_values, round(sum(target) @4) as target, round(sum(pred) @4) as pred
from g join f using (model, predicted_hour) group by 1, 3, 4""")
def load_forecast_csvs(spark, d):
    base = work_path(spark, "forecasts")
    cols = [F.avg(F.when(F.col("station") == s, F.col(k))).alias(f"{k}_cont_otres_{s}") for s in FC_STATIONS for k in ("target", "pred")]
    wide = v.fc_long(spark, d).groupBy("model", "predicted_hour", "ts").agg(*cols)
    head = ["timestamp", *[c for c in wide.columns if "_cont_" in c]]
    line = F.concat_ws(",", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in head[1:]])
    body = wide.select("model", "predicted_hour", line.alias("value"))
    first = wide.select("model", "predicted_hour").distinct().withColumn("value", F.lit(",".join(head)))
    both = body.unionByName(first).withColumn("run", F.lit("1224_101112"))
    both.hint("rebalance", "model", "predicted_hour").write.partitionBy("model", "run", "predicted_hour").text(base)
    f = readers.forecast_lines(spark, base, glob="*.txt")

    def part(name):
        return F.regexp_extract("path", rf"{name}=([^/]+)", 1)

    return f.groupBy(part("model").alias("model"), part("run").alias("run"), part("predicted_hour").cast("int").alias("predicted_hour"), "station").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("target").alias("n_values"), r(F.sum("target"), 4).alias("target"), r(F.sum("pred"), 4).alias("pred"))


# ---- listings --------------------------------------------------------------------------

def _wrf_listing(spark, d):
    o = v.table(spark, d, "orders")
    k = F.col("o_orderkey")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    path = F.concat(F.lit("/data/wrf/"), F.year("o_orderdate").cast("string"), F.lit("/"), names.month_dir(F.col("o_orderdate")), F.lit("/wrfout_d0"),
                    (1 + k % 2).cast("string"), F.lit("_"), day, F.lit("_00.nc"))
    return o.select(path.alias("path"), ((k % 40 + 1) * 100000).alias("length")).groupBy("path").agg(F.max("length").alias("length"))


WRF_SQL = """files as (select '/data/wrf/' || year(o_orderdate) || '/' ||
    ['01_enero','02_febrero','03_marzo','04_abril','05_mayo','06_junio','07_julio','08_agosto','09_septiembre','10_octubre','11_noviembre','12_diciembre'][month(o_orderdate)]
    || '/wrfout_d0' || (1 + o_orderkey % 2) || '_' || strftime(o_orderdate, '%Y-%m-%d') || '_00.nc' as path, 'd0' || (1 + o_orderkey % 2) as domain,
    o_orderdate as day, max((o_orderkey % 40 + 1) * 100000) as length from orders group by 1, 2, 3)"""


@query("wrf_inventory", f"with {WRF_SQL} select path, domain, day from files where domain = 'd02' and day >= timestamp '1997-01-01' and day < timestamp '1999-06-01'")
def wrf_inventory(spark, d):
    return inventory.wrf_files(_wrf_listing(spark, d), "1997-01-01", "1999-06-01")


@query("wrf_inventory_old", """select distinct '/old/a' || year(o_orderdate) || '/salidas/wrfout_c1h_d01_' || strftime(o_orderdate, '%Y-%m-%d') || '_00:00:00.a' || year(o_orderdate) as path,
  o_orderdate as day, '/old/a' || year(o_orderdate) || '/salidas/wrfout_c15d_d01_' || year(o_orderdate) || '-01-01_00:00:00.a' || year(o_orderdate) as coords_path
from orders where o_orderdate >= timestamp '1997-01-01' and o_orderdate < timestamp '1999-06-01'""")
def wrf_inventory_old(spark, d):
    y = F.year("o_orderdate").cast("string")
    path = F.concat(F.lit("/old/a"), y, F.lit("/salidas/wrfout_c1h_d01_"), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("_00:00:00.a"), y)
    return inventory.wrf_files_old(v.table(spark, d, "orders").select(path.alias("path")).distinct(), "1997-01-01", "1999-06-01")


def _days(spark, d):
    files = inventory.wrf_files(_wrf_listing(spark, d), "1995-01-01", "2002-01-01").join(_wrf_listing(spark, d), "path").select("day", "length")
    req = v.table(spark, d, "orders").select(F.col("o_orderdate").cast("timestamp_ntz").alias("day")).distinct()
    return req, files


@query("file_gap_report", f"""with {WRF_SQL}, f as (select day, length from files where domain = 'd02'), req as (select distinct o_orderdate as day from orders),
b as (select cast(count_if(length < 0.3 * 1024 * 1024) as bigint) >= 2 as broken_run from req join f using (day))
select req.day, f.length::double as length, broken_run, case when f.length is not null and not broken_run then 'present' else 'missing' end as status from req left join f using (day), b""")
def file_gap_report(spark, d):
    req, files = _days(spark, d)
    return inventory.gap_report(req, files).withColumn("length", F.col("length").cast("double"))


@query("removable_files", f"with {WRF_SQL} select day, length from files where domain = 'd02' and day not in (select o_orderdate from orders where o_orderstatus = 'F')")
def removable_files(spark, d):
    _req, files = _days(spark, d)
    need = v.table(spark, d, "orders").filter(F.col("o_orderstatus") == "F").select(F.col("o_orderdate").cast("timestamp_ntz").alias("day"))
    return inventory.removable(need, files)


@query("latest_available", f"""with {WRF_SQL}, f as (select day from files where domain = 'd02')
select coalesce(max(day) filter (day <= timestamp '2001-08-03' and day > timestamp '2001-08-03' - interval 7 day), timestamp '2023-05-05') as day,
  case when count(*) filter (day <= timestamp '2001-08-03' and day > timestamp '2001-08-03' - interval 7 day) = 0 then 1 else 0 end as is_default from f""")
def latest_available(spark, d):
    return inventory.latest_available(_days(spark, d)[1], "2001-08-03")


@query("source_fallback", f"""with {WRF_SQL}, f as (select distinct day from files where domain = 'd02'), req as (select distinct o_orderdate + interval 1 day as day from orders)
select req.day, case when req.day in (select day from f) then req.day when req.day - interval 1 day in (select day from f) then req.day - interval 1 day end as use_day from req""")
def source_fallback(spark, d):
    req, files = _days(spark, d)
    return inventory.with_fallback(req.select(clock.shift_hours(F.col("day"), 24).alias("day")), files)


@query("discover_runs", """with l as (select p_type || '_' || p_size as model, case when p_partkey % 3 = 0 then 'tmp' else printf('%02d%02d_%06d', p_size % 12 + 1, p_partkey % 28 + 1, p_partkey) end as run,
  case when p_partkey % 5 = 0 then 'config.json' else 'model_best.pth' end as f from part)
select distinct model, run from l where f = 'model_best.pth' and regexp_matches(run, '^[0-9]{4}_[0-9]{6}')""")
def discover_runs(spark, d):
    p = v.table(spark, d, "part")
    k, s = F.col("p_partkey"), F.col("p_size")
    run = F.when(k % 3 == 0, "tmp").otherwise(F.format_string("%02d%02d_%06d", s % 12 + 1, k % 28 + 1, k))
    f = F.when(k % 5 == 0, "config.json").otherwise("model_best.pth")
    return inventory.trained_runs(p.select(F.concat_ws("/", F.lit("/models"), F.concat_ws("_", "p_type", s.cast("string")), run, f).alias("path")))


@query("log_status", f"""with {v.LOGS}, s as (select path, regexp_extract(path, '([^/]*)_[^_/]*_[^_/]*[.]log$', 1) as config, case when contains(content, 'Training completed successfully') then 'success' when contains(content, 'Training timed out') then 'timeout'
  when contains(content, 'Exception occurred') then 'exception' else 'failed' end as status, regexp_extract(path, 'gpu([0-9]+)', 1) as gpu_id,
  regexp_extract(content, 'Started at: ([^\n]+)', 1) as started, regexp_extract(content, 'Completed at: ([^\n]+)', 1) as completed from logs) select * from s""")
def log_status(spark, d):
    return inventory.log_status(v.logs(spark, d))


@query("config_logs", f"""with {v.LOGS}, s as (select path, case when contains(content, 'Training completed successfully') then 'success' when contains(content, 'Training timed out') then 'timeout'
  when contains(content, 'Exception occurred') then 'exception' else 'failed' end as status, regexp_extract(path, '([^/]*)_[^_/]*_[^_/]*[.]log$', 1) as config from logs)
select config, string_agg(path, ',' order by path) as log_files, max_by(status, path) as status, cast(count_if(status = 'success') as bigint) as n_success from s group by 1""")
def config_logs(spark, d):
    return inventory.config_logs(inventory.log_status(v.logs(spark, d)))


@query("log_summary", f"""with {v.LOGS} select count(*) as total, cast(count_if(contains(content, 'Training completed')) as bigint) as success, cast(count_if(contains(content, 'timed out')) as bigint) as timeout,
  cast(count_if(contains(content, 'Exception')) as bigint) as exception, cast(count_if(contains(content, 'stopped')) as bigint) as failed, round(cast(count_if(contains(content, 'Training completed')) as bigint) * 100.0::double / count(*), 1) as success_rate from logs""")
def log_summary(spark, d):
    return inventory.log_summary(inventory.log_status(v.logs(spark, d)))


@query("error_categories", """with m as (select case o_orderpriority when '1-URGENT' then 'No hay suficientes datos: ' || o_orderkey when '2-HIGH' then 'cont_x not in index' when '5-LOW' then 'WRF file broken' else 'boom' end as msg from orders)
select case when contains(lower(msg), 'no hay suficientes datos') then 'datos_insuficientes' when contains(lower(msg), 'not in index') then 'datos_faltantes' when contains(lower(msg), 'wrf') then 'errores_wrf' else 'otros_errores' end as category,
  count(*) as n from m group by 1""")
def error_categories(spark, d):
    from brisa.operators.forecast import error_category
    p = F.col("o_orderpriority")
    msg = (F.when(p == "1-URGENT", F.concat(F.lit("No hay suficientes datos: "), F.col("o_orderkey").cast("string"))).when(p == "2-HIGH", "cont_x not in index")
           .when(p == "5-LOW", "WRF file broken").otherwise("boom"))
    return v.table(spark, d, "orders").groupBy(error_category(msg).alias("category")).agg(F.count(F.lit(1)).alias("n"))


@query("detect_date_format", """with l as (select 'f' || (o_custkey % 8) as path, case when o_custkey % 2 = 0 then day(o_orderdate) else month(o_orderdate) end as a,
  case when o_custkey % 2 = 0 then month(o_orderdate) else day(o_orderdate) end as b from orders)
select path, case when max(a) > 12 then 'DD/MM/YYYY/HH24' when max(b) > 12 then 'MM/DD/YYYY/HH24' end as date_format from l group by 1""")
def detect_date_format(spark, d):
    k = F.col("o_custkey")
    tail = F.lit(" 01:00,PED,O3,1")
    line = F.when(k % 2 == 0, F.concat(F.date_format("o_orderdate", "dd/MM/yyyy"), tail)).otherwise(F.concat(F.date_format("o_orderdate", "MM/dd/yyyy"), tail))
    o = v.table(spark, d, "orders").select(F.concat(F.lit("f"), (k % 8).cast("string")).alias("path"), line.alias("value"))
    return readers.detect_date_format(o)


# ---- delivery --------------------------------------------------------------------------

DELIVER_SQL = f"""{v.OBS12}, f as (select date_trunc('day', fecha) as origin, id_est, hour(fecha) + 1 as horizon, val as value from obs12)"""


def _fc(spark, d):
    o = v.obs12(spark, d)
    return o.select(F.date_trunc("day", "fecha").cast("timestamp_ntz").alias("origin"), "pollutant", "id_est", (F.hour("fecha") + 1).alias("horizon"), F.col("val").alias("value"))


HOUR_SQL = ", ".join(f"round(max(value + 1e-9) filter (horizon = {h}), 2) as hour_p{h:02d}" for h in range(1, 25))


@query("deliver_ozone", f"with {DELIVER_SQL} select origin as fecha, 7 as id_tipo_pronostico, id_est, '-1' as val, {HOUR_SQL} from f where id_est in ('S01', 'S05', 'S11') group by 1, 3")
def deliver_ozone(spark, d):
    return sinks.deliver_stations(_fc(spark, d).withColumn("value", F.col("value") + 1e-9), ["S01", "S05", "S11", "S77"])


def _stat_sql():
    cols = [f"round(max(value + 1e-9) filter (stat = '{s}' and horizon = {h}), 2) as {n}_hour_p{h:02d}" for s, n in sinks.STAT_NAMES.items() for h in range(1, 25)]
    return f"""with {v.OBS5X4}, a as (select fecha, pollutant, min(val) as mn, max(val) as mx, avg(val) as av from obs5x4 where pollutant <> 'otres' group by 1, 2),
u as (select fecha, pollutant, 'min' as stat, mn as value from a union all select fecha, pollutant, 'max', mx from a union all select fecha, pollutant, 'mean', av from a),
f as (select date_trunc('day', fecha) as fecha, hour(fecha) + 1 as horizon, pollutant, stat, value from u)
select fecha, pollutant, stat, 'NET' as id_est, '-1' as val, case when pollutant = 'nox' then 7.0::double end as id_tipo_pronostico, 'forecast_' || pollutant as "table", {', '.join(cols)} from f group by 1, 2, 3"""


@query("deliver_stats", _stat_sql())
def deliver_stats(spark, d):
    from brisa.operators import stats
    s = stats.station_stats(v.obs5x4(spark, d)).filter(F.col("pollutant") != "otres")
    f = s.select(F.date_trunc("day", "fecha").cast("timestamp_ntz").alias("origin"), "pollutant", "id_est", (F.hour("fecha") + 1).alias("horizon"), (F.col("val") + 1e-9).alias("value"))
    return sinks.deliver_stats(f).withColumn("id_tipo_pronostico", F.col("id_tipo_pronostico").cast("double"))


@query("upsert_forecast", f"""with {DELIVER_SQL}, g as (select origin, id_est, horizon, round(value @6) as value, 'old' as src from f where origin < timestamp '2024-01-20'),
n as (select origin, id_est, horizon, round(value * 2 @6) as value, 'new' as src from f where origin >= timestamp '2024-01-15')
select * from n union all select * from g where not exists (select 1 from n where n.origin = g.origin and n.id_est = g.id_est and n.horizon = g.horizon)""")
def upsert_forecast(spark, d):
    f = _fc(spark, d).drop("pollutant")
    cut = lambda s: F.lit(s).cast("timestamp_ntz")
    old = f.filter(F.col("origin") < cut("2024-01-20")).withColumns({"value": r("value"), "src": F.lit("old")})
    new = f.filter(F.col("origin") >= cut("2024-01-15")).withColumns({"value": r(F.col("value") * 2), "src": F.lit("new")})
    return sinks.upsert(old, new, ["origin", "id_est", "horizon"])


@query("delete_from_year", f"with {v.OBS_DAILY} select year(fecha) as year, count(*) as n from obs_daily where year(fecha) < 1999 group by 1")
def delete_from_year(spark, d):
    return sinks.delete_from_year(v.obs_daily(spark, d), 1999).groupBy(F.year("fecha").alias("year")).agg(F.count(F.lit(1)).alias("n"))


# ---- scalar functions ------------------------------------------------------------------

IMECA_CASES = [("otres", "O3", 0.001), ("co", "CO", 0.1), ("nodos", "NO2", 0.002), ("no", "PM10", 4.0), ("nox", "PM2.5", 3.0)]
IM_SQL = f"""{v.OBS5X4}, m as (select fecha, id_est, case pollutant {' '.join(f"when '{c}' then '{n}'" for c, n, _ in IMECA_CASES)} end as p,
  val * case pollutant {' '.join(f"when '{c}' then {k}::double" for c, _, k in IMECA_CASES)} end as c from obs5x4)"""


def _imeca_input(spark, d):
    p, k = None, None
    for code, name, factor in IMECA_CASES:
        cond = F.col("pollutant") == code
        p = F.when(cond, name) if p is None else p.when(cond, name)
        k = F.when(cond, F.lit(factor)) if k is None else k.when(cond, F.lit(factor))
    return v.obs5x4(spark, d).select("fecha", "id_est", p.alias("p"), (F.col("val") * k).alias("c"))


# Fixed values, written out once more: breakpoints of the index.
IMECA_SQL = """case p
  when 'O3' then case when c <= 0.070::double then c * 714.29::double when c <= 0.095::double then (c - 0.071::double) * 2041.67::double + 51
                      when c <= 0.154::double then (c - 0.096::double) * 844.83::double + 101 when c <= 0.204::double then (c - 0.155::double) * 1000 + 151
                      when c <= 0.404::double then (c - 0.205::double) * 497.49::double + 201 else c * 1000 - 104 end
  when 'SO2' then c * (100 / 0.13::double) when 'NO2' then c * (100 / 0.21::double) when 'CO' then c * (100 / 11::double)
  when 'PM10' then case when c <= 40 then c * 1.25::double when c <= 75 then (c - 41) * 1.4412::double + 51 when c <= 214 then (c - 76) * 0.3551::double + 101
                        when c <= 354 then (c - 215) * 0.3525::double + 151 when c <= 424 then (c - 355) * 1.4348::double + 201 else c - 104 end
  when 'PM2.5' then case when c <= 12 then c * 4.1667::double when c <= 45 then (c - 12.1::double) * 1.4894::double + 51 when c <= 97.4::double then (c - 45.1::double) * 0.9369::double + 101
                         when c <= 150.4::double then (c - 97.5::double) * 0.9263::double + 151 when c <= 250.4::double then (c - 150.5::double) * 0.991::double + 201
                         else (c - 350.5::double) * 0.6604::double + 401 end end"""


def _imeca_sql():
    return f"""with {IM_SQL}, i as (select *, {IMECA_SQL} as raw from m)
select fecha, id_est, p, round_even(raw, 0) as imeca, case when raw < 51 then 'Buena' when raw < 101 then 'Regular' when raw < 151 then 'Mala' when raw < 201 then 'Muy Mala' else 'Extremadamente Mala' end as category from i"""


@query("imeca", _imeca_sql())
def imeca(spark, d):
    c, p = F.col("c"), F.col("p")
    return _imeca_input(spark, d).select("fecha", "id_est", "p", air.imeca(c, p).alias("imeca"), air.imeca_category(c, p).alias("category"))


def _category(*limits):
    return "case " + " ".join(f"when c <= {x}::double then '{n}'" for x, n in zip(limits, ("Buena", "Aceptable", "Mala", "Muy Mala"))) + " else 'Extremadamente Mala' end"


@query("aq_category", f"""with {IM_SQL} select fecha, id_est, p, case p when 'PM10' then {_category(45, 60, 132, 213)} when 'PM2.5' then {_category(15, 33, 79, 130)}
  when 'O3' then {_category(0.058, 0.090, 0.135, 0.175)} end as category from m""")
def aq_category(spark, d):
    return _imeca_input(spark, d).select("fecha", "id_est", "p", air.aq_category(F.col("c"), F.col("p")).alias("category"))


@query("tz_shift", "select event_id, ts + interval 6 hour as utc, ts - interval 6 hour as local from (select event_id, date_trunc('second', ts) as ts from events)")
def tz_shift(spark, d):
    ts = F.date_trunc("second", "ts").cast("timestamp_ntz")
    return v.table(spark, d, "events").select("event_id", clock.to_utc(ts).alias("utc"), clock.to_local(ts).alias("local"))


@query("round_hour", "select event_id, make_timestamp(cast(round_even(epoch_us(ts) / 3.6e9, 0) as bigint) * 3600000000) as hour from events")
def round_hour(spark, d):
    return v.table(spark, d, "events").select("event_id", clock.round_hour(F.col("ts")).alias("hour"))


@query("month_folder", """select o_orderkey, ['01_enero', '02_febrero', '03_marzo', '04_abril', '05_mayo', '06_junio', '07_julio', '08_agosto', '09_septiembre', '10_octubre',
  '11_noviembre', '12_diciembre'][month(o_orderdate)] as folder from orders""")
def month_folder(spark, d):
    return v.table(spark, d, "orders").select("o_orderkey", clock.month_folder(F.month("o_orderdate")).alias("folder"))


TAGS = ["PM2.5", "PM10", "NOX", "CO2", "PMCO", "CO", "NO2", "NO", "O3", "SO2", "TMP", "RH", "WSP", "WDR", "PBA", "NONE?"]


@query("param_table", f"""with n as (select p_partkey, p_brand || '_' || [{', '.join(f"'{t}'" for t in TAGS)}][p_partkey % 16 + 1] || '_2011.csv' as name from part)
select p_partkey, name, case when contains(name, 'PM2.5') then 'cont_pmdoscinco' when contains(name, 'PM10') then 'cont_pmdiez' when contains(name, 'NOX') then 'cont_nox'
  when contains(name, 'CO2') then 'cont_codos' when contains(name, 'PMCO') then 'cont_pmco' when contains(name, 'CO') then 'cont_co' when contains(name, 'NO2') then 'cont_nodos'
  when contains(name, 'NO') then 'cont_no' when contains(name, 'O3') then 'cont_otres' when contains(name, 'SO2') then 'cont_sodos' when contains(name, 'TMP') then 'met_tmp'
  when contains(name, 'RH') then 'met_rh' when contains(name, 'WSP') then 'met_wsp' when contains(name, 'WDR') then 'met_wdr' when contains(name, 'PBA') then 'met_pba' end as "table" from n""")
def param_table(spark, d):
    tag = F.element_at(F.array(*[F.lit(t) for t in TAGS]), (F.col("p_partkey") % 16 + 1).cast("int"))
    p = v.table(spark, d, "part").select("p_partkey", F.concat("p_brand", F.lit("_"), tag, F.lit("_2011.csv")).alias("name"))
    return p.withColumn("table", names.param_table(F.col("name")))


@query("parse_mixed_ts", """select o_orderkey, case when o_orderkey % 3 = 0 then o_orderdate when o_orderkey % 3 = 1 then o_orderdate + to_hours(o_orderkey % 24) end as ts from orders""")
def parse_mixed_ts(spark, d):
    k = F.col("o_orderkey")
    full = clock.shift_hours(F.col("o_orderdate"), k % 24)
    text = (F.when(k % 3 == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).when(k % 3 == 1, F.date_format(full, "yyyy-MM-dd HH:mm:ss")).otherwise("not a date"))
    return v.table(spark, d, "orders").select("o_orderkey", clock.parse_mixed(text).alias("ts"))


@query("parse_names", f"""with {WRF_SQL.replace('files as', 'w as')} select path, domain, strftime(day, '%Y-%m-%d') as day, '00' as hour from w
union all select distinct 'out/M' || o_custkey % 9 || '-epoch' || o_orderkey % 50 || '/x_forecast_' || (1 + o_orderkey % 24) || '.csv', 'M' || o_custkey % 9, null, cast(1 + o_orderkey % 24 as varchar) from orders""")
def parse_names(spark, d):
    w = _wrf_listing(spark, d)
    p = names.wrf_parts(F.col("path"))
    k = F.col("o_orderkey")
    f = v.table(spark, d, "orders").select(F.concat(F.lit("out/M"), (F.col("o_custkey") % 9).cast("string"), F.lit("-epoch"), (k % 50).cast("string"), F.lit("/x_forecast_"),
                                                    (1 + k % 24).cast("string"), F.lit(".csv")).alias("path")).distinct()
    model = F.element_at(F.split(names.model_prefix(F.col("path")), "/"), -1)
    return w.select("path", p["domain"].alias("domain"), p["day"].alias("day"), p["hour"].alias("hour")).unionByName(
        f.select("path", model.alias("domain"), F.lit(None).cast("string").alias("day"), names.forecast_hour(F.col("path")).cast("string").alias("hour")))


@query("param_grid", """with a as (select distinct 24 + 12 * (p_size % 2) as prev from part), t as (select distinct (p_size % 3 + 2) / 2.0::double as th from part), w as (select distinct 4 + 2 * (p_size % 2) as pw from part),
n as (select 9 as k union select 3)
select cast(prev as int) as prev_pollutant_hours, th as bootstrap_threshold, cast(pw as int) as prev_weather_hours, k as n_pollutants, 30 + (k - 1) * 3 + 12 as input_features, cast(pw + 2 + 1 as int) as weather_time_dims,
  'Parallel_' || case when k = 9 then 'all' else 'co_nodos_otres' end || '_prev' || prev || '_heads8_w6_p6_ar8_bootstrapTrue_thresh' || th || '_weather' || pw || '_2' as name from a, t, w, n""")
def param_grid(spark, d):
    size = F.col("p_size")
    lists = v.table(spark, d, "part").agg(F.collect_set(24 + (size % 2) * 12).alias("a"), F.collect_set((size % 3 + 2) / F.lit(2.0)).alias("t"), F.collect_set(4 + (size % 2) * 2).alias("w"))
    nine = ["co", "nodos", "otres", "pmdiez", "pmdoscinco", "nox", "no", "sodos", "pmco"]
    sets = F.array(F.array(*[F.lit(x) for x in nine]), F.array(*[F.lit(x) for x in nine[:3]]))
    g = experiments.param_grid(lists, {"prev_pollutant_hours": F.col("a"), "bootstrap_threshold": F.col("t"), "prev_weather_hours": F.col("w"), "pollutants": sets})
    g = g.withColumns({"attention_heads": F.lit(8), "weather_blocks": F.lit(6), "pollution_blocks": F.lit(6), "auto_regresive_steps": F.lit(8), "next_weather_hours": F.lit(2)})
    return experiments.derived(g).select("prev_pollutant_hours", "bootstrap_threshold", "prev_weather_hours", F.size("pollutants").alias("n_pollutants"), "input_features", "weather_time_dims", "name")


MVARS = ["T2", "U10", "V10", "RAINC", "RAINNC"]


@query("merge_panel", f"""with {v.OBS12}, {v.WX}, m as (select ts, var, avg(value) as value from wx group by 1, 2), days as (select distinct date_trunc('day', ts) as day from m),
o as (select * from obs12 where date_trunc('day', fecha) in (select day from days) and date_trunc('day', fecha) + interval 1 day in (select day from days)),
p as (select fecha, {', '.join(f"round(max(val) filter (id_est = 'S{k:02d}') @6) as cont_otres_S{k:02d}" for k in range(12))} from o group by 1),
l as (select ts - to_hours(k) as fecha, {', '.join(f"round(coalesce(max(value) filter (var = '{x}' and k = {k}), 0) @6) as {x}_h{k}" for k in range(24) for x in MVARS)} from m, generate_series(0, 23) g(k) group by 1)
select p.*, {', '.join(f"coalesce({x}_h{k}, 0.0::double) as {x}_h{k}" for k in range(24) for x in MVARS)}, {', '.join(f'round({e} @6) as {n}' for n, e in _cyc_sql('p.fecha'))} from p left join l on l.fecha = p.fecha""")
def merge_panel(spark, d):
    m = v.wx(spark, d).groupBy("ts", "var").agg(F.avg("value").alias("value"))
    w = merge(v.obs12(spark, d), m, [("otres", f"S{k:02d}") for k in range(12)], MVARS)
    return rounded(w)


@query("list_tables", "select 'stored_' || k as name, 'rows' as kind, n from (select 'nation' as k, count(*) as n from nation union all select 'region', count(*) from region)")
def list_tables(spark, d):
    """Tables as the session lists them, each with the rows of the table it was made from."""
    from brisa.sources import readers
    for t in ("nation", "region"):
        v.table(spark, d, t).createOrReplaceTempView(f"stored_{t}")
    names_ = [f"stored_{t}" for t in ("nation", "region")]
    sizes = spark.table(names_[0]).select(F.lit(names_[0]).alias("name")).unionAll(spark.table(names_[1]).select(F.lit(names_[1]).alias("name"))).groupBy("name").agg(F.count(F.lit(1)).alias("n"))
    return readers.tables(spark).join(sizes, "name").select("name", F.lit("rows").alias("kind"), "n")


@query("newest_logs", "select path, row_number() over (order by o_orderdate desc, o_orderkey desc) as nth from (select 'logs/gpu' || o_orderkey % 4 || '_run_' || o_orderkey || '.log' as path, o_orderdate, o_orderkey from orders) qualify nth <= 50")
def newest_logs(spark, d):
    """The fifty newest logs of a listing, newest first."""
    from pyspark.sql import Window

    from brisa.sources import inventory
    o = v.table(spark, d, "orders")
    k = F.col("o_orderkey")
    listing = o.select(F.concat(F.lit("logs/gpu"), (k % 4).cast("string"), F.lit("_run_"), k.cast("string"), F.lit(".log")).alias("path"),
                       (F.col("o_orderdate").cast("timestamp") + F.make_dt_interval(secs=(k / 1e6).cast("decimal(18,6)"))).alias("modificationTime"))
    top = inventory.newest_first(listing).limit(50)
    return top.withColumn("nth", F.row_number().over(Window.orderBy(F.col("modificationTime").desc())).cast("long")).select("path", "nth")
