"""Panel, forecast, grid and text views over the star-schema tables, in Spark and in SQL.

Every view reads its whole table; a ``%`` only spreads keys over stations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from brisa.functions import clock


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _station(key: Column, n: int) -> Column:
    return F.concat(F.lit("S"), F.lpad((key % n).cast("string"), 2, "0"))


def _hour(ts: str) -> Column:
    return F.date_trunc("hour", F.col(ts)).cast("timestamp_ntz")


def obs12(spark: SparkSession, d: str) -> DataFrame:
    return (table(spark, d, "events")
            .groupBy(_hour("ts").alias("fecha"), F.lit("otres").alias("pollutant"), _station(F.col("user_id"), 12).alias("id_est"))
            .agg(F.avg("value").alias("val")))


EVENT_CODES = {"click": "otres", "view": "co", "purchase": "nodos", "signup": "no"}


def obs_all(spark: SparkSession, d: str) -> DataFrame:
    """As :func:`obs12` with every user a station, so the number of series follows the tables."""
    return (table(spark, d, "events")
            .groupBy(_hour("ts").alias("fecha"), F.lit("otres").alias("pollutant"), F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("id_est"))
            .agg(F.avg("value").alias("val")))


def obs5x4(spark: SparkSession, d: str) -> DataFrame:
    e = F.col("event_type")
    code = F.when(e == "click", "otres").when(e == "view", "co").when(e == "purchase", "nodos").when(e == "signup", "no").otherwise("nox")
    return (table(spark, d, "events")
            .groupBy(_hour("ts").alias("fecha"), code.alias("pollutant"), _station(F.col("user_id"), 4).alias("id_est"))
            .agg(F.avg("value").alias("val")))


# the kept pollutant first, then the others in the order of a model's columns
CODES9 = ["otres", "co", "nodos", "pmdiez", "pmdoscinco", "nox", "no", "sodos", "pmco"]


def obs30x9(spark: SparkSession, d: str) -> DataFrame:
    """Thirty stations and nine pollutants, sparse: the 66 columns of a full model."""
    code = F.element_at(F.array(*[F.lit(c) for c in CODES9]), (F.col("event_id") % 9).cast("int") + 1)
    return (table(spark, d, "events").groupBy(_hour("ts").alias("fecha"), code.alias("pollutant"), _station(F.col("user_id"), 30).alias("id_est"))
            .agg(F.avg("value").alias("val")))


def obs5x5(spark: SparkSession, d: str) -> DataFrame:
    """Five pollutants and five stations, of which S04 reports from the tenth day on only."""
    e, station = F.col("event_type"), _station(F.col("user_id"), 5)
    code = F.when(e == "click", "otres").when(e == "view", "co").when(e == "purchase", "nodos").when(e == "signup", "no").otherwise("nox")
    late = (station == "S04") & (F.col("ts") < F.lit("2024-01-10").cast("timestamp_ntz"))
    return table(spark, d, "events").filter(~late).groupBy(_hour("ts").alias("fecha"), code.alias("pollutant"), station.alias("id_est")).agg(F.avg("value").alias("val"))


def obs_daily(spark: SparkSession, d: str) -> DataFrame:
    return (table(spark, d, "orders")
            .groupBy(F.col("o_orderdate").cast("timestamp_ntz").alias("fecha"), F.lit("otres").alias("pollutant"),
                     _station(F.col("o_custkey"), 5).alias("id_est"))
            .agg(F.avg(F.col("o_totalprice") / 1000).alias("val")))


def fc_long(spark: SparkSession, d: str) -> DataFrame:
    price = F.col("l_extendedprice")
    return table(spark, d, "lineitem").select(
        F.col("l_returnflag").alias("model"), (1 + F.col("l_orderkey") % 24).cast("int").alias("predicted_hour"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("ts"), _station(F.col("l_suppkey"), 10).alias("station"),
        (price / 500).alias("target"), (price * (1 - F.col("l_discount")) * (1 + F.col("l_tax")) / 500).alias("pred"))


def wx(spark: SparkSession, d: str, hours_per_step: int = 1) -> DataFrame:
    """8x8 fields: one vector is one field, five vectors are one step."""
    t = F.floor(F.col("vec_id") / 5).cast("int")
    var = F.element_at(F.array(*[F.lit(v) for v in ("T2", "U10", "V10", "RAINC", "RAINNC")]), (F.col("vec_id") % 5).cast("int") + 1)
    i, j = F.floor(F.col("pos") / 8).cast("int"), (F.col("pos") % 8).cast("int")
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    return (table(spark, d, "embeddings").select("vec_id", F.posexplode("embedding").alias("pos", "x"))
            .select(t.alias("t"), clock.shift_hours(start, t.cast("bigint") * hours_per_step).alias("ts"), var.alias("var"),
                    i.alias("i"), j.alias("j"), (F.lit(18.75) + i * F.lit(0.05)).alias("lat"),
                    (F.lit(-99.75) + j * F.lit(0.05)).alias("lon"), F.col("x").cast("double").alias("value")))


def stations(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("s_suppkey")
    return table(spark, d, "supplier").select(
        _station(k, 12).alias("id"), F.col("s_name").alias("nombre"), (1995 + k % 10).cast("int").alias("lastyear"),
        (19.0 + (k % 100) / 100.0).alias("lat"), (-99.5 + (k % 70) / 100.0).alias("lon"))


def logs(spark: SparkSession, d: str) -> DataFrame:
    k, s = F.col("o_orderkey"), F.col("o_orderstatus")
    msg = (F.when(s == "F", "Training completed successfully").when((s == "O") & (k % 2 == 0), "Training timed out")
           .when(s == "O", "Exception occurred: out of memory").otherwise("stopped"))
    stamp = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    return table(spark, d, "orders").select(
        F.concat(F.lit("logs/gpu"), (k % 4).cast("string"), F.lit("_run_"), k.cast("string"), F.lit(".log")).alias("path"),
        F.concat(F.lit("Started at: "), stamp, F.lit("\nGPU ID: "), (k % 4).cast("string"), F.lit("\n"), msg,
                 F.lit("\nCompleted at: "), stamp).alias("content"))


OBS12 = """obs12 as (
  select date_trunc('hour', ts) as fecha, 'otres' as pollutant,
         concat('S', lpad(cast(user_id % 12 as varchar), 2, '0')) as id_est, avg(value) as val
  from events group by 1, 2, 3)"""
OBS5X4 = """obs5x4 as (
  select date_trunc('hour', ts) as fecha,
         case event_type when 'click' then 'otres' when 'view' then 'co' when 'purchase' then 'nodos'
                         when 'signup' then 'no' else 'nox' end as pollutant,
         concat('S', lpad(cast(user_id % 4 as varchar), 2, '0')) as id_est, avg(value) as val
  from events group by 1, 2, 3)"""
OBS30X9 = f"""obs30x9 as (
  select date_trunc('hour', ts) as fecha, {CODES9}[event_id % 9 + 1] as pollutant, concat('S', lpad(cast(user_id % 30 as varchar), 2, '0')) as id_est, avg(value) as val
  from events group by 1, 2, 3)"""
OBS5X5 = """obs5x5 as (
  select date_trunc('hour', ts) as fecha,
         case event_type when 'click' then 'otres' when 'view' then 'co' when 'purchase' then 'nodos' when 'signup' then 'no' else 'nox' end as pollutant,
         concat('S', lpad(cast(user_id % 5 as varchar), 2, '0')) as id_est, avg(value) as val
  from events where user_id % 5 <> 4 or ts >= timestamp '2024-01-10' group by 1, 2, 3)"""
OBS_DAILY = """obs_daily as (
  select o_orderdate as fecha, 'otres' as pollutant,
         concat('S', lpad(cast(o_custkey % 5 as varchar), 2, '0')) as id_est, avg(o_totalprice / 1000) as val
  from orders group by 1, 2, 3)"""
FC = """fc as (
  select l_returnflag as model, cast(1 + l_orderkey % 24 as int) as predicted_hour, l_shipdate as ts,
         concat('S', lpad(cast(l_suppkey % 10 as varchar), 2, '0')) as station,
         l_extendedprice / 500 as target, l_extendedprice * (1 - l_discount) * (1 + l_tax) / 500 as pred
  from lineitem)"""


def wx_sql(hours_per_step: int = 1) -> str:
    return f"""wx as (
  select t, timestamp '2024-01-01' + to_hours(t * {hours_per_step}) as ts, var, i, j,
         18.75 + 0.05::double * i as lat, -99.75 + 0.05::double * j as lon, value
  from (select cast(vec_id // 5 as int) as t,
               ['T2','U10','V10','RAINC','RAINNC'][cast(vec_id % 5 as int) + 1] as var,
               cast((p - 1) // 8 as int) as i, cast((p - 1) % 8 as int) as j, cast(embedding[p] as double) as value
        from embeddings, lateral (select unnest(generate_series(1, len(embedding))) as p)))"""


WX = wx_sql()
STATIONS = """stations as (
  select concat('S', lpad(cast(s_suppkey % 12 as varchar), 2, '0')) as id, s_name as nombre,
         cast(1995 + s_suppkey % 10 as int) as lastyear, 19.0::double + (s_suppkey % 100) / 100.0::double as lat,
         -99.5::double + (s_suppkey % 70) / 100.0::double as lon
  from supplier)"""
LOGS = """logs as (
  select concat('logs/gpu', o_orderkey % 4, '_run_', o_orderkey, '.log') as path,
         concat('Started at: ', strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'), chr(10), 'GPU ID: ', o_orderkey % 4, chr(10),
                case when o_orderstatus = 'F' then 'Training completed successfully'
                     when o_orderstatus = 'O' and o_orderkey % 2 = 0 then 'Training timed out'
                     when o_orderstatus = 'O' then 'Exception occurred: out of memory' else 'stopped' end,
                chr(10), 'Completed at: ', strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')) as content
  from orders)"""


def calendar_sql(obs: str) -> str:
    """CTEs cal and full over an observation view: every hour of every series."""
    return f"""series as (select distinct pollutant, id_est from {obs}),
cal as (select pollutant, id_est, unnest(generate_series((select min(fecha) from {obs}), (select max(fecha) from {obs}), interval 1 hour)) as fecha
        from series),
full_panel as (select c.pollutant, c.id_est, c.fecha, o.val from cal c left join {obs} o using (pollutant, id_est, fecha))"""


OBS12_FULL = f"{OBS12},\n{calendar_sql('obs12')}"
OBS5X4_FULL = f"{OBS5X4},\n{calendar_sql('obs5x4')}"


OBS_ALL_FULL = """obs_all as (
  select date_trunc('hour', ts) as fecha, 'otres' as pollutant, concat('U', cast(user_id as varchar)) as id_est, avg(value) as val from events group by 1, 2, 3),
hours as (select unnest(generate_series(min(fecha), max(fecha), interval 1 hour)) as fecha from obs_all),
all_panel as (select h.fecha, s.pollutant, s.id_est, o.val from hours h cross join (select distinct pollutant, id_est from obs_all) s left join obs_all o using (fecha, pollutant, id_est))"""
