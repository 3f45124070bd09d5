"""Quality rules, calendar filling and imputation."""

from __future__ import annotations

from pyspark.sql import functions as F

from brisa.catalog import views as v
from brisa.catalog.base import query, r
from brisa.operators import impute, panel
from brisa.session import settle

OUT = ["fecha", "pollutant", "id_est"]

CLEAN12 = f"""{v.OBS12},
clean as (select fecha, pollutant, id_est, case when val >= 0 and val <= 500 then val end as val from obs12),
{v.calendar_sql('clean')}"""

CLIM_TAIL = """
clim_mean as (select pollutant, id_est, make_timestamp(2012, month(fecha), day(fecha), hour(fecha), 0, 0.0) as ts, avg(val) as m
              from {obs} where val is not null group by 1, 2, 3),
clim_cal as (select pollutant, id_est, unnest(generate_series(timestamp '2012-01-01', timestamp '2012-12-31 23:00:00', interval 1 hour)) as ts
             from (select distinct pollutant, id_est from {obs})),
clim_roll as (select pollutant, id_est, ts, avg(m) over (partition by pollutant, id_est order by ts rows between 1 preceding and 1 following) as a
              from clim_cal left join clim_mean using (pollutant, id_est, ts)),
clim_edge as (select pollutant, id_est,
                max(a) filter (ts = timestamp '2012-01-01') as a0, max(a) filter (ts = timestamp '2012-01-01 01:00:00') as a1,
                max(a) filter (ts = timestamp '2012-12-31 22:00:00') as y, max(a) filter (ts = timestamp '2012-12-31 23:00:00') as z
              from clim_roll group by 1, 2),
clim as (select pollutant, id_est, month(ts) as month, day(ts) as day, hour(ts) as hour,
           case when ts = timestamp '2012-01-01' then (z + a0 + a1) / 3
                when ts = timestamp '2012-12-31 23:00:00' then (y + z + (z + a0 + a1) / 3) / 3 else a end as val
         from clim_roll join clim_edge using (pollutant, id_est))"""


def _out(df):
    return df.select(F.col("fecha"), "pollutant", "id_est", r("val").alias("val"), "flag")


@query("impute_pipeline", f"""with {CLEAN12},
rowavg as (select pollutant, fecha, avg(val) as row_val from clean group by 1, 2 having count(val) > 5),
s1 as (select f.*, case when f.val is null and row_val is not null then row_val else f.val end as v1,
              case when f.val is not null then 'none' when row_val is not null then 'row_avg' else 'missing' end as f1
       from full_panel f left join rowavg using (pollutant, fecha)),
s2 as (select *, last_value(v1 ignore nulls) over (partition by pollutant, id_est, hour(fecha) order by fecha
                 rows between unbounded preceding and 1 preceding) as prev from s1),
s3 as (select pollutant, id_est, fecha, case when f1 = 'missing' and prev is not null then prev else v1 end as v2,
              case when f1 = 'missing' and prev is not null then 'last_day_same_hour' else f1 end as f2 from s2),
{CLIM_TAIL.format(obs='clean')}
select s3.fecha, s3.pollutant, s3.id_est, round(case when f2 = 'missing' then c.val else v2 end @6) as val,
       case when f2 = 'missing' and c.val is not null then 'climatology' else f2 end as flag
from s3 left join clim c on c.pollutant = s3.pollutant and c.id_est = s3.id_est
  and c.month = month(s3.fecha) and c.day = day(s3.fecha) and c.hour = hour(s3.fecha)""")
def impute_pipeline(spark, d):
    return _out(impute.training_pipeline(v.obs12(spark, d)))


@query("imputation_summary", f"""with {CLEAN12},
rowavg as (select pollutant, fecha, avg(val) as row_val from clean group by 1, 2 having count(val) > 5),
s1 as (select f.*, coalesce(f.val, row_val) as v1,
              case when f.val is not null then 'none' when row_val is not null then 'row_avg' else 'missing' end as f1
       from full_panel f left join rowavg using (pollutant, fecha)),
s2 as (select *, last_value(v1 ignore nulls) over (partition by pollutant, id_est, hour(fecha) order by fecha
                 rows between unbounded preceding and 1 preceding) as prev from s1),
s3 as (select pollutant, id_est, fecha, case when f1 = 'missing' and prev is not null then 'last_day_same_hour' else f1 end as f2 from s2),
{CLIM_TAIL.format(obs='clean')},
s4 as (select s3.pollutant, s3.id_est, case when f2 = 'missing' and c.val is not null then 'climatology' else f2 end as flag
       from s3 left join clim c on c.pollutant = s3.pollutant and c.id_est = s3.id_est
         and c.month = month(s3.fecha) and c.day = day(s3.fecha) and c.hour = hour(s3.fecha))
select pollutant, id_est, count(*) as n, cast(count_if(flag = 'none') as bigint) as original,
       cast(count_if(flag not in ('none', 'missing')) as bigint) as imputed, cast(count_if(flag = 'missing') as bigint) as missing,
       cast(count_if(flag = 'row_avg') as bigint) as row_avg, cast(count_if(flag = 'last_day_same_hour') as bigint) as last_day_same_hour,
       cast(count_if(flag = 'climatology') as bigint) as climatology, cast(count_if(flag = 'historical_avg') as bigint) as historical_avg,
       round(cast(count_if(flag not in ('none', 'missing')) as bigint) * 100.0::double / count(*), 1) as rate_pct
from s4 group by 1, 2""")
def imputation_summary(spark, d):
    return impute.summary(impute.training_pipeline(v.obs12(spark, d)))


@query("quality_rules", f"""with {v.OBS5X4},
bad as (select fecha, pollutant, id_est, val * 3 - 60 as val from obs5x4)
select pollutant, id_est, cast(count_if(val is null) as bigint) as missing, cast(count_if(val < 0) as bigint) as negative,
       cast(count_if(val > case when pollutant = 'otres' then 500 else 1000 end) as bigint) as too_high,
       cast(count_if(val < 0 or val > case when pollutant = 'otres' then 500 else 1000 end) as bigint) as cleaned,
       round(avg(case when val >= 0 and val <= case when pollutant = 'otres' then 500 else 1000 end then val end) @6) as mean_clean
from bad group by 1, 2""")
def quality_rules(spark, d):
    bad = v.obs5x4(spark, d).withColumn("val", F.col("val") * 3 - 60)
    clean = impute.apply_quality(bad).groupBy("pollutant", "id_est").agg(r(F.avg("val")).alias("mean_clean"))
    return impute.quality_report(bad).join(clean, ["pollutant", "id_est"])


@query("hour_calendar_fill", f"""with {v.OBS5X4_FULL}
select fecha, pollutant, id_est, round(val @6) as val from full_panel""")
def hour_calendar_fill(spark, d):
    return panel.fill_calendar(v.obs5x4(spark, d)).select(*OUT, r("val").alias("val"))


@query("persistence_chain", f"""with {v.OBS12_FULL},
p as (select *, last_value(val ignore nulls) over (partition by pollutant, id_est, hour(fecha) order by fecha
              rows between unbounded preceding and 1 preceding) as prev from full_panel)
select fecha, pollutant, id_est, round(coalesce(val, prev) @6) as val,
       case when val is not null then 'none' when prev is not null then 'last_day_same_hour' else 'missing' end as flag
from p""")
def persistence_chain(spark, d):
    return _out(impute.fill_persistence_chain(impute.start_flags(panel.fill_calendar(v.obs12(spark, d)))))


@query("persistence_all", f"""with {v.OBS_ALL_FULL},
p as (select *, last_value(val ignore nulls) over (partition by pollutant, id_est, hour(fecha) order by fecha
              rows between unbounded preceding and 1 preceding) as prev from all_panel)
select fecha, pollutant, id_est, round(coalesce(val, prev) @6) as val,
       case when val is not null then 'none' when prev is not null then 'last_day_same_hour' else 'missing' end as flag
from p""")
def persistence_all(spark, d):
    return _out(impute.fill_persistence_chain(impute.start_flags(panel.fill_calendar(v.obs_all(spark, d)))))


@query("persistence_day", f"""with {v.OBS12_FULL}
select f.fecha, f.pollutant, f.id_est, round(coalesce(f.val, y.val) @6) as val,
       case when f.val is not null then 'none' when y.val is not null then 'last_day_same_hour' else 'missing' end as flag
from full_panel f left join full_panel y on y.pollutant = f.pollutant and y.id_est = f.id_est and y.fecha = f.fecha - interval 24 hour""")
def persistence_day(spark, d):
    return _out(impute.fill_persistence_day(impute.start_flags(panel.fill_calendar(v.obs12(spark, d)))))


@query("impute_row_avg", f"""with {v.OBS12_FULL},
rowavg as (select pollutant, fecha, avg(val) as row_val from obs12 group by 1, 2 having count(val) > 5)
select f.fecha, f.pollutant, f.id_est, round(coalesce(f.val, row_val) @6) as val,
       case when f.val is not null then 'none' when row_val is not null then 'row_avg' else 'missing' end as flag
from full_panel f left join rowavg using (pollutant, fecha)""")
def impute_row_avg(spark, d):
    obs = v.obs12(spark, d)
    return _out(impute.fill_row_average(impute.start_flags(panel.fill_calendar(obs)), impute.row_average(obs)))


@query("impute_row_avg_op", f"""with {v.OBS12_FULL},
q as (select pollutant, fecha, quantile_cont(val, 0.95) as q95, count(val) as n from obs12 group by 1, 2),
rowavg as (select pollutant, fecha, avg(val) as row_val from obs12 join q using (pollutant, fecha)
           where n > 2 and val > 0 and val < q95 group by 1, 2)
select f.fecha, f.pollutant, f.id_est, round(coalesce(f.val, row_val) @6) as val,
       case when f.val is not null then 'none' when row_val is not null then 'row_avg' else 'missing' end as flag
from full_panel f left join rowavg using (pollutant, fecha)""")
def impute_row_avg_op(spark, d):
    obs = v.obs12(spark, d)
    return _out(impute.fill_row_average(impute.start_flags(panel.fill_calendar(obs)), impute.row_average_trimmed(obs)))


@query("climatology", f"""with {v.OBS_DAILY},
{CLIM_TAIL.format(obs='obs_daily')}
select pollutant, id_est, month, day, hour, round(val @6) as val from clim""")
def climatology(spark, d):
    return impute.climatology(v.obs_daily(spark, d)).select("pollutant", "id_est", "month", "day", "hour", r("val").alias("val"))


DAILY_FULL = f"{v.OBS_DAILY},\n{v.calendar_sql('obs_daily')}"


@query("impute_climatology", f"""with {DAILY_FULL},
{CLIM_TAIL.format(obs='obs_daily')}
select f.fecha, f.pollutant, f.id_est, round(coalesce(f.val, c.val) @6) as val,
       case when f.val is not null then 'none' when c.val is not null then 'climatology' else 'missing' end as flag
from full_panel f left join clim c on c.pollutant = f.pollutant and c.id_est = f.id_est
  and c.month = month(f.fecha) and c.day = day(f.fecha) and c.hour = hour(f.fecha)""")
def impute_climatology(spark, d):
    obs = v.obs_daily(spark, d)
    clim = settle(impute.climatology(obs), "climatology")
    return _out(impute.fill_lookup(impute.start_flags(panel.fill_calendar(obs)), clim, "climatology"))


@query("impute_historical", f"""with {DAILY_FULL},
hist as (select pollutant, id_est, month(fecha) as mo, day(fecha) as da, hour(fecha) as ho, avg(val) as hv from obs_daily
         where fecha >= timestamp '2001-08-01' - interval 6 year and fecha < timestamp '2001-08-01' and val > 0
         group by 1, 2, 3, 4, 5 having count(*) >= 5)
select f.fecha, f.pollutant, f.id_est, round(coalesce(f.val, hv) @6) as val,
       case when f.val is not null then 'none' when hv is not null then 'historical_avg' else 'missing' end as flag
from full_panel f left join hist h on h.pollutant = f.pollutant and h.id_est = f.id_est
  and mo = month(f.fecha) and da = day(f.fecha) and ho = hour(f.fecha)""")
def impute_historical(spark, d):
    obs = v.obs_daily(spark, d)
    hist = settle(impute.historical_average(obs, "2001-08-01", years=6), "historical")
    return _out(impute.fill_lookup(impute.start_flags(panel.fill_calendar(obs)), hist, "historical_avg"))


@query("impute_pipeline_op", f"""with {v.OBS12},
clean as (select fecha, pollutant, id_est, case when val >= 0 and val <= 500 then val end as val from obs12),
{v.calendar_sql('clean')},
q as (select pollutant, fecha, quantile_cont(val, 0.95) as q95, count(val) as n from clean group by 1, 2),
rowavg as (select pollutant, fecha, avg(val) as row_val from clean join q using (pollutant, fecha)
           where n > 2 and val > 0 and val < q95 group by 1, 2),
s1 as (select f.pollutant, f.id_est, f.fecha, coalesce(f.val, row_val) as v1,
              case when f.val is not null then 'none' when row_val is not null then 'row_avg' else 'missing' end as f1
       from full_panel f left join rowavg using (pollutant, fecha)),
s2 as (select s.*, y.v1 as prev from s1 s left join s1 y on y.pollutant = s.pollutant and y.id_est = s.id_est and y.fecha = s.fecha - interval 24 hour),
hist as (select pollutant, id_est, month(fecha) as mo, day(fecha) as da, hour(fecha) as ho, avg(val) as hv from obs12
         where fecha >= timestamp '2024-02-01' - interval 5 year and fecha < timestamp '2024-02-01' and val > 0
         group by 1, 2, 3, 4, 5 having count(*) >= 5)
select s.fecha, s.pollutant, s.id_est, round(case when f1 = 'missing' then coalesce(prev, hv) else v1 end @6) as val,
       case when f1 <> 'missing' then f1 when prev is not null then 'last_day_same_hour' when hv is not null then 'historical_avg' else 'missing' end as flag
from s2 s left join hist h on h.pollutant = s.pollutant and h.id_est = s.id_est
  and mo = month(s.fecha) and da = day(s.fecha) and ho = hour(s.fecha)""")
def impute_pipeline_op(spark, d):
    obs = v.obs12(spark, d)
    return _out(impute.operational_pipeline(obs, "2024-02-01", obs))


@query("flag_to_mask", f"""with {v.OBS12_FULL},
p as (select *, last_value(val ignore nulls) over (partition by pollutant, id_est, hour(fecha) order by fecha
              rows between unbounded preceding and 1 preceding) as prev from full_panel)
select fecha, pollutant, id_est, case when val is not null then 0 else 1 end as mask from p""")
def flag_to_mask(spark, d):
    f = impute.fill_persistence_chain(impute.start_flags(panel.fill_calendar(v.obs12(spark, d))))
    return f.select(*OUT, panel.flag_to_mask(F.col("flag")).alias("mask"))


@query("mask_stats", f"""with {v.OBS5X4_FULL},
y as (select f.pollutant, f.fecha, case when f.val is not null then 0 else 1 end as mask from full_panel f where f.pollutant <> 'otres')
select fecha, pollutant, max(mask) as mask_mean, min(mask) as mask_min, max(mask) as mask_max from y group by 1, 2""")
def mask_stats(spark, d):
    from brisa.operators import stats
    f = impute.fill_persistence_day(impute.start_flags(panel.fill_calendar(v.obs5x4(spark, d))))
    return stats.mask_stats(f)
