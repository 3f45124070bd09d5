"""Samples of hour vectors, the operational forecast of many origins, its delivery rows and the sweep report."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from brisa.catalog import views as v
from brisa.catalog.base import query, r
from brisa.functions import clock
from brisa.operators import stats, vectors
from brisa.plans import operational as op
from brisa.session import settle

STATIONS30 = [f"S{k:02d}" for k in range(30)]
WEATHER = ["T2", "U10", "V10", "RAINC", "RAINNC"]
FULL = op.Setup(STATIONS30, v.CODES9[1:], WEATHER, need_columns=False)
SMALL = op.Setup(STATIONS30[:5], ["co", "no", "nodos", "nox"], WEATHER)


def _origins(spark, start, end, hours=6):
    one = spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp"), F.expr(f"interval {hours} hours"))).alias("origin"))
    return one.select(F.col("origin").cast("timestamp_ntz").alias("origin"))


def _sources(spark, d, obs):
    """Observations, weather means per step (six hours apart) and normalisation parameters: each source is read once."""
    o = settle(obs(spark, d), "observations")
    w = settle(v.wx(spark, d, 6).groupBy("ts", "var").agg(F.avg("value").alias("value")), "weather-means")
    return o, w, settle(stats.norm_params(o, w), "params")


def _forecast(spark, d, obs, setup, start, end, model=None):
    o, w, params = _sources(spark, d, obs)
    inputs = op.model_inputs(o, w, _origins(spark, start, end), params, setup)
    return op.run_forecast(inputs, model or vectors.column_model(setup.columns), params, setup)


def panel_sql(obs: str, view: str, setup: op.Setup, origins: str) -> str:
    """Hourly panel filled the operational way, normalised, as one list per hour (``vec``: h, x, m)."""
    n = len(setup.stations)
    stations = ", ".join(f"'{s}'" for s in setup.stations)
    codes = ", ".join(f"'{p}'" for p in (setup.keep, *setup.others))
    cyc = {"day": 86400.0, "week": 604800.0, "year": 31556952.0}
    time = [e for c in cyc.values() for e in (f"abs(sin(h * 3600.0::double * ({math.pi!r} / {c})))", f"abs(cos(h * 3600.0::double * ({math.pi!r} / {c})))")]
    time += [e for c in cyc.values() for e in (f"sin(h * 3600.0::double * ({2 * math.pi!r} / {c}))", f"cos(h * 3600.0::double * ({2 * math.pi!r} / {c}))")]
    own = [f"max(z) filter (pollutant = '{setup.keep}' and id_est = '{s}')" for s in setup.stations]
    rest = [f"{f}(z) filter (pollutant = '{p}')" for p in setup.others for f in ("avg", "min", "max")]
    masks = [f"max(m) filter (pollutant = '{setup.keep}' and id_est = '{s}')" for s in setup.stations]
    masks += [f"{f}(m) filter (pollutant = '{p}')" for p in setup.others for f in ("max", "min", "max")]
    # any, all, any station filled
    return f"""{obs},
orig as ({origins}),
oh as (select origin, epoch(origin)::bigint // 3600 as h from orig),
span as (select min(h) - {setup.hours_back} as lo, max(h) as hi from oh),
hourly as (select pollutant, id_est, fecha, epoch(fecha)::bigint // 3600 as h, case when val >= 0 and val <= case pollutant when 'pmdoscinco' then 500 when 'otres' then 500 else 1000 end then val end as val
           from {view} where pollutant in ({codes}) and id_est in ({stations})),
param as (select pollutant, avg(m) as mean, avg(s) as std from (select pollutant, id_est, avg(val) as m, stddev_samp(val) as s from {view} group by 1, 2) group by 1),
series as (select p as pollutant, s as id_est from (select unnest([{codes}]) as p), (select unnest([{stations}]) as s)),
full_panel as (select c.*, o.val from (select pollutant, id_est, unnest(range(lo, hi)) as h from series, span) c left join (select * from hourly, span where hourly.h between lo and hi) o using (pollutant, id_est, h)),
q as (select pollutant, h, quantile_cont(val, 0.95) as q95, count(val) as n from hourly, span where h between lo and hi group by 1, 2),
rowavg as (select pollutant, h, avg(val) as row_val from hourly join q using (pollutant, h) where n > 2 and val > 0 and val < q95 group by 1, 2),
s1 as (select f.*, coalesce(f.val, row_val) as v1, case when f.val is not null then 0 else 1 end as m from full_panel f left join rowavg using (pollutant, h)),
s2 as (select s.*, coalesce(s.v1, y.v1) as v2 from s1 s left join s1 y on y.pollutant = s.pollutant and y.id_est = s.id_est and y.h = s.h - 24),
hist as (select g.pollutant, g.id_est, g.h, avg(p.val) as hv from s2 g join hourly p on p.pollutant = g.pollutant and p.id_est = g.id_est and p.val > 0 and p.fecha < make_timestamp(g.h * 3600000000)
           and p.fecha >= make_timestamp(g.h * 3600000000) - interval 5 year and month(p.fecha) = month(make_timestamp(g.h * 3600000000)) and day(p.fecha) = day(make_timestamp(g.h * 3600000000))
           and hour(p.fecha) = hour(make_timestamp(g.h * 3600000000)) where g.v2 is null group by 1, 2, 3 having count(*) >= 5),
z as (select s.pollutant, s.id_est, s.h, m, coalesce((coalesce(v2, hv) - mean) / nullif(std, 0), 0) as z from s2 s left join hist using (pollutant, id_est, h) left join param using (pollutant)),
vec as (select h, [{', '.join(f'coalesce({e}, 0)' for e in own)}, {', '.join(time)}, {', '.join(f'coalesce({e}, 0)' for e in rest)}]::double[] as x, [{', '.join(masks)}]::int[] as m from z group by h)"""


ORIGINS_FULL = "select unnest(generate_series(timestamp '2024-01-04', timestamp '2024-01-30', interval 6 hour)) as origin"
ORIGINS_SMALL = "select unnest(generate_series(timestamp '2024-01-01 06:00:00', timestamp '2024-01-29', interval 6 hour)) as origin"
SAMPLES_FULL = f"""{panel_sql(v.OBS30X9, 'obs30x9', FULL, ORIGINS_FULL)},
s as (select h, list(x) over (order by h rows between 24 preceding and 1 preceding) as x, list(x) over w as y, list(m) over w as m, lead(h, 10) over (order by h) as last
      from vec window w as (order by h rows between current row and 7 following))"""


def _full_vectors(spark, d):
    o, _, params = _sources(spark, d, v.obs30x9)
    origins = settle(_origins(spark, "2024-01-04", "2024-01-30").withColumn("h", clock.hour_index(F.col("origin"))), "origins")
    return op.hour_vectors(op.filled_panel(op.source_hours(o, origins, FULL), origins, FULL), params, FULL)


@query("sample_matrix", f"""with {SAMPLES_FULL},
t as (select pos, row_number() over (order by pos) as nth from (select unnest(list_concat(range(1, 31), range(43, 67))) as pos)),
p as (select unnest(range(1, 67)) as pos)
select make_timestamp(h * 3600000000) as origin, cast(p.pos - 1 as int) as position, round(x[1][p.pos] @6) as x_first, round(x[24][p.pos] @6) as x_last,
       round(list_sum(list_transform(range(1, 25), lambda k: x[k][p.pos] * k)) @6) as x_weighted,
       case when nth is not null then round(list_sum(list_transform(range(1, 9), lambda k: y[k][p.pos] * k)) @6) end as y_weighted,
       case when nth is not null then list_sum(list_transform(range(1, 9), lambda k: m[k][nth] * k))::bigint end as mask_weighted
from s, p left join t on t.pos = p.pos where len(x) = 24 and last is not null""")
def sample_matrix(spark, d):
    """Training samples over the 66 columns of a full model, each column with its first, last and weighted values."""
    s = vectors.sample_matrix(_full_vectors(spark, d), FULL.columns)
    at = {p: i for i, p in enumerate(vectors.target_positions(FULL.columns))}

    def weighted(rows, p, kind):
        return f"aggregate({rows}, named_struct('k', 1, 's', 0{kind}), (a, q) -> named_struct('k', a.k + 1, 's', a.s + q[{p}] * a.k), a -> a.s)"

    def column(p):
        y, m = (weighted("y", at[p], "D"), weighted("y_mask", at[p], "L")) if p in at else ("cast(null as double)", "cast(null as bigint)")
        return f"named_struct('position', {p}, 'x_first', x[0][{p}], 'x_last', x[23][{p}], 'x_weighted', {weighted('x', p, 'D')}, 'y_weighted', {y}, 'mask_weighted', {m})"

    out = s.select("h", F.inline(F.array(*[F.expr(column(p)) for p in range(len(FULL.columns))])))
    return out.select(clock.hour_stamp(F.col("h")).alias("origin"), "position", *[r(c).alias(c) for c in ("x_first", "x_last", "x_weighted", "y_weighted")], "mask_weighted")


@query("sample_transform", f"""with {SAMPLES_FULL}
select make_timestamp(h * 3600000000) as origin, round(list_avg(list_transform(range(1, 9), lambda k: y[k][1])) @6) as y_mean, round(list_max(list_transform(range(1, 25), lambda k: x[k][31])) @6) as top_half_sin
from s where len(x) = 24 and last is not null and hour(make_timestamp(h * 3600000000)) % 6 = 0""")
def sample_transform(spark, d):
    """A hook on the samples: origins of every sixth hour only, targets scaled by ten."""
    def scaled(samples):
        return samples.filter(F.col("h") % 6 == 0).withColumn("y", F.transform("y", lambda row: F.transform(row, lambda x: x * 10)))

    s = vectors.sample_matrix(_full_vectors(spark, d), FULL.columns, transform=scaled)
    y = F.aggregate(F.transform("y", lambda row: row[0]), F.lit(0.0), lambda a, x: a + x) / 80
    return s.select(clock.hour_stamp(F.col("h")).alias("origin"), r(y).alias("y_mean"), r(F.array_max(F.transform("x", lambda row: row[30]))).alias("top_half_sin"))


def forecast_sql(panel: str, setup: op.Setup, faults: str) -> str:
    """Recursive roll-forward of the column model; ``faults`` names origins that are not rolled."""
    n, c = len(setup.stations), len(setup.columns)
    targets = f"list_concat(range(1, {n + 1}), range({n + 13}, {c + 1}))"
    names = ", ".join(f"('{setup.keep}', '{s}')" for s in setup.stations) + ", " + ", ".join(f"('{p}', '{a}')" for p in setup.others for a in ("mean", "min", "max"))
    cyc = {"day": 86400.0, "week": 604800.0, "year": 31556952.0}
    at = "((h + k) * 3600.0::double)"
    time = [e for x in cyc.values() for e in (f"abs(sin({at} * ({math.pi!r} / {x})))", f"abs(cos({at} * ({math.pi!r} / {x})))")]
    time += [e for x in cyc.values() for e in (f"sin({at} * ({2 * math.pi!r} / {x}))", f"cos({at} * ({2 * math.pi!r} / {x}))")]
    return f"""{panel},
{v.wx_sql(6)},
step as (select epoch(ts)::bigint // 3600 as h, var, avg(value) as value from wx group by 1, 2),
wp as (select var, avg(value) as mean, stddev_pop(value) as std from step group by 1),
t2 as (select step.h as sh, coalesce((value - mean) / nullif(std, 0), 0) as z from step join wp using (var) where var = 'T2'),
need as (select oh.h, unnest(range(oh.h - 4, oh.h + 26)) as wh from oh),
near as (select need.h, wh, z from need join t2 on sh between wh - 3 and wh + 3 qualify row_number() over (partition by need.h, wh order by abs(wh - sh), sh) = 1),
weather as (select h, list(z order by wh) as w from near group by h),
fault as ({faults}),
window_x as (select oh.h, list(vec.x order by vec.h) as x from oh join vec on vec.h >= oh.h - 24 and vec.h < oh.h group by 1),
roll(h, k, x, w, y) as (
  select h, 0, x, w, null::double[] from window_x join weather using (h) where h not in (select h from fault)
  union all
  select h, k + 1, list_append(x[2:24], list_concat(y[1:{n}], [{', '.join(time)}], y[{n + 1}:])), w, y from (
    select h, k, x, w, list_transform({targets}, lambda p: 0.5 * x[24][p] + 0.2 * x[1][p] + 0.1 * list_avg(list_transform({targets}, lambda q: x[24][q])) + 0.3 * x[24][{n + 7}]
                                      + 0.2 * list_avg(w[k + 1:k + 7]) - 0.05) as y from roll where k < 24)),
named as (select row_number() over () as nth, * from (values {names}) t(pollutant, id_est)),
out as (select make_timestamp(h * 3600000000) as origin, k::int as horizon, pollutant, id_est, y[nth] * std + mean as value from roll, named join param using (pollutant) where k > 0)"""


WEATHER_FAULT = "select oh.h from oh left join weather using (h) where coalesce(len(w), 0) < 30"
FORECAST_FULL = forecast_sql(panel_sql(v.OBS30X9, "obs30x9", FULL, ORIGINS_FULL), FULL, WEATHER_FAULT)


@query("operational_forecast", f"""with recursive {FORECAST_FULL} select origin, horizon, pollutant, id_est, round(value @6) as value from out""")
def operational_forecast(spark, d):
    """From observations and weather to forecasts of 54 targets, 24 hours ahead, for an origin every six hours."""
    f = _forecast(spark, d, v.obs30x9, FULL, "2024-01-04", "2024-01-30")
    return f.filter(F.col("error").isNull()).select("origin", "horizon", "pollutant", "id_est", r("value").alias("value"))


def _delivery_sql() -> str:
    hours = lambda prefix, cond: ", ".join(f"round(max(value) filter (horizon = {h}{cond}), 2) as {prefix}hour_p{h:02d}" for h in range(1, 25))
    stats_cols = ", ".join(hours(f"{n}_", f" and id_est = '{s}'") for s, n in (("min", "min"), ("max", "max"), ("mean", "avg")))
    return f"""with recursive {FORECAST_FULL},
own as (select origin as fecha, 7 as id_tipo_pronostico, id_est, '-1' as val, 'forecast_otres' as "table", {hours('', '')} from out where pollutant = 'otres' group by 1, 3),
rest as (select origin as fecha, case when pollutant in ('nox', 'pmdiez', 'sodos') then 7 end as id_tipo_pronostico, 'NET' as id_est, '-1' as val, 'forecast_' || pollutant as "table", {stats_cols} from out where pollutant <> 'otres' group by fecha, pollutant, out.id_est)
select * from own union all by name select * from rest"""


@query("operational_delivery", _delivery_sql())
def operational_delivery(spark, d):
    """The same plan up to the rows that are delivered for stations and statistics."""
    return op.delivery_rows(_forecast(spark, d, v.obs30x9, FULL, "2024-01-04", "2024-01-30"), FULL)


SWEEP_SQL = f"""with recursive {forecast_sql(panel_sql(v.OBS5X5, 'obs5x5', SMALL, ORIGINS_SMALL), SMALL, '''select h from status where category <> 'ok' ''')
    .replace('fault as (', '''seen as (select oh.h as oh, hourly.h, case when pollutant = 'otres' then 'otres_' || id_est else pollutant end as col from oh join hourly on hourly.h >= oh.h - 60 and hourly.h < oh.h where val is not null),
status as (select oh.h, case when coalesce(n_hours, 0) < 15 then 'datos_insuficientes' when n_cols < 9 then 'datos_faltantes' when coalesce(len(w), 0) < 30 then 'errores_wrf'
             when hour(origin) = 18 and epoch(origin)::bigint // 86400 % 5 = 0 then 'otros_errores' else 'ok' end as category
           from oh left join (select oh, count(distinct h) as n_hours, count(distinct col) as n_cols from seen group by 1) x on x.oh = oh.h left join weather on weather.h = oh.h),
fault as (''', 1)},
per as (select origin, category, coalesce(n, 0)::bigint as n_values from status join oh using (h) left join (select origin, count(value) as n from out group by 1) using (origin))"""


def _failing_model(columns):
    plain = vectors.column_model(columns)

    def step(x, w, k, hours):
        if k == 0 and ((hours % 24 == 18) & (hours // 24 % 5 == 0)).any():
            raise ValueError("weights do not load")
        return plain(x, w, k, hours)

    return step


def _sweep(spark, d):
    return op.sweep_status(_forecast(spark, d, v.obs5x5, SMALL, "2024-01-01 06:00:00", "2024-01-29", _failing_model(SMALL.columns)))


@query("sweep_origins", f"{SWEEP_SQL} select * from per")
def sweep_origins(spark, d):
    """Every origin of a sweep with its outcome: too few hours, a station that reports later, no weather, a model that fails."""
    return _sweep(spark, d)


@query("sweep_report", f"""{SWEEP_SQL} select category, count(*) as n_origins, min(origin) as first_origin, max(origin) as last_origin, sum(n_values)::bigint as n_values,
  round(count(*) / (select count(*) from per)::double @6) as share from per group by 1""")
def sweep_report(spark, d):
    report = op.sweep_report(settle(_sweep(spark, d), "sweep"))
    return report.withColumn("share", r("share"))
