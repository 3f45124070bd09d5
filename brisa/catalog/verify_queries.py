"""Forecast verification."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from brisa.catalog import views as v
from brisa.catalog.base import query, r, rounded
from brisa.functions import metrics
from brisa.operators import verify
from brisa.session import settle

MODEL_HOUR = "mh as (select model, predicted_hour, sqrt(avg((pred - target) ** 2)) as rmse, count(*) as n from fc group by 1, 2)"


@query("rmse_all", f"""with {v.FC} select predicted_hour, round(sqrt(avg((pred - target) ** 2)) @6) as rmse, count(*) as n from fc group by 1""")
def rmse_all(spark, d):
    return rounded(verify.rmse_by(v.fc_long(spark, d), ["predicted_hour"], stations_only=False), "rmse")


@query("rmse_by_hour", f"""with {v.FC} select model, predicted_hour, round(sqrt(avg((pred - target) ** 2)) @6) as rmse, count(*) as n
from fc where station not in ('min', 'max', 'mean') group by 1, 2""")
def rmse_by_hour(spark, d):
    return rounded(verify.rmse_by(v.fc_long(spark, d), ["model", "predicted_hour"]), "rmse")


def _by_hour(spark, d):
    return verify.rmse_by(v.fc_long(spark, d), ["model", "predicted_hour"])


@query("model_summary", f"""with {v.FC}, {MODEL_HOUR}
select model, round(avg(rmse) @6) as mean_rmse, round(stddev_pop(rmse) @6) as std_rmse, round(min(rmse) @6) as min_rmse,
       round(max(rmse) @6) as max_rmse, count(rmse) as hours_available from mh group by 1""")
def model_summary(spark, d):
    return rounded(verify.model_summary(_by_hour(spark, d)), "mean_rmse", "std_rmse", "min_rmse", "max_rmse")


@query("rank_models", f"""with {v.FC}, {MODEL_HOUR}
select model, round(avg(rmse) @6) as mean_rmse, row_number() over (order by avg(rmse), model) as rank from mh group by 1""")
def rank_models(spark, d):
    return rounded(verify.rank_models(verify.model_summary(_by_hour(spark, d)).select("model", "mean_rmse")), "mean_rmse")


@query("best_worst", f"""with {v.FC}, {MODEL_HOUR}, per as (select model, avg(rmse) as m from mh group by 1)
select (select model from per order by m, model limit 1) as best_model, round(min(m) @6) as best_rmse,
       (select model from per order by m desc, model desc limit 1) as worst_model, round(max(m) @6) as worst_rmse,
       round(avg(m) @6) as avg_rmse, round(stddev_samp(m) @6) as std_rmse,
       (select count(distinct model) from mh) as n_models, (select count(distinct predicted_hour) from mh) as n_hours,
       (select min(predicted_hour) from mh) as first_hour, (select max(predicted_hour) from mh) as last_hour
from per""")
def best_worst(spark, d):
    return rounded(verify.best_worst(settle(_by_hour(spark, d), "by-hour")), "best_rmse", "worst_rmse", "avg_rmse", "std_rmse")


@query("rmse_quartiles", f"""with {v.FC}, {MODEL_HOUR}
select model, round(min(rmse) @6) as lo, round(quantile_cont(rmse, 0.25) @6) as q25, round(quantile_cont(rmse, 0.5) @6) as q50,
       round(quantile_cont(rmse, 0.75) @6) as q75, round(max(rmse) @6) as hi from mh group by 1""")
def rmse_quartiles(spark, d):
    return rounded(verify.rmse_quartiles(_by_hour(spark, d)), "lo", "q25", "q50", "q75", "hi")


CONF = """conf as (select model, threshold, cast(count_if(target >= threshold and pred >= threshold) as bigint) as tp,
         cast(count_if(target < threshold and pred >= threshold) as bigint) as fp, cast(count_if(target < threshold and pred < threshold) as bigint) as tn,
         cast(count_if(target >= threshold and pred < threshold) as bigint) as fn
  from fc, (values (90), (120), (150)) as th(threshold) group by 1, 2)"""


@query("confusion", f"with {v.FC}, {CONF} select * from conf")
def confusion(spark, d):
    return verify.confusion(v.fc_long(spark, d))


@query("class_metrics", f"""with {v.FC}, {CONF},
m as (select model, threshold, (tp + tn)::double / (tp + fp + tn + fn) as acc, case when tp + fn > 0 then tp::double / (tp + fn) else 0 end as sens,
             case when tn + fp > 0 then tn::double / (tn + fp) else 0 end as spec from conf)
select model, {', '.join(f"round(max({c}) filter (threshold = {t}), 3) as {n}_{t}" for t in (90, 120, 150) for c, n in (('acc', 'accuracy'), ('sens', 'sensitivity'), ('spec', 'specificity')))}
from m group by 1""")
def class_metrics(spark, d):
    return verify.class_summary(verify.class_metrics(verify.confusion(v.fc_long(spark, d))))


@query("metric_suite", f"""with {v.FC}, o as (select model, station, avg(target) as obar from fc group by 1, 2)
select model, station, count(*) as n, round(avg(abs(pred - target)) @6) as mae,
       round(avg(abs(pred - target) / greatest(abs(target), 2.220446049250313e-16)) @6) as mape,
       round(avg((pred - target) ** 2) @4) as mse, round(sqrt(avg((pred - target) ** 2)) @6) as rmse,
       round(corr(target, pred) @6) as corr, round(1 - sum((pred - target) ** 2) / sum((target - obar) ** 2) @6) as r2,
       round(1 - sum((pred - target) ** 2) / sum((abs(pred - obar) + abs(target - obar)) ** 2) @6) as ioa
from fc join o using (model, station) group by 1, 2""")
def metric_suite(spark, d):
    m = verify.metric_suite(v.fc_long(spark, d), ["model", "station"])
    return m.select("model", "station", "n", *[r(c, 4 if c == "mse" else 6).alias(c) for c in ("mae", "mape", "mse", "rmse", "corr", "r2", "ioa")])


@query("linear_fit", f"""with {v.FC}
select model, station, round(regr_slope(pred, target) @6) as slope, round(regr_intercept(pred, target) @6) as intercept from fc group by 1, 2""")
def linear_fit(spark, d):
    return rounded(verify.linear_fit(v.fc_long(spark, d), ["model", "station"]), "slope", "intercept")


@query("int_metrics", f"""with {v.FC}, i as (select model, station, trunc(target) as t, trunc(pred) as p from fc)
select model, station, round(avg((p - t) ** 2) @4) as mse, round(avg(abs(p - t)) @6) as mae from i group by 1, 2""")
def int_metrics(spark, d):
    m = verify.apply_metrics(v.fc_long(spark, d), ["model", "station"], ["mse", "mae"], integers=True)
    return m.select("model", "station", r("mse", 4).alias("mse"), r("mae").alias("mae"))


SPLIT = "case when ts < timestamp '1999-01-01' then 'train' when ts < timestamp '2000-06-01' then 'val' else 'test' end"


@query("metrics_by_split", f"""with {v.FC}, s as (select *, {SPLIT} as split from fc),
u as (select station, 'all' as split, target, pred from s union all select station, split, target, pred from s)
select station, split, round(avg((pred - target) ** 2) @4) as mse, round(avg(abs(pred - target)) @6) as mae from u group by 1, 2""")
def metrics_by_split(spark, d):
    fc = v.fc_long(spark, d).withColumn("part", F.expr(SPLIT.replace("timestamp '", "timestamp_ntz '")))
    m = verify.metrics_by_split(fc, ["station"], "part", ["mse", "mae"])
    return m.select("station", "split", r("mse", 4).alias("mse"), r("mae").alias("mae"))


@query("function_metric", f"""with {v.FC}, s as (select *, {SPLIT} as split from fc),
u as (select station, 'all' as split, target, pred from s union all select station, split, target, pred from s)
select station, split, round(median(abs(pred - target)) @6) as median_error, round(avg(abs(pred - target)) @6) as mae from u group by 1, 2""")
def function_metric(spark, d):
    """A metric that is no sum, given as a plain function of two arrays."""
    metrics.register_function("median_error", lambda t, p: np.abs(p - t), quantile=0.5)
    fc = v.fc_long(spark, d).withColumn("part", F.expr(SPLIT.replace("timestamp '", "timestamp_ntz '")))
    own = verify.metrics_by_split(fc, ["station"], "part", ["median_error"])
    m = own.join(verify.metrics_by_split(fc, ["station"], "part", ["mae"]), ["station", "split"])
    return m.select("station", "split", r("median_error").alias("median_error"), r("mae").alias("mae"))


@query("avg_metric", f"""with {v.FC}, m as (select station, predicted_hour, sqrt(avg((pred - target) ** 2)) as rmse from fc group by 1, 2),
a as (select station as grp, avg(rmse) as avg_metric from m group by 1),
b as (select cast(predicted_hour as varchar) as grp, avg(rmse) as avg_metric from m group by 1)
select 'station' as kind, grp, round(avg_metric @6) as avg_metric from a
union all select 'station', 'ALL', round(avg(avg_metric) @6) from a
union all select 'hour', grp, round(avg_metric @6) from b
union all select 'hour', 'ALL', round(avg(avg_metric) @6) from b""")
def avg_metric(spark, d):
    m = settle(verify.rmse_by(v.fc_long(spark, d), ["station", "predicted_hour"]), "station-hour")
    s = verify.mean_of(m, "station", "rmse").withColumn("kind", F.lit("station"))
    h = verify.mean_of(m, "predicted_hour", "rmse").withColumn("kind", F.lit("hour"))
    return s.unionByName(h).select("kind", "grp", r("avg_metric").alias("avg_metric"))


@query("daily_block_error", f"""with {v.FC},
g as (select model, station, case when target < 5 then 0 else target end as target, case when target < 5 then 0 else pred end as pred,
             (row_number() over (partition by model, station order by ts, predicted_hour, target, pred) - 1) // 24 as block from fc),
b as (select model, station, block, greatest(max(target), 0) as tm, greatest(max(pred), 0) as pm, sum(target) / 24 as ta, sum(pred) / 24 as pa
      from g group by 1, 2, 3)
select model, station, count(*) as blocks, round(avg(tm - pm) @6) as max_err_mean, round(stddev_pop(tm - pm) @6) as max_err_std,
       round(avg(ta - pa) @6) as mean_err_mean, round(stddev_pop(ta - pa) @6) as mean_err_std from b where tm <> 0 group by 1, 2""")
def daily_block_error(spark, d):
    fc = v.fc_long(spark, d).withColumn("_t", F.col("target")).withColumn("_p", F.col("pred"))
    fc = fc.withColumn("target", F.when(F.col("target") >= 5, F.col("target")))
    b = verify.daily_block_error(fc, ["model", "station"], ["ts", "predicted_hour", "_t", "_p"])
    return rounded(b, "max_err_mean", "max_err_std", "mean_err_mean", "mean_err_std")


@query("loss_suite", f"""with {v.FC}, m as (select *, case when predicted_hour > 12 then 1 else 0 end as mask from fc)
select model, round(avg((pred - target) ** 2) @4) as mse, round(avg(abs(pred - target)) @6) as mae,
       round(sqrt(avg((pred - target) ** 2)) @6) as rmse, round(1 - avg((pred - target) ** 2) / var_pop(target) @6) as r2,
       round(1 - var_samp(target - pred) / var_samp(target) @6) as explained_variance,
       round(avg((pred * mask - target * mask) ** 2) @4) as masked_mse, round(sqrt(avg((pred * mask - target * mask) ** 2)) @6) as masked_rmse,
       round(avg((pred * (1 - mask) - target * (1 - mask)) ** 2) @4) as masked_mse_loss,
       round(avg(case when pred - target < 0 then 2 else 1 end * (pred - target) ** 2 * (1 - mask)) @4) as asymmetric_mse,
       round(avg(case when abs(pred - target) <= 1 then 0.5 * (pred - target) ** 2 else abs(pred - target) - 0.5 end) @6) as huber,
       round(avg(predicted_hour * (pred - target) ** 2) @4) as weighted_mse,
       round(avg((pred / 250 * ceil(target / 250 + 1e-5) - target / 250 * ceil(target / 250 + 1e-5)) ** 2) @6) as restricted_mse
from m group by 1""")
def loss_suite(spark, d):
    t, p = F.col("target"), F.col("pred")
    mask = F.when(F.col("predicted_hour") > 12, 1).otherwise(0)
    one = {n: metrics.get(n)(t, p) for n in ("mse", "mae", "rmse", "r2", "explained_variance")}
    one.update(masked_mse=metrics.masked_mse(t, p, mask), masked_rmse=metrics.masked_rmse(t, p, mask),
               masked_mse_loss=metrics.masked_mse_loss(t, p, mask), asymmetric_mse=metrics.asymmetric_mse(t, p, mask),
               huber=metrics.huber(t, p), weighted_mse=metrics.weighted_mse(t, p, F.col("predicted_hour")),
               restricted_mse=metrics.restricted_mse(t / 250, p / 250))
    four = {"mse", "masked_mse", "masked_mse_loss", "asymmetric_mse", "weighted_mse"}
    return v.fc_long(spark, d).groupBy("model").agg(*[r(c, 4 if n in four else 6).alias(n) for n, c in one.items()])


@query("topk_accuracy", """with s as (select vec_id, label % 8 as label, embedding[label % 8 + 1] as own, embedding as e from embeddings),
b as (select vec_id, label, own, (select count(*) from (select unnest(e) as x, generate_subscripts(e, 1) - 1 as i)
        where x > own or (x = own and i < label)) as better, ln(1 + exp(cast(own as double))) as lp from s)
select label, count(*) as n, round(avg(case when better < 1 then 1.0 else 0.0 end) @6) as top1,
       round(avg(case when better < 3 then 1.0 else 0.0 end) @6) as top3,
       round(avg(case when better < 10 then 1.0 else 0.0 end) @6) as top10, round(avg(-lp) @6) as nll from b group by 1""")
def topk_accuracy(spark, d):
    e = v.table(spark, d, "embeddings").withColumn("label", F.col("label") % 8)
    hit = {f"top{k}": metrics.top_k_hit(F.col("embedding"), F.col("label"), k) for k in (1, 3, 10)}
    lp = F.transform("embedding", lambda x: F.log(F.lit(1.0) + F.exp(x.cast("double"))))
    return e.groupBy("label").agg(F.count(F.lit(1)).alias("n"), *[r(F.avg(c)).alias(n) for n, c in hit.items()],
                                  r(metrics.nll(lp, F.col("label"))).alias("nll"))


@query("dice", f"""with {v.FC},
b as (select model, case when target >= 120 then 1.0::double else 0 end as t, least(pred / 120, 2) as p,
             case when target >= 150 then 2.0::double when target >= 90 then 1 else 0 end as lab from fc)
select model, round((2 * sum(t * p) + 1) / (sum(t) + sum(p) + 1) @6) as dice,
       round((2 * sum(t * least(p, 1)) + 0.01) / (sum(t) + sum(least(p, 1)) + 0.01) @6) as dice_clipped,
       round((2 * sum(floor(lab / 2 + 0.001) * p * ceil(lab / 2 - 0.001)) + 1) / (sum(floor(lab / 2 + 0.001)) + sum(p * ceil(lab / 2 - 0.001)) + 1) @6) as dice_lesion,
       round((2 * sum(floor(lab / 2 + 0.001) * least(p * ceil(lab / 2 - 0.001), 1)) + 1)
             / (sum(floor(lab / 2 + 0.001)) + sum(least(p * ceil(lab / 2 - 0.001), 1)) + 1) @6) as dice_lesion_clipped
from b group by 1""")
def dice(spark, d):
    tg = F.col("target")
    t = F.when(tg >= 120, 1.0).otherwise(0.0)
    p = F.least(F.col("pred") / 120, F.lit(2.0))
    lab = F.when(tg >= 150, 2.0).when(tg >= 90, 1.0).otherwise(0.0)
    return v.fc_long(spark, d).groupBy("model").agg(
        r(metrics.dice(t, p)).alias("dice"), r(metrics.dice_clipped(t, p)).alias("dice_clipped"),
        r(metrics.dice_lesion(lab, p)).alias("dice_lesion"), r(metrics.dice_lesion(lab, p, clip=True)).alias("dice_lesion_clipped"))


@query("density_bins", f"""with {v.FC}
select model, cast(least(floor(target / 6), 29) as int) as obs_bin, cast(least(floor(pred / 6), 29) as int) as fc_bin, count(*) as n
from fc where target between 0 and 180 and pred between 0 and 180 group by 1, 2, 3""")
def density_bins(spark, d):
    return verify.density_bins(v.fc_long(spark, d), ["model"])


@query("model_inventory", f"with {v.FC} select model, count(*) as records, min(ts) as first_ts, max(ts) as last_ts from fc group by 1")
def model_inventory(spark, d):
    return verify.model_inventory(v.fc_long(spark, d))


@query("model_families", """select split_part(p_type || '_' || p_brand || '_' || p_size, '_', 1) as family,
  count(distinct p_type || '_' || p_brand || '_' || p_size) as variants from part group by 1""")
def model_families(spark, d):
    p = v.table(spark, d, "part").select(F.concat_ws("_", "p_type", "p_brand", F.col("p_size").cast("string")).alias("model"))
    return verify.model_families(p)


@query("model_ids", """with m as (select distinct p_brand as model from part)
select model, printf('M%02d', row_number() over (order by model)) as model_id from m""")
def model_ids(spark, d):
    return verify.model_ids(v.table(spark, d, "part").select(F.col("p_brand").alias("model")))


@query("target_time", f"""with {v.FC}
select model, predicted_hour, ts - to_hours(predicted_hour - 1) as target_ts, count(*) as n, round(avg(pred) @6) as mean_pred
from fc group by 1, 2, 3""")
def target_time(spark, d):
    fc = v.fc_long(spark, d)
    return fc.groupBy("model", "predicted_hour", verify.realign_stored(F.col("ts"), F.col("predicted_hour")).alias("target_ts")).agg(
        F.count(F.lit(1)).alias("n"), r(F.avg("pred")).alias("mean_pred"))


@query("station_envelope", f"""with {v.FC}, t as (select *, ts - to_hours(predicted_hour - 1) as target_ts from fc)
select model, predicted_hour, target_ts, round(avg(target) @6) as mean_target, round(max(target) @6) as max_target, round(min(target) @6) as min_target,
       round(avg(pred) @6) as mean_pred, round(max(pred) @6) as max_pred, round(min(pred) @6) as min_pred
from t where target_ts between timestamp '1998-01-01' and timestamp '1999-12-31' group by 1, 2, 3""")
def station_envelope(spark, d):
    e = verify.station_envelope(v.fc_long(spark, d), "1998-01-01", "1999-12-31")
    return rounded(e, *[c for c in e.columns if c[:4] in ("mean", "max_", "min_")])


@query("metric_tracker", f"""with {v.FC}, b as (select model, predicted_hour, station, avg(abs(pred - target)) as loss, count(*) as n from fc group by 1, 2, 3)
select model, predicted_hour, round(sum(loss * n) @4) as total, sum(n)::bigint as counts, round(sum(loss * n) / sum(n) @6) as average from b group by 1, 2""")
def metric_tracker(spark, d):
    b = v.fc_long(spark, d).groupBy("model", "predicted_hour", "station").agg(
        F.avg(F.abs(F.col("pred") - F.col("target"))).alias("loss"), F.count(F.lit(1)).alias("n"))
    t = verify.metric_tracker(b, ["model", "predicted_hour"], "loss", "n")
    return t.select("model", "predicted_hour", r("total", 4).alias("total"), "counts", r("average").alias("average"))
