"""Forecast verification on ``(model, predicted_hour, ts, station, target, pred)``.

Every metric is a mergeable aggregate, so a model or station holding most rows is
reduced on the map side before anything is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from brisa.functions import clock, metrics
from brisa.operators import ranks
from brisa.operators.blocks import ranged_positions
from brisa.schema import AGGREGATE_STATIONS
from brisa.session import settle

# Ozone alert thresholds in ppb.
THRESHOLDS = [90, 120, 150]


def pairs(fc: DataFrame, stations_only: bool = True) -> DataFrame:
    """Rows with both values; aggregate series (min, max, mean) left out on request."""
    d = fc.filter(F.col("target").isNotNull() & F.col("pred").isNotNull())
    return d.filter(~F.col("station").isin(AGGREGATE_STATIONS)) if stations_only else d


def rmse_by(fc: DataFrame, by: Sequence[str], stations_only: bool = True) -> DataFrame:
    """RMSE and pair count per group; a group without any pair keeps a null."""
    d = fc.filter(~F.col("station").isin(AGGREGATE_STATIONS)) if stations_only else fc
    err = F.col("pred") - F.col("target")
    return d.groupBy(*by).agg(F.sqrt(F.avg(err * err)).alias("rmse"), F.count(err).alias("n"))


def model_summary(by_hour: DataFrame) -> DataFrame:
    """Spread of the hourly RMSE per model; population deviation."""
    return by_hour.groupBy("model").agg(
        F.avg("rmse").alias("mean_rmse"), F.stddev_pop("rmse").alias("std_rmse"), F.min("rmse").alias("min_rmse"),
        F.max("rmse").alias("max_rmse"), F.count("rmse").alias("hours_available"))


def confusion(fc: DataFrame, by: Sequence[str] = ("model",), thresholds: Sequence[float] = THRESHOLDS) -> DataFrame:
    """tp, fp, tn, fn per group and threshold in one pass over the pairs."""
    d = pairs(fc)
    aggs = []
    for th in thresholds:
        t, p = F.col("target") >= th, F.col("pred") >= th
        aggs.append(F.struct(F.lit(th).alias("threshold"), F.count_if(t & p).alias("tp"), F.count_if(~t & p).alias("fp"),
                             F.count_if(~t & ~p).alias("tn"), F.count_if(t & ~p).alias("fn")))
    return d.groupBy(*by).agg(F.array(*aggs).alias("_a")).select(*by, F.inline("_a"))


def class_metrics(conf: DataFrame) -> DataFrame:
    tp, fp, tn, fn = (F.col(c).cast("double") for c in ("tp", "fp", "tn", "fn"))

    def ratio(a: Column, b: Column) -> Column:
        return F.coalesce(F.try_divide(a, b), F.lit(0.0))

    return conf.withColumns({"accuracy": ratio(tp + tn, tp + fp + tn + fn), "sensitivity": ratio(tp, tp + fn),
                             "specificity": ratio(tn, tn + fp)})


def class_summary(conf_metrics: DataFrame, thresholds: Sequence[float] = THRESHOLDS, digits: int = 3) -> DataFrame:
    """One row per model, one column per threshold and metric."""
    cols = [F.round(F.max(F.when(F.col("threshold") == t, F.col(m))), digits).alias(f"{m}_{t}")
            for t in thresholds for m in ("accuracy", "sensitivity", "specificity")]
    return conf_metrics.groupBy("model").agg(*cols)


def metric_suite(fc: DataFrame, by: Sequence[str]) -> DataFrame:
    """MAE, MAPE, MSE, RMSE, R2, index of agreement, correlation and N per group.

    Only the index of agreement needs the observed mean first; that table has one row per group
    and is settled, so the pairs are not shuffled to meet it while it is small.
    """
    d = pairs(fc, stations_only=False)
    t, p = F.col("target"), F.col("pred")
    err = p - t
    first = settle(d.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.abs(err)).alias("mae"),
        F.avg(F.abs(err) / F.greatest(F.abs(t), F.lit(2.220446049250313e-16))).alias("mape"),
        F.avg(err * err).alias("mse"), F.corr(t, p).alias("corr"), F.avg(t).alias("obar"), F.var_pop(t).alias("_vt")), "group-means")
    ioa = (d.join(first.select(*by, "obar"), list(by))
           .groupBy(*by).agg(F.sum(F.pow(F.abs(p - F.col("obar")) + F.abs(t - F.col("obar")), 2)).alias("_den")))
    return (first.join(ioa, list(by))
            .withColumns({"rmse": F.sqrt("mse"), "r2": 1 - F.try_divide(F.col("mse"), F.col("_vt")),
                          "ioa": 1 - F.try_divide(F.col("mse") * F.col("n"), F.col("_den"))})
            .drop("_vt", "_den", "obar"))


def linear_fit(fc: DataFrame, by: Sequence[str]) -> DataFrame:
    """forecast = slope * observed + intercept."""
    return pairs(fc, stations_only=False).groupBy(*by).agg(
        F.regr_slope("pred", "target").alias("slope"), F.regr_intercept("pred", "target").alias("intercept"))


def apply_metrics(df: DataFrame, by: Sequence[str], names: Sequence[str], target: str = "target", pred: str = "pred",
                  integers: bool = False) -> DataFrame:
    """Registered metrics per group; ``integers`` truncates both values and drops null targets first.

    Ranked metrics read the rows twice each; their group's rows never meet in one task.
    """
    d = df.filter(F.col(target).isNotNull())
    t, p = F.col(target), F.col(pred)
    if integers:
        t, p = t.cast("int").cast("double"), p.cast("int").cast("double")
    found = {n: metrics.get(n) for n in names}
    ranked = {n: m for n, m in found.items() if isinstance(m, metrics.Ranked)}
    if not ranked:
        return d.groupBy(*by).agg(*[m(t, p).alias(n) for n, m in found.items()])
    out = d.groupBy(*by).agg(F.count(F.lit(1)).alias("_rows"), *[m(t, p).alias(n) for n, m in found.items() if n not in ranked])
    out = out.withColumn("_g", ranks.group_key(by))
    both = d.filter(p.isNotNull() & ~F.isnan(t.cast("double")) & ~F.isnan(p.cast("double")))
    for n, m in ranked.items():
        out = out.join(ranks.group_quantiles(both, by, m.value(t, p), m.quantile, n), "_g", "left")
    return out.select(*by, *names)


def metrics_by_split(df: DataFrame, by: Sequence[str], split: str, names: Sequence[str],
                     splits: Sequence[str] = ("train", "val", "test")) -> DataFrame:
    """Metrics over all rows and per split, one output row per (group, split)."""
    both = df.withColumn("_s", F.explode(F.array(F.lit("all"), F.col(split)))).filter(F.col("_s").isin("all", *splits))
    return apply_metrics(both, [*by, "_s"], names).withColumnRenamed("_s", "split")


def mean_of(df: DataFrame, by: str, value: str) -> DataFrame:
    """Average metric per group, plus the overall mean of those averages as group ``ALL``."""
    per = df.groupBy(F.col(by).cast("string").alias("grp")).agg(F.avg(value).alias("avg_metric"))
    return per.unionByName(per.agg(F.avg("avg_metric").alias("avg_metric")).withColumn("grp", F.lit("ALL")))


def daily_block_error(fc: DataFrame, by: Sequence[str], order: Sequence[str], replace: float = 0.0, size: int = 24) -> DataFrame:
    """Error of block maxima and means over blocks of ``size`` consecutive rows.

    A null target replaces both values; the tail block is padded with zeros; blocks whose
    observed maximum is 0 do not count. Deviations are of the population.
    """
    gap = F.col("target").isNull()
    d = fc.withColumns({"target": F.when(gap, F.lit(replace)).otherwise(F.col("target")),
                        "pred": F.when(gap, F.lit(replace)).otherwise(F.col("pred"))})
    d = ranged_positions(d.select(*dict.fromkeys([*by, *order, "target", "pred"])), by, order, "pos")
    full = F.count(F.lit(1)) == size

    def top(c: str) -> Column:
        return F.when(full, F.max(c)).otherwise(F.greatest(F.max(c), F.lit(0.0)))

    b = d.groupBy(*by, F.floor((F.col("pos") - 1) / size).alias("block")).agg(
        top("target").alias("tm"), top("pred").alias("pm"), (F.sum("target") / size).alias("ta"), (F.sum("pred") / size).alias("pa"))
    b = b.filter(F.col("tm") != 0)
    em, ea = F.col("tm") - F.col("pm"), F.col("ta") - F.col("pa")
    return b.groupBy(*by).agg(
        F.count(F.lit(1)).alias("blocks"), F.avg(em).alias("max_err_mean"), F.stddev_pop(em).alias("max_err_std"),
        F.avg(ea).alias("mean_err_mean"), F.stddev_pop(ea).alias("mean_err_std"))


def best_worst(by_hour: DataFrame) -> DataFrame:
    """Best and worst model by mean RMSE with overall spread and coverage."""
    per = by_hour.groupBy("model").agg(F.avg("rmse").alias("m"))
    head = per.agg(F.min_by("model", F.struct("m", "model")).alias("best_model"), F.min("m").alias("best_rmse"),
                   F.max_by("model", F.struct("m", "model")).alias("worst_model"), F.max("m").alias("worst_rmse"),
                   F.avg("m").alias("avg_rmse"), F.stddev_samp("m").alias("std_rmse"))
    cover = by_hour.agg(F.count_distinct("model").alias("n_models"), F.count_distinct("predicted_hour").alias("n_hours"),
                        F.min("predicted_hour").alias("first_hour"), F.max("predicted_hour").alias("last_hour"))
    return head.withColumn("_c", cover.select(F.struct("*")).scalar()).select("*", "_c.*").drop("_c")


def rmse_quartiles(by_hour: DataFrame) -> DataFrame:
    """Box values of the hourly RMSE per model (one value per horizon, so the exact percentile is small)."""
    q = F.percentile("rmse", [0.25, 0.5, 0.75])
    return by_hour.groupBy("model").agg(F.min("rmse").alias("lo"), q.alias("_q"), F.max("rmse").alias("hi")).select(
        "model", "lo", *[F.col("_q")[i].alias(n) for i, n in enumerate(("q25", "q50", "q75"))], "hi")


def density_bins(fc: DataFrame, by: Sequence[str], bins: int = 30, lo: float = 0.0, hi: float = 180.0) -> DataFrame:
    """Pair counts on a square observed x forecast grid over ``[lo, hi]``."""
    width = (hi - lo) / bins

    def cell(c: str) -> Column:
        return F.least(F.floor((F.col(c) - lo) / width), F.lit(bins - 1)).cast("int")

    d = pairs(fc, stations_only=False).filter(F.col("target").between(lo, hi) & F.col("pred").between(lo, hi))
    return d.groupBy(*by, cell("target").alias("obs_bin"), cell("pred").alias("fc_bin")).agg(F.count(F.lit(1)).alias("n"))


def model_inventory(fc: DataFrame) -> DataFrame:
    return fc.groupBy("model").agg(F.count(F.lit(1)).alias("records"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


def model_families(models: DataFrame, column: str = "model") -> DataFrame:
    """Models grouped by the part before the first underscore."""
    return models.groupBy(F.split(column, "_").getItem(0).alias("family")).agg(F.count_distinct(column).alias("variants"))


def rank_models(summary: DataFrame) -> DataFrame:
    """Rank by mean RMSE. The input has one row per model."""
    return summary.withColumn("rank", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("mean_rmse", "model")))


def model_ids(models: DataFrame) -> DataFrame:
    """``M01``, ``M02``, ... in name order. The input has one row per model."""
    n = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("model"))
    return models.select("model").distinct().withColumn("model_id", F.format_string("M%02d", n))


def target_time(origin: Column, horizon: Column) -> Column:
    """Hour a forecast is for: horizon 1 is the origin hour itself."""
    return clock.shift_hours(origin, horizon.cast("bigint") - 1)


def realign_stored(stored: Column, horizon: Column) -> Column:
    """Files store origin + 2k for horizon k + 1; the target hour is origin + k."""
    return clock.shift_hours(stored, 1 - horizon.cast("bigint"))


def station_envelope(fc: DataFrame, start=None, end=None) -> DataFrame:
    """Mean, max and min over stations of target and forecast per model, horizon and target hour."""
    d = fc.withColumn("target_ts", realign_stored(F.col("ts"), F.col("predicted_hour")))
    if start is not None:
        d = d.filter(F.col("target_ts") >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        d = d.filter(F.col("target_ts") <= F.lit(end).cast("timestamp_ntz"))
    aggs = [f(c).alias(f"{n}_{c}") for c in ("target", "pred") for n, f in (("mean", F.avg), ("max", F.max), ("min", F.min))]
    return d.groupBy("model", "predicted_hour", "target_ts").agg(*aggs)


def metric_tracker(batches: DataFrame, by: Sequence[str], value: str, n: str) -> DataFrame:
    """Running weighted average per metric key: total, counts, average."""
    return batches.groupBy(*by).agg(F.sum(F.col(value) * F.col(n)).alias("total"), F.sum(n).alias("counts")).withColumn(
        "average", F.try_divide(F.col("total"), F.col("counts")))
