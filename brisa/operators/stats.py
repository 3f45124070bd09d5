"""Aggregates over observations, flags and parameters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from brisa.functions import clock
from brisa.operators import panel
from brisa.operators.blocks import exact_quantiles, value_counts
from brisa.session import settle

SERIES = panel.SERIES


def count_valid(obs: DataFrame, since: int | None = None, until: int | None = None, year: int | None = None) -> DataFrame:
    d = obs.filter(F.col("val").isNotNull())
    if year is not None:
        d = d.filter(F.year("fecha") == year)
    if since is not None:
        d = d.filter(F.year("fecha") >= since)
    if until is not None:
        d = d.filter(F.year("fecha") <= until)
    return d.groupBy("id_est").agg(F.count("val").alias("n"))


def daily_max(obs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    day = [F.year("fecha").alias("year"), F.month("fecha").alias("month"), F.day("fecha").alias("day")]
    return obs.groupBy(*by, *day).agg(F.max("val").alias("max_val"))


def station_stats(obs: DataFrame, keep: str = "otres") -> DataFrame:
    """Mean, min and max over stations per hour; the kept pollutant stays per station.

    Long output ``(fecha, pollutant, id_est, val)`` with id_est mean/min/max for the others.
    """
    agg = (obs.filter(F.col("pollutant") != keep).groupBy("fecha", "pollutant")
           .agg(F.avg("val").alias("mean"), F.min("val").alias("min"), F.max("val").alias("max"))
           .unpivot(["fecha", "pollutant"], ["mean", "min", "max"], "id_est", "val"))
    return agg.unionByName(obs.filter(F.col("pollutant") == keep).select("fecha", "pollutant", "id_est", "val"))


def mask_stats(filled: DataFrame, keep: str = "otres") -> DataFrame:
    """0/1 masks of the aggregated series: any, all, any station filled."""
    m = panel.flag_to_mask(F.col("flag"))
    return (filled.filter(F.col("pollutant") != keep).groupBy("fecha", "pollutant")
            .agg(F.max(m).alias("mask_mean"), F.min(m).alias("mask_min"), F.max(m).alias("mask_max")))


def norm_params(obs: DataFrame, wx: DataFrame | None = None, compat: str = "exact") -> DataFrame:
    """(kind, name, mean, std): mean of series means and of series sample deviations per pollutant;
    cell mean and population deviation per weather variable.

    ``compat='prefix'`` pools every series whose code starts with the pollutant's code.
    """
    per = obs.groupBy(*SERIES).agg(F.avg("val").alias("m"), F.stddev_samp("val").alias("s"))
    if compat == "prefix":
        codes = per.select(F.col("pollutant").alias("code")).distinct()
        heads = per.withColumn("code", F.explode(F.transform(
            F.sequence(F.lit(1), F.length("pollutant")), lambda i: F.substring(F.col("pollutant"), F.lit(1), i))))
        per = heads.join(codes, "code").drop("pollutant").withColumnRenamed("code", "pollutant")
    out = per.groupBy("pollutant").agg(F.avg("m").alias("mean"), F.avg("s").alias("std")).select(
        F.lit("pollutant").alias("kind"), F.col("pollutant").alias("name"), "mean", "std")
    if wx is not None:
        out = out.unionByName(wx.groupBy("var").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"))
                              .select(F.lit("weather").alias("kind"), F.col("var").alias("name"), "mean", "std"))
    return out


def zscore(df: DataFrame, params: DataFrame, name: str = "pollutant", value: str = "val", fill: float | None = 0.0,
           out: str = "z") -> DataFrame:
    """Standardised values by exact name; nulls become ``fill`` afterwards."""
    p = params.select(F.col("name").alias(name), "mean", "std")
    z = F.try_divide(F.col(value) - F.col("mean"), F.col("std"))
    z = z if fill is None else F.coalesce(z, F.lit(fill))
    return df.join(p, name, "left").withColumn(out, z).drop("mean", "std")


def denormalize(df: DataFrame, params: DataFrame, name: str = "pollutant", value: str = "z", out: str = "val") -> DataFrame:
    p = params.select(F.col("name").alias(name), "mean", "std")
    return df.join(p, name, "left").withColumn(out, F.col(value) * F.col("std") + F.col("mean")).drop("mean", "std")


def prefix_chain(params: DataFrame, codes: DataFrame, order: str = "ord") -> DataFrame:
    """Per code, the ordered list of parameters whose name starts the code: ``(pollutant, chain)``.

    Shipped parameter files were fitted and applied by name prefix, so ``nodos`` passes
    through ``nodos`` and ``no`` in file order.
    """
    heads = codes.select("pollutant", F.explode(F.transform(
        F.sequence(F.lit(1), F.length("pollutant")),
        lambda i: F.substring(F.col("pollutant"), F.lit(1), i))).alias("name"))
    step = F.struct(F.col(order).alias("o"), F.col("mean").alias("m"), F.col("std").alias("s"))
    return heads.join(params, "name").groupBy("pollutant").agg(F.array_sort(F.collect_list(step)).alias("chain"))


def prefix_zscore(value, chain):
    return F.aggregate(chain, value.cast("double"), lambda x, p: (x - p["m"]) / p["s"])


def prefix_denormalize(value, chain):
    """Same order as the forward pass, hence not its inverse for codes with two parameters."""
    return F.aggregate(chain, value.cast("double"), lambda x, p: x * p["s"] + p["m"])


def minmax_params(df: DataFrame, by: str, value: str) -> DataFrame:
    return df.groupBy(by).agg(F.min(value).alias("lo"), F.max(value).alias("hi"))


def minmax_scale(df: DataFrame, params: DataFrame, by: str, value: str, out: str = "scaled") -> DataFrame:
    width = F.when(F.col("hi") > F.col("lo"), F.col("hi") - F.col("lo")).otherwise(F.lit(1.0))
    return df.join(params, by, "left").withColumn(out, (F.col(value) - F.col("lo")) / width).drop("lo", "hi")


def minmax_restore(df: DataFrame, params: DataFrame, by: str, scaled: str, out: str) -> DataFrame:
    return df.join(params, by, "left").withColumn(
        out, F.col(scaled) * (F.col("hi") - F.col("lo")) + F.col("lo")).drop("lo", "hi")


def restore_ozone(value):
    """Inverse of the fixed 0-250 ozone scaling."""
    return value * 250.0


def standard_params(df: DataFrame, by: str, value: str) -> DataFrame:
    return df.groupBy(by).agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"))


def standard_scale(df: DataFrame, params: DataFrame, by: str, value: str, out: str = "scaled") -> DataFrame:
    scale = F.when(F.col("std") > 0, F.col("std")).otherwise(F.lit(1.0))
    return df.join(params, by, "left").withColumn(out, (F.col(value) - F.col("mean")) / scale).drop("mean", "std")


def high_events(obs: DataFrame, pollutant: str = "otres", k: float = 2.0) -> DataFrame:
    """Hours where any station exceeds mean + k population deviations: ``(fecha, top, threshold)``."""
    d = obs.filter(F.col("pollutant") == pollutant)
    thr = d.select((F.avg("val") + F.stddev_pop("val") * k)).scalar()
    return (d.groupBy("fecha").agg(F.max("val").alias("top")).withColumn("threshold", thr)
            .filter(F.col("top") > F.col("threshold")))


def completeness(full: DataFrame) -> DataFrame:
    """Overall completeness of a panel with its range and the spread of its series."""
    per = full.groupBy(*SERIES).agg(
        F.count(F.lit(1)).alias("n"), F.count("val").alias("v"), F.avg("val").alias("m"), F.stddev_samp("val").alias("s"),
        F.min("val").alias("lo"), F.max("val").alias("hi"), F.min("fecha").alias("t0"), F.max("fecha").alias("t1"))
    return per.agg(
        F.count(F.lit(1)).alias("n_series"), F.sum("n").alias("n_cells"), (F.sum("n") - F.sum("v")).alias("n_missing"),
        (F.sum("v") * 100.0 / F.sum("n")).alias("complete_pct"), F.min("t0").alias("first_ts"), F.max("t1").alias("last_ts"),
        F.avg("m").alias("mean_of_means"), F.avg("s").alias("mean_of_stds"), F.min("lo").alias("min_val"), F.max("hi").alias("max_val"))


def problem_origins(values: DataFrame) -> DataFrame:
    """Origins whose series are all null, with valid and missing counts."""
    return (values.groupBy("origin").agg(F.count("value").alias("valid"), F.count_if(F.col("value").isNull()).alias("missing"))
            .withColumn("is_problem", (F.col("valid") == 0).cast("int")))


def column_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, unique, top, freq, mean, std, min, quartiles and max of numeric columns over the whole table."""
    long = df.select([F.col(c).cast("double").alias(c) for c in columns]).unpivot([], list(columns), "column", "v")
    basic = long.groupBy("column").agg(
        F.count("v").alias("count"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"),
        F.min("v").alias("min"), F.max("v").alias("max"))
    counts = settle(value_counts(long, ["column"], "v"), "counts")
    modes = counts.groupBy("column").agg(
        F.count(F.lit(1)).alias("unique"), F.max_by("_v", F.struct("_c", -F.col("_v"))).alias("top"), F.max("_c").alias("freq"))
    q = exact_quantiles(counts, ["column"], [0.25, 0.5, 0.75])
    quart = q.groupBy("column").agg(*[F.max(F.when(F.col("p") == p, F.col("q"))).alias(n)
                                      for p, n in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))])
    return basic.join(modes, "column", "left").join(quart, "column", "left")


def category_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, unique, top and freq of text columns."""
    counts = value_counts(df.select([F.col(c).cast("string").alias(c) for c in columns]).unpivot([], list(columns), "column", "v"), ["column"], "v")
    # equal counts: the first value in text order
    top = F.min_by("_v", F.struct(-F.col("_c"), F.col("_v")))
    return counts.groupBy("column").agg(F.sum("_c").alias("count"), F.count(F.lit(1)).alias("unique"), top.alias("top"), F.max("_c").alias("freq"))


def next_target(obs: DataFrame, default_ts=None) -> DataFrame:
    """Hour after the last observed one; a given default when there is none."""
    last = F.max(F.when(F.col("val").isNotNull(), F.col("fecha")))
    nxt = clock.shift_hours(last, 1)
    if default_ts is not None:
        nxt = F.coalesce(nxt, F.lit(default_ts).cast("timestamp_ntz"))
    return obs.agg(nxt.alias("target_ts"))
