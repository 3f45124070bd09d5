"""Quality rules and flagged gap filling on a gap-free hourly panel ``(pollutant, id_est, h, fecha, val)``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from brisa.functions import air, clock
from brisa.operators import panel
from brisa.operators.blocks import windowed
from brisa.session import settle

SERIES = panel.SERIES


def apply_quality(obs: DataFrame) -> DataFrame:
    return obs.withColumn("val", air.clean_value(F.col("val"), F.col("pollutant")))


def quality_report(obs: DataFrame) -> DataFrame:
    """Per series: missing before, negative, too high, and cleaned readings."""
    v = F.col("val")
    high = v > air.quality_limit(F.col("pollutant"))
    return obs.groupBy(*SERIES).agg(
        F.count_if(v.isNull()).alias("missing"), F.count_if(v < 0).alias("negative"),
        F.count_if(high).alias("too_high"), F.count_if((v < 0) | high).alias("cleaned"))


def row_average(obs: DataFrame, min_valid: int = 5) -> DataFrame:
    """Mean over stations per (pollutant, hour) with more than ``min_valid`` readings: ``row_val``."""
    g = obs.groupBy("pollutant", clock.hour_index(F.col("fecha")).alias("h")).agg(
        F.avg("val").alias("row_val"), F.count("val").alias("_n"))
    return g.filter(F.col("_n") > min_valid).drop("_n")


def row_average_trimmed(obs: DataFrame, min_valid: int = 2, q: float = 0.95) -> DataFrame:
    """Mean of the positive readings below the ``q`` quantile per (pollutant, hour), over ``min_valid`` readings.

    A gap has no reading of its own, so "the other stations" are all that report. The group is
    one hour of one pollutant, i.e. at most one row per station.
    """
    w = Window.partitionBy("pollutant", "h")
    d = (obs.filter(F.col("val").isNotNull())
         .select("pollutant", clock.hour_index(F.col("fecha")).alias("h"), "val")
         .withColumn("_n", F.count("val").over(w))
         .withColumn("_q", F.percentile("val", F.lit(q)).over(w)))
    return (d.filter((F.col("_n") > min_valid) & (F.col("val") > 0) & (F.col("val") < F.col("_q")))
            .groupBy("pollutant", "h").agg(F.avg("val").alias("row_val")))


def start_flags(full: DataFrame) -> DataFrame:
    return full.withColumn("flag", F.when(F.col("val").isNotNull(), "none").otherwise("missing"))


def _fill(df: DataFrame, candidate: Column, flag: str) -> DataFrame:
    todo = (F.col("flag") == "missing") & candidate.isNotNull()
    return df.withColumns({"val": F.when(todo, candidate).otherwise(F.col("val")),
                           "flag": F.when(todo, F.lit(flag)).otherwise(F.col("flag"))})


def fill_row_average(full: DataFrame, rows: DataFrame) -> DataFrame:
    d = full.join(rows, ["pollutant", "h"], "left")
    return _fill(d, F.col("row_val"), "row_avg").drop("row_val")


def fill_row_average_here(full: DataFrame, min_valid: int = 5) -> DataFrame:
    """Row average of a panel clustered by (pollutant, h): a window of one row per station, no exchange."""
    w = Window.partitionBy("pollutant", "h")
    d = full.withColumns({"_n": F.count("val").over(w), "_a": F.avg("val").over(w)})
    return _fill(d, F.when(F.col("_n") > min_valid, F.col("_a")), "row_avg").drop("_n", "_a")


def fill_row_average_trimmed_here(full: DataFrame, min_valid: int = 2, q: float = 0.95) -> DataFrame:
    """The trimmed row average of a panel clustered by (pollutant, h): windows of one row per station, no second read of the source."""
    w = Window.partitionBy("pollutant", "h")
    d = full.withColumns({"_n": F.count("val").over(w), "_q": F.percentile("val", F.lit(q)).over(w)})
    d = d.withColumn("_a", F.avg(F.when((F.col("_n") > min_valid) & (F.col("val") > 0) & (F.col("val") < F.col("_q")), F.col("val"))).over(w))
    return _fill(d, F.col("_a"), "row_avg").drop("_n", "_q", "_a")


def fill_persistence_chain(full: DataFrame) -> DataFrame:
    """Last value at the same hour of day, however far back (filled values feed the next day).

    The window key holds one row per day of one series, whatever the data.
    """
    w = (Window.partitionBy(*SERIES, F.pmod("h", F.lit(24))).orderBy("h")
         .rowsBetween(Window.unboundedPreceding, -1))
    d = full.withColumn("_prev", F.last("val", ignorenulls=True).over(w))
    return _fill(d, F.col("_prev"), "last_day_same_hour").drop("_prev")


def fill_persistence_day(full: DataFrame) -> DataFrame:
    """Yesterday's value at the same hour only; no chaining."""
    d = windowed(full, SERIES, "h", lambda w: {"_prev": F.last("val").over(w.rangeBetween(-24, -24))}, before=24)
    return _fill(d, F.col("_prev"), "last_day_same_hour").drop("_prev")


def _calendar_key(d: DataFrame) -> DataFrame:
    return d.withColumns({"_mo": F.month("fecha"), "_da": F.day("fecha"), "_ho": F.hour("fecha")})


def fill_lookup(full: DataFrame, table: DataFrame, flag: str) -> DataFrame:
    """Fill from a ``(pollutant, id_est, month, day, hour, val)`` table; flagged only when it has a value."""
    t = table.select(*SERIES, F.col("month").alias("_mo"), F.col("day").alias("_da"), F.col("hour").alias("_ho"),
                     F.col("val").alias("_tv"))
    d = _calendar_key(full).join(t, [*SERIES, "_mo", "_da", "_ho"], "left")
    return _fill(d, F.col("_tv"), flag).drop("_mo", "_da", "_ho", "_tv")


def historical_average(obs: DataFrame, as_of, years: int = 5, min_rows: int = 5) -> DataFrame:
    """Mean of positive readings at the same month, day and hour in the ``years`` before ``as_of``."""
    end = F.lit(as_of).cast("timestamp_ntz")
    d = obs.filter((F.col("fecha") >= end - F.expr(f"interval {years} years")) & (F.col("fecha") < end) & (F.col("val") > 0))
    return (d.groupBy(*SERIES, F.month("fecha").alias("month"), F.day("fecha").alias("day"), F.hour("fecha").alias("hour"))
            .agg(F.avg("val").alias("val"), F.count(F.lit(1)).alias("_n"))
            .filter(F.col("_n") >= min_rows).drop("_n"))


def fill_history(full: DataFrame, past: DataFrame, years: int = 5, min_rows: int = 5) -> DataFrame:
    """Fill a missing hour with the mean of positive readings at its month, day and hour in the ``years`` before it.

    The range ends at the hour itself and not at a forecast's origin, so many origins can share one
    panel. ``full`` is a settled panel with flags, ``past`` hourly readings; only missing rows are joined.
    """
    key = {"_mo": F.month("fecha"), "_da": F.day("fecha"), "_ho": F.hour("fecha")}
    then = past.filter(F.col("val") > 0).withColumns(key).select(*SERIES, *key, F.col("fecha").alias("_then"), F.col("val").alias("_v"))
    gaps = full.filter(F.col("flag") == "missing").withColumns(key).select(*SERIES, *key, "h", "fecha")
    near = (F.col("_then") < F.col("fecha")) & (F.col("_then") >= F.col("fecha") - F.expr(f"interval {years} years"))
    mean = (gaps.join(then, [*SERIES, *key]).filter(near).groupBy(*SERIES, "h").agg(F.avg("_v").alias("_hist"), F.count(F.lit(1)).alias("_n"))
            .filter(F.col("_n") >= min_rows).drop("_n"))
    return _fill(full.join(mean, [*SERIES, "h"], "left"), F.col("_hist"), "historical_avg").drop("_hist")


def climatology(obs: DataFrame) -> DataFrame:
    """Mean year on the 2012 calendar, smoothed over three hours, with the wrap-around edges.

    8,784 rows per series, so a series is one bounded window group.
    """
    base = F.lit("2012-01-01 00:00:00").cast("timestamp_ntz")
    first = clock.hour_index(base)
    means = (obs.filter(F.col("val").isNotNull())
             .groupBy(*SERIES, F.month("fecha").alias("_mo"), F.day("fecha").alias("_da"), F.hour("fecha").alias("_ho"))
             .agg(F.avg("val").alias("_m"))
             .withColumn("h", clock.hour_index(F.make_timestamp_ntz(
                 F.lit(2012), F.col("_mo"), F.col("_da"), F.col("_ho"), F.lit(0), F.lit(0)))))
    cal = panel.hour_calendar(obs, SERIES, first, first + 8783)
    w = Window.partitionBy(*SERIES)
    d = (cal.join(means.select(*SERIES, "h", "_m"), [*SERIES, "h"], "left")
         .withColumn("_i", F.col("h") - first)
         .withColumn("_a", F.avg("_m").over(w.orderBy("h").rowsBetween(-1, 1))))

    def pick(i: int) -> Column:
        return F.max(F.when(F.col("_i") == i, F.col("_a"))).over(w)

    d = d.withColumns({"_a0": pick(0), "_a1": pick(1), "_y": pick(8782), "_z": pick(8783)})
    new_first = (F.col("_z") + F.col("_a0") + F.col("_a1")) / 3
    new_last = (F.col("_y") + F.col("_z") + new_first) / 3
    val = F.when(F.col("_i") == 0, new_first).when(F.col("_i") == 8783, new_last).otherwise(F.col("_a"))
    ts = clock.hour_stamp(F.col("h"))
    return d.select(*SERIES, F.month(ts).alias("month"), F.day(ts).alias("day"), F.hour(ts).alias("hour"), val.alias("val"))


def training_pipeline(obs: DataFrame, start=None, end=None, min_valid: int = 5, clim: DataFrame | None = None) -> DataFrame:
    """Quality rules, row average, chained persistence, climatology; every row carries its flag."""
    clean = apply_quality(obs)
    full = start_flags(panel.fill_calendar(clean, SERIES, start, end, cluster=["pollutant", "h"]))
    d = fill_row_average_here(full, min_valid)
    d = fill_persistence_chain(d)
    clim = settle(climatology(clean), "climatology") if clim is None else clim
    return fill_lookup(d, clim, "climatology")


def operational_pipeline(obs: DataFrame, as_of, history: DataFrame, start=None, end=None) -> DataFrame:
    """Quality rules, trimmed row average, one-day persistence, historical average."""
    clean = apply_quality(obs)
    full = start_flags(panel.fill_calendar(clean, SERIES, start, end, cluster=["pollutant", "h"]))
    d = fill_persistence_day(fill_row_average_trimmed_here(full))
    return fill_lookup(d, settle(historical_average(history, as_of), "historical"), "historical_avg")


def summary(filled: DataFrame) -> DataFrame:
    """Counts per flag and the imputation rate of each series."""
    flags = ["row_avg", "last_day_same_hour", "climatology", "historical_avg"]
    f = F.col("flag")
    n = F.count(F.lit(1))
    imputed = F.count_if(f.isin(flags))
    return filled.groupBy(*SERIES).agg(
        n.alias("n"), F.count_if(f == "none").alias("original"), imputed.alias("imputed"),
        F.count_if(f == "missing").alias("missing"), *[F.count_if(f == x).alias(x) for x in flags],
        F.round(imputed * 100.0 / n, 1).alias("rate_pct"))
