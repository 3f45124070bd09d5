"""Lagged, leading and sliding features of hourly series.

All take a gap-free panel (see :func:`brisa.operators.panel.fill_calendar`), so a shift by
rows is a shift by hours, and all windows run on bounded time blocks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.window import WindowSpec

from brisa.functions import air, clock
from brisa.operators.blocks import windowed
from brisa.operators.panel import SERIES


def _frame(w: WindowSpec) -> Column:
    """The frame's values in time order, nulls kept: one frame serves all shifts."""
    return F.collect_list(F.struct("val")).over(w)


def lag_features(full: DataFrame, hours: int = 24, keys: Sequence[str] = SERIES) -> DataFrame:
    """Columns ``minus_01`` .. ``minus_NN``."""
    d = windowed(full, keys, "h", lambda w: {"_f": _frame(w.rowsBetween(-hours, -1))}, before=hours)
    return d.selectExpr("*", *[f"try_element_at(_f, -{k}).val as minus_{k:02d}" for k in range(1, hours + 1)]).drop("_f")


def lead_targets(full: DataFrame, hours: Sequence[int] = range(1, 25), keys: Sequence[str] = SERIES) -> DataFrame:
    """Columns ``plus_01`` .. ``plus_NN``."""
    d = windowed(full, keys, "h", lambda w: {"_f": _frame(w.rowsBetween(1, max(hours)))}, after=max(hours))
    return d.selectExpr("*", *[f"try_element_at(_f, {k}).val as plus_{k:02d}" for k in hours]).drop("_f")


def rolling_mean(full: DataFrame, half: int = 1, keys: Sequence[str] = SERIES) -> DataFrame:
    """Centred mean over the values present, at least one."""
    return windowed(full, keys, "h", lambda w: {"rolling": F.avg("val").over(w.rowsBetween(-half, half))},
                    before=half, after=half)


def nowcast12(full: DataFrame, pollutant: str = "PM10", hours: int = 12, newest_first: bool = False,
              keys: Sequence[str] = SERIES) -> DataFrame:
    """Weighted mean of the last ``hours`` readings and its category."""
    d = windowed(full, keys, "h", lambda w: {"_v": F.collect_list("val").over(w.rowsBetween(-(hours - 1), 0))}, before=hours)
    c = air.nowcast(F.col("_v"), air.NOWCAST_FACTOR[pollutant], newest_first)
    return d.withColumn("nowcast", c).drop("_v").withColumn("category", air.aq_category(F.col("nowcast"), F.lit(pollutant)))


def rain_deaccumulate(df: DataFrame, keys: Sequence[str], step: str, value: str, out: str = "rain") -> DataFrame:
    """Backward difference of accumulated rain inside one file and cell; first step 0, negatives 0."""
    w = Window.partitionBy(*keys).orderBy(step)
    return df.withColumn(out, F.greatest(F.coalesce(F.col(value) - F.lag(value).over(w), F.lit(0.0)), F.lit(0.0)))


def rain_forward_diff(df: DataFrame, keys: Sequence[str], step: str, value: str, out: str = "rain", clamp: bool = True) -> DataFrame:
    """Forward difference; the last step keeps its value; negatives 0 when clamped."""
    w = Window.partitionBy(*keys).orderBy(step)
    x = F.coalesce(F.lead(value).over(w) - F.col(value), F.col(value))
    return df.withColumn(out, F.greatest(x, F.lit(0.0)) if clamp else x)


def contiguous_runs(obs: DataFrame, min_hours: int = 1, keys: Sequence[str] = SERIES) -> DataFrame:
    """Runs of hours without a gap: ``(keys, start_ts, end_ts, hours)``.

    Only the two ends of a run reach the series-wide window.
    """
    seen = obs.filter(F.col("val").isNotNull()).select(*keys, clock.hour_index(F.col("fecha")).alias("h")).distinct()
    d = windowed(seen, keys, "h", lambda w: {"_p": F.lag("h").over(w), "_n": F.lead("h").over(w)}, before=1, after=1)
    first = F.col("_p").isNull() | (F.col("_p") < F.col("h") - 1)
    last = F.col("_n").isNull() | (F.col("_n") > F.col("h") + 1)
    ends = d.select(*keys, "h", first.alias("_first"), last.alias("_last")).filter(F.col("_first") | F.col("_last"))
    w = Window.partitionBy(*keys).orderBy("h")
    runs = (ends.withColumn("_e", F.when(F.col("_last"), F.col("h")).otherwise(F.lead("h").over(w)))
            .filter("_first").withColumn("hours", F.col("_e") - F.col("h") + 1).filter(F.col("hours") >= min_hours))
    return runs.select(*keys, clock.hour_stamp(F.col("h")).alias("start_ts"), clock.hour_stamp(F.col("_e")).alias("end_ts"), "hours")


def _values(frame: Column, field: str) -> Column:
    """List of a field of the collected rows, nulls kept."""
    return F.transform(frame, lambda s: s[field])


def sample_windows(filled: DataFrame, prev: int = 24, next_weather: int = 2, steps: int = 8,
                   keys: Sequence[str] = SERIES) -> DataFrame:
    """Training samples per series: x = [i-prev, i), y and mask = [i, i+steps).

    Origins need ``prev <= i < n - next_weather - steps``, i.e. all of their hours inside the
    panel, which the block's own rows tell.
    """
    d = filled.withColumn("_m", F.when(F.col("flag") == "none", 0).otherwise(1))
    row = F.struct(F.col("val").alias("v"), F.col("_m").alias("m"))
    d = windowed(d, keys, "h", lambda w: {"_x": F.collect_list(row).over(w.rowsBetween(-prev, -1)),
                                          "_y": F.collect_list(row).over(w.rowsBetween(0, steps - 1)),
                                          "_last": F.lead("h", next_weather + steps).over(w)}, before=prev, after=next_weather + steps)
    return d.filter((F.size("_x") == prev) & F.col("_last").isNotNull()).select(
        *keys, "h", F.col("fecha").alias("origin"), _values(F.col("_x"), "v").alias("x"),
        _values(F.col("_y"), "v").alias("y"), _values(F.col("_y"), "m").alias("mask"))


def weather_windows(wx: DataFrame, prev: int = 4, next_weather: int = 2, steps: int = 8, keys: Sequence[str] = ("var",)) -> DataFrame:
    """Weather part of a sample: the hours [i-prev, i+next+steps) of every origin that has them all."""
    size = prev + next_weather + steps
    d = windowed(wx, keys, "h", lambda w: {"weather": F.collect_list("value").over(w.rangeBetween(-prev, size - prev - 1))},
                 before=prev, after=size)
    return d.filter(F.size("weather") == size).select(*keys, "h", "weather")


def weather_steps(windows: DataFrame, steps: int = 8, width: int = 7, keys: Sequence[str] = ("var",)) -> DataFrame:
    """The sub-window of ``width`` hours each forecast step sees."""
    parts = F.transform(F.sequence(F.lit(0), F.lit(steps - 1)), lambda k: F.slice("weather", k + 1, width))
    return windows.select(*keys, "h", F.posexplode(parts).alias("step", "window"))


def input_vectors(full: DataFrame, wx: DataFrame, prev: int = 24, prev_weather: int = 4, width: int = 7,
                  keys: Sequence[str] = SERIES) -> DataFrame:
    """Long dump of what the model sees per origin: ``(h, name, value)``.

    Per series the last value and mean, std, min, max of its window; every grid cell of the weather window.
    """
    def stats(w):
        f = w.rowsBetween(-prev, -1)
        return {"": F.last("val").over(f), "_mean": F.avg("val").over(f), "_std": F.stddev_samp("val").over(f),
                "_min": F.min("val").over(f), "_max": F.max("val").over(f)}

    d = windowed(full, keys, "h", lambda w: {f"s{k}": c for k, c in stats(w).items()}, before=prev)
    series = F.concat_ws("_", F.lit("pollution_cont"), *keys)
    pairs = F.array(*[F.struct(F.concat(series, F.lit(k)).alias("name"), F.col(f"s{k}").alias("value"))
                      for k in ("", "_mean", "_std", "_min", "_max")])
    poll = d.select("h", F.inline(pairs))
    cell = F.format_string("weather_%s_t%d_lat%.2f_lon%.2f", "var", "k", "lat", "lon")
    grid = (wx.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(width - 1))))
            .select((clock.hour_index(F.col("ts")) + prev_weather - F.col("k")).alias("h"), cell.alias("name"), "value"))
    return poll.unionByName(grid.join(full.select("h").distinct(), "h", "left_semi"))


def replicate_high(full: DataFrame, threshold: float, ahead: int = 24, factor: int = 1, keys: Sequence[str] = SERIES) -> DataFrame:
    """Rows that are high now or within ``ahead`` hours appear ``1 + factor`` times (column ``copy``)."""
    d = windowed(full, keys, "h", lambda w: {"_top": F.max("val").over(w.rowsBetween(0, ahead))}, after=ahead)
    n = F.when(F.col("_top") > threshold, 1 + factor).otherwise(1)
    return d.withColumn("copy", F.explode(F.sequence(F.lit(1), n))).drop("_top")
