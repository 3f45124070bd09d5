"""Operational forecast as one plan for many origins: observations and weather to delivery rows.

All origins share one gap-filled, normalised panel of hours; each asks for its look-back and its weather
window by equi joins. What makes an origin fail is found as a column of its row, so a sweep keeps failed
origins with their reason.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from brisa.functions import clock
from brisa.operators import align, forecast, impute, panel, prep, stats, vectors
from brisa.session import settle
from brisa.sources import sinks


@dataclass(frozen=True)
class Setup:
    """What the model sees: series, window lengths in hours, weather variables."""

    stations: Sequence[str]
    others: Sequence[str]
    weather: Sequence[str]
    keep: str = "otres"
    prev: int = 24
    prev_weather: int = 4
    next_weather: int = 2
    steps: int = 24
    hours_back: int = 60
    min_hours: int = 15
    tolerance: int = 3
    history_years: int = 5
    need_columns: bool = True     # whether a column without a reading in the look-back fails the origin
    columns: list[str] = field(init=False)

    def __post_init__(self):
        object.__setattr__(self, "columns", prep.model_columns(self.stations, self.others, self.keep))

    @property
    def width(self) -> int:
        return self.prev_weather + self.next_weather + 1

    def series(self, spark) -> DataFrame:
        rows = [(p, s) for p in (self.keep, *self.others) for s in self.stations]
        return spark.createDataFrame(rows, "pollutant string, id_est string")

    def targets(self, spark) -> DataFrame:
        """(position, pollutant, id_est) of the model's outputs; statistics have theirs in id_est."""
        names = [(self.keep, s) for s in self.stations] + [(p, a) for p in self.others for a in ("mean", "min", "max")]
        return spark.createDataFrame([(i, p, s) for i, (p, s) in enumerate(names)], "position int, pollutant string, id_est string")


def source_hours(obs: DataFrame, origins: DataFrame, setup: Setup) -> DataFrame:
    """The one read of the observations: hourly cleaned readings of the listed series, as far back as history reaches, settled."""
    lo, hi = panel.bounds(origins, "origin")
    h = clock.hour_index(F.col("fecha"))
    listed = F.col("pollutant").isin([setup.keep, *setup.others]) & F.col("id_est").isin(list(setup.stations))
    d = obs.filter(listed & (h >= lo - setup.hours_back - (setup.history_years * 366 + 1) * 24) & (h <= hi))
    hourly = panel.hourly(d).select(*panel.SERIES, "fecha", clock.hour_index(F.col("fecha")).alias("h"), "val")
    return settle(impute.apply_quality(hourly), "operational-hours")


def filled_panel(hours: DataFrame, origins: DataFrame, setup: Setup) -> DataFrame:
    """Every listed series over the union of all look-backs, gaps filled the operational way: (series, h, fecha, val, flag)."""
    lo, hi = panel.bounds(origins, "origin")
    lo = lo - setup.hours_back
    cal = panel.hour_calendar(setup.series(hours.sparkSession), panel.SERIES, lo, hi - 1)
    by = ["pollutant", "h"]
    full = cal.repartition(*by).join(hours.select(*panel.SERIES, "h", "val").repartition(*by), [*panel.SERIES, "h"], "left").withColumn("fecha", clock.hour_stamp(F.col("h")))
    d = impute.fill_row_average_trimmed_here(impute.start_flags(full))
    d = settle(impute.fill_persistence_day(d), "operational-panel")
    return impute.fill_history(d, hours, setup.history_years)


def hour_vectors(filled: DataFrame, params: DataFrame, setup: Setup) -> DataFrame:
    """(h, vector, mask): normalised panel as one model vector per hour, with the mask of the target columns."""
    z = stats.zscore(filled, params.filter(F.col("kind") == "pollutant"))
    long = stats.station_stats(z.select("fecha", "pollutant", "id_est", F.col("z").alias("val")), setup.keep)
    own = filled.filter(F.col("pollutant") == setup.keep).select("fecha", "pollutant", "id_est", panel.flag_to_mask(F.col("flag")).alias("m"))
    rest = stats.mask_stats(filled, setup.keep).select("fecha", "pollutant", F.explode(F.map_from_arrays(F.array(F.lit("mean"), F.lit("min"), F.lit("max")), F.array("mask_mean", "mask_min", "mask_max"))).alias("id_est", "m"))
    names = [(setup.keep, s) for s in setup.stations] + [(p, a) for p in setup.others for a in ("mean", "min", "max")]
    masks = own.unionByName(rest).groupBy("fecha").agg(F.array(*[F.max(F.when((F.col("pollutant") == p) & (F.col("id_est") == s), F.col("m"))) for p, s in names]).alias("mask"))
    vec = prep.model_vector(long, setup.stations, setup.others, setup.keep)
    return vec.join(masks, "fecha").select(clock.hour_index(F.col("fecha")).alias("h"), "vector", "mask")


def weather_vectors(wx: DataFrame, params: DataFrame, setup: Setup) -> DataFrame:
    """(h, vector): normalised domain means of the listed variables per weather step; nulls become 0."""
    means = wx.filter(F.col("var").isin(list(setup.weather))).groupBy(clock.hour_index(F.col("ts")).alias("h"), "var").agg(F.avg("value").alias("value"))
    z = stats.zscore(means, params.filter(F.col("kind") == "weather"), "var", "value")
    return z.groupBy("h").agg(F.array(*[F.coalesce(F.max(F.when(F.col("var") == x, F.col("z"))), F.lit(0.0)) for x in setup.weather]).alias("vector"))


def origin_faults(origins: DataFrame, hours: DataFrame, setup: Setup) -> DataFrame:
    """(h, n_hours, absent): hours with a reading in each origin's look-back, and model columns without any."""
    seen = hours.filter(F.col("val").isNotNull())
    need = origins.select("h", F.explode(F.sequence(F.col("h") - setup.hours_back, F.col("h") - 1)).alias("_at"))
    # a listed series of the kept pollutant is a column of its own, the others are one column group each
    column = F.when(F.col("pollutant") == setup.keep, F.concat_ws("_", "pollutant", "id_est")).otherwise(F.col("pollutant"))
    per_hour = seen.select(F.col("h").alias("_at"), column.alias("_c")).distinct().groupBy("_at").agg(F.collect_set("_c").alias("_cs"))
    met = need.join(per_hour, "_at", "left").groupBy("h").agg(F.count("_cs").alias("n_hours"), F.size(F.array_distinct(F.flatten(F.collect_list("_cs")))).alias("_seen"))
    return met.select("h", "n_hours", (F.lit(len(setup.stations) + len(setup.others)) - F.col("_seen")).alias("absent"))


def model_inputs(obs: DataFrame, wx: DataFrame, origins: DataFrame, params: DataFrame, setup: Setup) -> DataFrame:
    """(h, x, weather, error), one row per origin; ``origins`` has ``origin`` (a full hour), ``params`` kind, name, mean, std.

    ``error`` says why an origin cannot be forecast: too few observed hours, columns without a reading in
    the look-back, or weather hours without a step within the tolerance. Observations and weather are
    read once each.
    """
    origins = settle(origins.select("origin", clock.hour_index(F.col("origin")).alias("h")).distinct(), "origins")
    hours = source_hours(obs, origins, setup)
    x = vectors.look_back(origins, hour_vectors(filled_panel(hours, origins, setup), params, setup), -setup.prev, -1)
    steps = settle(weather_vectors(wx, params, setup), "weather-steps")
    last = setup.next_weather + setup.steps - 1
    need = origins.select(F.explode(F.sequence(F.col("h") - setup.prev_weather, F.col("h") + last)).alias("h")).distinct()
    nearest = align.asof_nearest(need, steps, [], setup.tolerance).filter(F.col("step_h").isNotNull())
    hourly = nearest.join(steps.select(F.col("h").alias("step_h"), "vector"), "step_h").select("h", "vector")
    weather = vectors.look_back(origins, hourly, -setup.prev_weather, last, name="weather")
    d = origins.select("h").join(origin_faults(origins, hours, setup), "h", "left").join(x, "h", "left").join(weather, "h", "left")
    missing = F.lit(setup.prev_weather + last + 1) - F.coalesce(F.size("weather"), F.lit(0))
    size = F.coalesce(F.size("x"), F.lit(0))
    short = (F.col("n_hours") < setup.min_hours) | (size < setup.prev)
    absent = (F.col("absent") > 0) & F.lit(setup.need_columns)
    error = (F.when(short, F.format_string("no hay suficientes datos: %d", "n_hours")).when(absent, F.format_string("%d columns not in index", "absent"))
             .when(missing > 0, F.format_string("wrf: %d hours without weather", missing)))
    return d.select("h", "x", "weather", error.alias("error"))


def run_forecast(inputs: DataFrame, model: vectors.MatrixModel, params: DataFrame, setup: Setup) -> DataFrame:
    """(origin, horizon, pollutant, id_est, value, error) in the pollutants' own units."""
    rolled = vectors.roll_positions(inputs, model, setup.columns, setup.steps, setup.width)
    named = rolled.join(setup.targets(inputs.sparkSession), "position")
    units = stats.denormalize(named, params.filter(F.col("kind") == "pollutant"), "pollutant", "value", "value")
    return units.select(clock.hour_stamp(F.col("h")).alias("origin"), "horizon", "pollutant", "id_est", "value", "error")


def delivery_rows(fc: DataFrame, setup: Setup) -> DataFrame:
    """Delivery rows of the stations and of the statistics of the other pollutants, failed origins left out."""
    good = fc.filter(F.col("error").isNull())
    own = sinks.deliver_stations(good, setup.stations, setup.keep).withColumn("table", F.lit(f"forecast_{setup.keep}"))
    return own.unionByName(sinks.deliver_stats(good.filter(F.col("pollutant") != setup.keep)).drop("stat", "pollutant"), allowMissingColumns=True)


def sweep_status(fc: DataFrame) -> DataFrame:
    """(origin, category, n_values): ``ok`` or the error category of each origin, failed ones kept."""
    category = F.coalesce(F.max(F.when(F.col("error").isNotNull(), forecast.error_category(F.col("error")))), F.lit("ok"))
    return fc.groupBy("origin").agg(category.alias("category"), F.count("value").alias("n_values"))


def sweep_report(status: DataFrame) -> DataFrame:
    """(category, n_origins, first_origin, last_origin, n_values, share) of a sweep; share is of all origins."""
    per = status.groupBy("category").agg(F.count(F.lit(1)).alias("n_origins"), F.min("origin").alias("first_origin"), F.max("origin").alias("last_origin"), F.sum("n_values").alias("n_values"))
    return per.withColumn("share", F.col("n_origins") / status.select(F.count(F.lit(1))).scalar())

