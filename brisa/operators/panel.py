"""Shaping of the long observation panel ``(fecha, pollutant, id_est, val)``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from brisa.functions import clock, names
from brisa.schema import AGGREGATE_STATIONS

SERIES = ["pollutant", "id_est"]
CALENDAR_BLOCK = 768     # hours of a series that one calendar row stands for before it is dealt out


def fetch(obs: DataFrame, pollutant: str | None, start, end, stations: Sequence[str] | None = None,
          drop_null: bool = False) -> DataFrame:
    """Rows with ``start <= fecha <= end``; all conditions reach the scan."""
    d = obs.filter(F.col("fecha").between(F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")))
    if pollutant:
        d = d.filter(F.col("pollutant") == pollutant)
    if stations:
        d = d.filter(F.col("id_est").isin(list(stations)))
    return d.filter(F.col("val").isNotNull()) if drop_null else d


def fetch_with_lookback(obs: DataFrame, start, end, lookback_hours: int) -> DataFrame:
    """Input range of an operator that looks back; filter its output to ``[start, end]`` again."""
    lo = clock.shift_hours(F.lit(start).cast("timestamp_ntz"), -lookback_hours)
    return obs.filter((F.col("fecha") >= lo) & (F.col("fecha") <= F.lit(end).cast("timestamp_ntz")))


def keep_pollutants(obs: DataFrame, codes: Sequence[str]) -> DataFrame:
    return obs.filter(F.col("pollutant").isin(list(codes)))


def filter_series(obs: DataFrame, mode: str = "none", pollutant: str | None = None, station: str | None = None,
                  hour_range: tuple[int, int] | None = None) -> DataFrame:
    """``none``, ``single_pollutant`` or ``single_pollutant_and_station``; optional local-hour range."""
    if mode not in ("none", "single_pollutant", "single_pollutant_and_station"):
        raise ValueError(f"unknown filter mode {mode!r}")
    d = obs
    if mode != "none":
        d = d.filter(F.col("pollutant") == pollutant)
    if mode == "single_pollutant_and_station":
        d = d.filter(F.col("id_est") == station)
    if hour_range:
        d = d.filter(F.hour("fecha").between(*hour_range))
    return d


def detect_groups(series: DataFrame, column: str = "series") -> DataFrame:
    """Distinct pollutant groups with their number of series, from series names."""
    s = series.filter(F.col(column).startswith("cont_"))
    return (s.groupBy(F.split(column, "_").getItem(1).alias("pollutant"))
            .agg(F.count_distinct(column).alias("n_series")))


def column_list(df: DataFrame) -> DataFrame:
    """Column names of a wide panel as a one-column table, in order."""
    return df.sparkSession.createDataFrame([(i, c) for i, c in enumerate(df.columns)], "pos int, name string")


def column_families(names_df: DataFrame) -> DataFrame:
    """Kind of every wide column ``name``: contaminant, flag, weather, meteo, time or other."""
    c = F.col("name")
    kind = (F.when(c.startswith("i_cont_"), "flag").when(c.startswith("cont_"), "contaminant")
            .when(c.rlike(r"_h\d+$"), "weather").when(c.startswith("met_"), "meteo")
            .when(c.rlike("(day|week|year)$"), "time").otherwise("other"))
    return names_df.withColumn("kind", kind)


def active_stations(stations: DataFrame, year: int) -> DataFrame:
    return stations.filter(F.col("lastyear") >= year).select("id", "nombre", "lastyear", "lat", "lon")


def station_names(df: DataFrame, column: str = "id_est") -> DataFrame:
    return df.withColumn("nombre", names.station_label(F.col(column)))


def bounds(df: DataFrame, ts: str = "fecha") -> tuple[Column, Column]:
    """First and last hour index of a table as fields of one scalar subquery, so the table is read once for both."""
    h = clock.hour_index(F.col(ts))
    both = df.select(F.struct(F.min(h).alias("lo"), F.max(h).alias("hi"))).scalar()
    return both["lo"], both["hi"]


def hour_calendar(series: DataFrame, keys: Sequence[str], lo: Column, hi: Column) -> DataFrame:
    """Every hour ``lo..hi`` of every series as ``(keys, h)``.

    A series first becomes one row per block of hours; the blocks are dealt over all partitions and
    only then become hours, so the calendar is made in parallel however few the series are.
    """
    n = int(series.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = series.select(*keys).distinct().select(*keys, F.explode(F.sequence(F.floor(lo / CALENDAR_BLOCK), F.floor(hi / CALENDAR_BLOCK))).alias("_block"))
    first = F.col("_block") * CALENDAR_BLOCK
    hours = F.sequence(F.greatest(lo, first), F.least(hi, first + CALENDAR_BLOCK - 1))
    return blocks.repartition(n, *keys, "_block").select(*keys, F.explode(hours).alias("h"))


def hourly(raw: DataFrame, keys: Sequence[str] = SERIES) -> DataFrame:
    """One row per series and hour from readings at any time: the mean, combined on the map side.

    Every ordered operator relies on this uniqueness to bound its window groups.
    """
    return raw.groupBy(*keys, clock.hour_stamp(clock.hour_index(F.col("fecha"))).alias("fecha")).agg(F.avg("val").alias("val"))


def fill_calendar(obs: DataFrame, keys: Sequence[str] = SERIES, start=None, end=None, fill: float | None = None,
                  cluster: Sequence[str] | None = None) -> DataFrame:
    """Missing hours become rows with a null (or ``fill``) value: ``(keys, h, fecha, val)``.

    ``cluster`` names join columns to partition both sides by, when the next step groups by them.
    """
    lo, hi = bounds(obs)
    if start is not None:
        lo = clock.hour_index(F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        hi = clock.hour_index(F.lit(end).cast("timestamp_ntz"))
    keyed = obs.select(*keys, clock.hour_index(F.col("fecha")).alias("h"), "val")
    cal = hour_calendar(obs, keys, lo, hi)
    if cluster:
        cal, keyed = cal.repartition(*cluster), keyed.repartition(*cluster)
    out = cal.join(keyed, [*keys, "h"], "left")
    if fill is not None:
        out = out.withColumn("val", F.coalesce("val", F.lit(fill)))
    return out.select(*keys, "h", clock.hour_stamp(F.col("h")).alias("fecha"), "val")


def conform(obs: DataFrame, expected: DataFrame, target, hours: int) -> DataFrame:
    """Exactly the expected series over every hour of ``[target - hours, target]``."""
    hi = clock.hour_index(F.lit(target).cast("timestamp_ntz"))
    cal = hour_calendar(expected, SERIES, hi - hours, hi)
    keyed = obs.select(*SERIES, clock.hour_index(F.col("fecha")).alias("h"), "val").filter(F.col("h").between(hi - hours, hi))
    return cal.join(keyed, [*SERIES, "h"], "left").select(clock.hour_stamp(F.col("h")).alias("fecha"), *SERIES, "val")


def pivot(obs: DataFrame, series: Sequence[tuple[str, str]], prefix: str = "cont") -> DataFrame:
    """Wide panel for export: one ``<prefix>_<pollutant>_<station>`` column per listed series."""
    cols = [F.expr(f"max(case when pollutant = '{p}' and id_est = '{s}' then val end) as `{prefix}_{p}_{s}`") for p, s in series]
    return obs.groupBy("fecha").agg(*cols)


def unpivot(wide: DataFrame, index: str = "fecha") -> DataFrame:
    """Long panel from ``cont_*`` columns; names are parsed, absent cells stay null."""
    cols = [c for c in wide.columns if c.startswith("cont_")]
    long = wide.unpivot([index], cols, "series", "val")
    val = F.when(~F.isnan("val"), F.col("val"))
    return long.select(index, names.series_pollutant(F.col("series")).alias("pollutant"),
                       names.series_station(F.col("series")).alias("id_est"), val.alias("val"))


def flag_to_mask(flag: Column) -> Column:
    """0 for an observed value, 1 for any filled or missing one."""
    return F.when(flag == "none", 0).otherwise(1)


def availability(obs: DataFrame) -> DataFrame:
    """Per pollutant: number of stations, whether several, whether aggregate columns exist."""
    is_agg = F.col("id_est").isin(AGGREGATE_STATIONS)
    return (obs.groupBy("pollutant")
            .agg(F.count_distinct(F.when(~is_agg, F.col("id_est"))).alias("n_stations"),
                 F.coalesce(F.max(is_agg.cast("int")), F.lit(0)).alias("has_aggregates"))
            .withColumn("multi_station", (F.col("n_stations") > 1).cast("int")))


def valid_origins(origins: DataFrame, obs: DataFrame, lookback: int = 60, min_hours: int = 15, first_year: int = 2020) -> DataFrame:
    """Origins from ``first_year`` on with at least ``min_hours`` observed hours in the look-back."""
    o = origins.filter(F.year("origin") >= first_year).select("origin", clock.hour_index(F.col("origin")).alias("oh"))
    need = o.select("origin", F.explode(F.sequence(F.col("oh") - lookback, F.col("oh") - 1)).alias("h"))
    seen = obs.filter(F.col("val").isNotNull()).select(clock.hour_index(F.col("fecha")).alias("h")).distinct()
    have = need.join(seen, "h").groupBy("origin").agg(F.count(F.lit(1)).alias("history_hours"))
    return have.filter(F.col("history_hours") >= min_hours)


def union_years(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def preview(df: DataFrame, order: Sequence[str], n: int = 3) -> DataFrame:
    return df.orderBy(*order).limit(n)
