"""Joins on time and on names, all written as equi joins."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from brisa.functions import clock
from brisa.operators import panel
from brisa.session import settle


def intersect_times(a: DataFrame, b: DataFrame, ts: str = "ts") -> tuple[DataFrame, DataFrame]:
    """Both tables reduced to the stamps they share."""
    ta, tb = a.select(ts).distinct(), b.select(ts).distinct()
    return a.join(tb, ts, "left_semi"), b.join(ta, ts, "left_semi")


def outer_align(parts: dict[str, DataFrame], ts: str = "fecha", value: str = "val") -> DataFrame:
    """Full outer alignment of N separate tables on time: one tagged union and one aggregate, no join chain."""
    tagged = None
    for name, df in parts.items():
        t = df.select(ts, F.lit(name).alias("_s"), F.col(value).alias("_v"))
        tagged = t if tagged is None else tagged.unionByName(t)
    return align_long(tagged, list(parts), "_s", ts, "_v")


def align_long(df: DataFrame, series: Sequence[str], tag: str, ts: str = "fecha", value: str = "val") -> DataFrame:
    """The same from one long table with a ``tag`` column: one scan, one exchange."""
    return df.filter(F.col(tag).isin(list(series))).groupBy(ts).agg(*[F.max(F.when(F.col(tag) == n, F.col(value))).alias(n) for n in series])


def asof_nearest(hours: DataFrame, steps: DataFrame, keys: Sequence[str], tolerance: int | None = None,
                 block: int = 768) -> DataFrame:
    """For every ``(keys, h)`` the nearest step hour as ``step_h``; a tie takes the earlier step.

    Both sides are tagged and ordered inside (keys, time block); the last step before and
    the first after each block come from a table with one row per block.
    """
    h, is_step = F.col("h"), F.col("_s") == 1
    both = (hours.select(*keys, "h", F.lit(0).alias("_s"))
            .unionByName(steps.select(*keys, "h", F.lit(1).alias("_s")).distinct())
            .withColumn("_b", F.floor(h / block)))
    step_h = F.when(is_step, h)
    edges = both.groupBy(*keys, "_b").agg(F.min(step_h).alias("_mn"), F.max(step_h).alias("_mx"))
    over = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_b")
    edges = edges.select(*keys, "_b",
                         F.max("_mx").over(over.rowsBetween(Window.unboundedPreceding, -1)).alias("_pb"),
                         F.min("_mn").over(over.rowsBetween(1, Window.unboundedFollowing)).alias("_nb"))
    w = Window.partitionBy(*keys, "_b").orderBy("h")
    d = both.select(*keys, "h", "_s", "_b",
                    F.max(step_h).over(w.rangeBetween(Window.unboundedPreceding, 0)).alias("_pi"),
                    F.min(step_h).over(w.rangeBetween(0, Window.unboundedFollowing)).alias("_ni"))
    d = d.filter(F.col("_s") == 0).join(edges, [*keys, "_b"], "left")
    prev, nxt = F.coalesce("_pi", "_pb"), F.coalesce("_ni", "_nb")
    pick = F.when(nxt.isNull() | (h - prev <= nxt - h), prev).otherwise(nxt)
    if tolerance is not None:
        pick = F.when(F.abs(pick - h) <= tolerance, pick)
    return d.select(*keys, "h", pick.alias("step_h"))


def days_needed(forecast_hours: int, hours_per_file: int = 24) -> int:
    """Days of weather a forecast needs; rain needs one hour more."""
    return math.ceil((forecast_hours + 1) / hours_per_file)


def require_weather_days(obs: DataFrame, weather_days: DataFrame, days: int, ts: str = "fecha") -> DataFrame:
    """Observation hours whose day and the following ``days - 1`` days all have weather (column ``day``, day index)."""
    need = (obs.select(clock.day_index(F.col(ts)).alias("_d")).distinct()
            .withColumn("day", F.explode(F.sequence(F.col("_d"), F.col("_d") + days - 1))))
    short = need.join(weather_days.select("day").distinct(), "day", "left_anti").select("_d").distinct()
    return obs.withColumn("_d", clock.day_index(F.col(ts))).join(short, "_d", "left_anti").drop("_d")


def remaining_origins(origins: DataFrame, done: DataFrame) -> DataFrame:
    return origins.join(done.select("origin").distinct(), "origin", "left_anti")


def weather_leads(hours: DataFrame, wx: DataFrame, leads: int = 24, by: Sequence[str] = ("var",)) -> DataFrame:
    """Each observation hour with the next ``leads`` weather hours: ``(fecha, lead, *by, value)``.

    An hour whose required days are not all present gets zeros. The weather side is copied to
    the hours it serves and met by an equi join on the hour.
    """
    days = days_needed(leads)
    w = wx.select(clock.hour_index(F.col("ts")).alias("_wh"), *by, "value")
    have = w.select(F.floor(F.col("_wh") / 24).alias("day")).distinct()
    base = hours.select("fecha").distinct().withColumn("h", clock.hour_index(F.col("fecha")))
    ok = require_weather_days(base, have, days).select("h", F.lit(1).alias("_ok"))
    # every hour of every name comes from a calendar dealt out in blocks, so no row gathers the names
    lo, hi = panel.bounds(base)
    grid = (panel.hour_calendar(w, by, lo, hi).join(base.join(ok, "h", "left"), "h")
            .withColumn("lead", F.explode(F.sequence(F.lit(0), F.lit(leads - 1)))).withColumn("_wh", F.col("h") + F.col("lead")))
    val = F.when(F.col("_ok") == 1, F.coalesce("value", F.lit(0.0))).otherwise(F.lit(0.0))
    return grid.join(w, ["_wh", *by], "left").select("fecha", "lead", *by, val.alias("value"))


def required_days(targets: DataFrame, prev_hours: int = 4, next_hours: int = 2, steps: int = 24, extra_days: int = 1,
                  ts: str = "target_ts") -> DataFrame:
    """Weather days each local target hour needs: half of them before, none dropped."""
    window = prev_hours + next_hours + steps + 1
    total = math.ceil(window / 24) + extra_days + 2
    before = total // 2
    utc = clock.to_utc(F.col(ts))
    offset = F.explode(F.sequence(F.lit(-before), F.lit(total - before - 1))).alias("offset")
    d = targets.select(ts, utc.alias("target_utc"), offset)
    day = clock.day_index(F.col("target_utc")) + F.col("offset")
    return d.select(ts, F.timestamp_seconds(day * 86400).cast("timestamp_ntz").alias("day_utc"),
                    F.when(F.col("offset") < 0, "historical").otherwise("forecast").alias("purpose"))


GRAM = 3         # letters of a gram; a shorter name is a gram of its own


def _grams(name: str, size: int) -> Column:
    """Distinct substrings of ``size`` letters of a name at least that long."""
    at = F.sequence(F.lit(1), F.length(name) - size + 1)
    return F.when(F.length(name) >= size, F.array_distinct(F.transform(at, lambda i: F.substring(F.col(name), i, F.lit(size)))))


def contained(needles: DataFrame, haystacks: DataFrame, needle: str, haystack: str, size: int = GRAM) -> DataFrame:
    """(needle, haystack) of all names that stand inside another: an inverted index of grams.

    Each needle is posted under one gram only, the one that the fewest haystacks have, and met by the
    haystacks that have it; then the whole needle is looked for. A needle with a gram that no haystack
    has is left out before the join. A needle that stands in every haystack meets them by its rarest
    gram, a join whose skewed side Spark splits. Empty names stand in all and are not looked for here.
    """
    n = needles.select(needle).filter(F.length(needle) > 0).distinct()
    found = None
    for k in range(1, size + 1):
        mine = n.filter(F.length(needle) >= size) if k == size else n.filter(F.length(needle) == k)
        own = mine.select(needle, F.explode(_grams(needle, k)).alias("_g"))
        grams = haystacks.select(haystack).distinct().select(haystack, F.explode(_grams(haystack, k)).alias("_g"))
        counts = grams.join(own.select("_g").distinct(), "_g", "left_semi").groupBy("_g").agg(F.count(F.lit(1)).alias("_f"))
        rarest = own.join(counts, "_g", "left").groupBy(needle).agg(F.min(F.coalesce("_f", F.lit(0))).alias("_least"), F.min_by("_g", F.struct("_f", "_g")).alias("_g"))
        posted = settle(rarest.filter(F.col("_least") > 0).select(needle, "_g"), "rarest-grams")
        hit = grams.join(posted, "_g").filter(F.contains(F.col(haystack), F.col(needle))).select(needle, haystack)
        found = hit if found is None else found.unionByName(hit)
    return found


def match_configs(models: DataFrame, configs: DataFrame) -> DataFrame:
    """Config of each model: same name first, else the first config (by ``ord``) where one name holds the other.

    An empty name holds nothing but is held by all: an empty config is the first of those with its
    ``ord``, and an empty model takes the first config there is.
    """
    m, c = models.select("model").distinct(), configs.select("config", "ord").distinct()
    inside = contained(c, m, "config", "model")
    outside = contained(m, c, "model", "config").select("config", "model")
    hits = inside.unionByName(outside).distinct().join(c, "config").select("model", "config", "ord")
    none = m.withColumns({"ord": c.filter(F.col("config") == "").select(F.min("ord")).scalar(), "config": F.lit("")}).filter(F.col("ord").isNotNull())
    any_ = m.filter(F.col("model") == "").select("model", c.select(F.min_by("config", "ord")).scalar().alias("config"), c.select(F.min("ord")).scalar().alias("ord"))
    rank = F.struct(F.when(F.col("model") == F.col("config"), 0).otherwise(1), F.col("ord"))
    best = hits.unionByName(none.select(hits.columns)).unionByName(any_).groupBy("model").agg(F.min_by("config", rank).alias("config"))
    return m.join(best, "model", "left")


def pair_files(weather: DataFrame, pollution: DataFrame) -> DataFrame:
    """Weather and pollution snapshots of the same year range in their names."""
    def rng(c: str, kind: str) -> Column:
        return F.regexp_extract(c, rf"{kind}_data_(\d{{4}}_to_\d{{4}})", 1)

    a = weather.select(F.col("path").alias("weather_path"), rng("path", "weather").alias("years"))
    b = pollution.select(F.col("path").alias("pollution_path"), rng("path", "pollution").alias("years"))
    return a.filter(F.col("years") != "").join(b, "years")


def project_params(columns: DataFrame, params: DataFrame, column: str = "column") -> DataFrame:
    """Scaler parameters of shifted columns such as ``plus_05_cont_otres_X``."""
    from brisa.functions.names import strip_lead
    return columns.withColumn("name", strip_lead(F.col(column))).join(params, "name")
