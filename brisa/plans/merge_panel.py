"""Training table: stations side by side, weather leads and time columns per hour."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from brisa.functions import clock
from brisa.operators import align, panel
from brisa.operators.blocks import windowed


def merge_panel(obs: DataFrame, wx: DataFrame, series: Sequence[tuple[str, str]], variables: Sequence[str], leads: int = 24,
                flip_order: bool = False) -> DataFrame:
    """Wide edge table of hours whose weather days exist: cont_*, ``{var}_h{k}`` and time columns.

    ``wx`` is ``(ts, var, value)`` with one value per variable (or quadrant) and hour. The
    weather of an hour is one row, its following hours one bounded frame.
    """
    days = wx.select(clock.day_index(F.col("ts")).alias("day")).distinct()
    kept = align.require_weather_days(obs, days, align.days_needed(leads))
    wide = panel.pivot(kept, series)
    hourly = (wx.filter(F.col("var").isin(list(variables))).groupBy(clock.hour_index(F.col("ts")).alias("h"))
              .agg(*[F.max(F.when(F.col("var") == v, F.col("value"))).alias(v) for v in variables]))
    cells = F.struct("h", F.struct(*variables).alias("v"))
    # an observation hour just before the weather still sees its later leads
    hours = (hourly.join(wide.select(clock.hour_index(F.col("fecha")).alias("h")), "h", "full_outer"))
    ahead = windowed(hours, [], "h", lambda w: {"_ahead": F.map_from_entries(F.collect_list(cells).over(w.rangeBetween(0, leads - 1)))}, after=leads)
    d = wide.withColumn("h", clock.hour_index(F.col("fecha"))).join(ahead.select("h", "_ahead"), "h")
    lead_cols = [F.expr(f"coalesce(try_element_at(_ahead, h + {k}).`{v}`, 0.0D) as `{v}_h{k}`") for k in range(leads) for v in variables]
    return d.select(*wide.columns, *lead_cols, *[c.alias(n) for n, c in clock.time_features(F.col("fecha"), flip_order).items()])
