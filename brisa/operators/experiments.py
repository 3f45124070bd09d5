"""Experiment grids: every combination of a few option lists, with derived sizes and names."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F


# Fixed value: how an experiment is named after its options.
NAME = "Parallel_%s_prev%d_heads%d_w%d_p%d_ar%d_bootstrap%s_thresh%s_weather%d_%d"


def param_grid(base: DataFrame, options: Mapping[str, Column]) -> DataFrame:
    """All combinations: each option list (an array column) is exploded in turn on ``base``."""
    d = base
    for name, values in options.items():
        d = d.withColumn(name, F.explode(values))
    return d


def derived(grid: DataFrame, stations: int = 30, time_columns: int = 12) -> DataFrame:
    """Input width, weather steps and the experiment name of each combination.

    Needs prev_pollutant_hours, pollutants (array), bootstrap_threshold, auto_regresive_steps,
    prev_weather_hours, next_weather_hours, attention_heads, weather_blocks, pollution_blocks.
    """
    p = F.col("pollutants")
    label = F.when(F.size(p) == 9, "all").otherwise(F.array_join(F.slice(p, 1, 3), "_"))
    name = F.format_string(
        NAME, label, "prev_pollutant_hours", "attention_heads",
        "weather_blocks", "pollution_blocks", "auto_regresive_steps", F.lit("True"), F.col("bootstrap_threshold").cast("string"),
        "prev_weather_hours", "next_weather_hours")
    return grid.withColumns({
        "input_features": F.lit(stations) + (F.size(p) - 1) * 3 + F.lit(time_columns),
        "weather_time_dims": F.col("prev_weather_hours") + F.col("next_weather_hours") + 1, "name": name})
