"""Autoregressive roll-forward over many origins and the tables around a forecast sweep."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from brisa.functions import clock

ModelFn = Callable[..., np.ndarray]


def linear_model(a: float = 0.6, b: float = 0.3, c: float = 4.0) -> ModelFn:
    """next = a * last + b * oldest + c; stands in for any model of the same signature."""
    def step(window: np.ndarray, weather: np.ndarray | None, k: int, hours: np.ndarray) -> np.ndarray:
        return a * window[:, -1] + b * window[:, 0] + c

    return step


def roll_forward(samples: DataFrame, model: ModelFn, steps: int = 24, n_series: int = 1,
                 keys: Sequence[str] = ("pollutant", "id_est"), weather: str | None = None, width: int = 7) -> DataFrame:
    """Long forecasts ``(keys, h, horizon, series_idx, value)``.

    One row per origin with its window in ``x`` (oldest hour first, series inside the hour), so
    origins need no shuffle: a task takes an Arrow batch of origins and advances all of them
    together, step by step. ``model(window, weather, step, hours)`` gets arrays of shape
    [batch, hours, series] (or [batch, hours] for one series) and returns the next hour.
    """
    key_types = {f.name: f.dataType.simpleString() for f in samples.schema.fields}
    cols = [*keys, "h"]
    schema = ", ".join([f"{c} {key_types[c]}" for c in cols] + ["horizon int", "series_idx int", "value double"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if pdf.empty:
                continue
            x = np.stack([np.asarray(v, dtype=float) for v in pdf["x"]])
            x = x if n_series == 1 else x.reshape(len(pdf), -1, n_series)
            wx = None if weather is None else np.stack([np.asarray(v, dtype=float) for v in pdf[weather]])
            hours = pdf["h"].to_numpy()
            outs = []
            for k in range(steps):
                y = np.asarray(model(x, None if wx is None else wx[:, k:k + width], k, hours + k), dtype=float)
                outs.append(y.reshape(len(pdf), n_series))
                x = np.concatenate([x[:, 1:], y.reshape((len(pdf), 1) + x.shape[2:])], axis=1)
            cube = np.stack(outs, axis=1)
            rep = steps * n_series
            out = {c: np.repeat(pdf[c].to_numpy(), rep) for c in cols}
            out["horizon"] = np.tile(np.repeat(np.arange(1, steps + 1), n_series), len(pdf)).astype("int32")
            out["series_idx"] = np.tile(np.arange(n_series), len(pdf) * steps).astype("int32")
            out["value"] = cube.reshape(-1)
            yield pd.DataFrame(out)

    need = [*cols, "x", *([weather] if weather else [])]
    return samples.select(*need).mapInPandas(run, schema)


def origins_at(obs: DataFrame, freq: str = "D", start=None, end=None) -> DataFrame:
    """Origins at frequency ``D``, ``6H`` or ``H`` over the observed range: ``(origin, h)``."""
    step = {"D": 24, "6H": 6, "H": 1}[freq]
    h = clock.hour_index(F.col("fecha"))
    lo = obs.select(F.min(h)).scalar() if start is None else clock.hour_index(F.lit(start).cast("timestamp_ntz"))
    hi = obs.select(F.max(h)).scalar() if end is None else clock.hour_index(F.lit(end).cast("timestamp_ntz"))
    first = F.ceil(lo / step) * step
    one = obs.sparkSession.range(1).select(F.explode(F.sequence(first, hi, F.lit(step))).alias("h"))
    return one.select(clock.hour_stamp(F.col("h")).alias("origin"), "h")


def wide_forecast(fc: DataFrame, series: Sequence[str], horizons: Sequence[int] = range(1, 25), name: str = "series",
                  drop_null_rows: bool = True) -> DataFrame:
    """One row per origin, one ``<series>_h_plus_HH`` column per listed series and horizon.

    A failed origin has only nulls and is dropped on request.
    """
    cols = [f"{s}_h_plus_{h:02d}" for s in series for h in horizons]
    d = fc.filter(F.col("value").isNotNull()) if drop_null_rows else fc
    key = F.format_string("%s_h_plus_%02d", name, "horizon")
    return d.withColumn("_c", key).groupBy("origin").pivot("_c", cols).agg(F.max("value"))


# Error texts and their categories; anything else is "otros_errores".
ERROR_CATEGORIES = [("no hay suficientes datos", "datos_insuficientes"), ("not in index", "datos_faltantes"), ("wrf", "errores_wrf")]


def error_category(message: Column) -> Column:
    low = F.lower(message)
    out = None
    for text, cat in ERROR_CATEGORIES:
        out = F.when(low.contains(text), cat) if out is None else out.when(low.contains(text), cat)
    return out.otherwise("otros_errores")
