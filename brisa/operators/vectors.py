"""Hour vectors: one dense vector per hour, windows of hours x columns, and roll-forward by named positions.

The vector's columns are those of :func:`brisa.operators.prep.model_columns`: kept stations, time, then
statistics of the other pollutants. A model predicts the *target* columns (all but the time ones) of the
next hour; predictions and that hour's own time features are written into their positions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from brisa.functions import clock
from brisa.operators.blocks import windowed

MatrixModel = Callable[[np.ndarray, np.ndarray, int, np.ndarray], np.ndarray]
BATCH = 512      # origins a task advances together


def time_positions(columns: Sequence[str]) -> list[int]:
    return [list(columns).index(n) for n in clock.time_names()]


def target_positions(columns: Sequence[str]) -> list[int]:
    """Positions of everything but the time columns."""
    time = set(time_positions(columns))
    return [i for i in range(len(columns)) if i not in time]


def _picked(vector: Column, positions: Sequence[int]) -> Column:
    return F.array(*[F.get(vector, F.lit(p)) for p in positions])


def sample_matrix(vectors: DataFrame, columns: Sequence[str], prev: int = 24, next_weather: int = 2, steps: int = 8,
                  transform: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """(h, x, y, y_mask): x holds the vectors of [h - prev, h), y and y_mask the targets of [h, h + steps).

    ``vectors`` has one row per hour ``h`` with ``vector`` and ``mask``, the imputation mask of the target
    columns. An hour is an origin only if all of its hours, and ``next_weather`` more, are there without
    a gap. Windows run on bounded blocks of hours. ``transform`` is applied to the samples: a function
    of a table of samples that keeps these columns.
    """
    targets = target_positions(columns)
    ahead = F.struct(_picked(F.col("vector"), targets).alias("v"), F.col("mask").alias("m"))
    d = windowed(vectors, [], "h", lambda w: {"x": F.collect_list("vector").over(w.rangeBetween(-prev, -1)), "_y": F.collect_list(ahead).over(w.rangeBetween(0, steps + next_weather))},
                 before=prev, after=steps + next_weather)
    full = d.filter((F.size("x") == prev) & (F.size("_y") == steps + next_weather + 1)).withColumn("_y", F.slice("_y", 1, steps))
    samples = full.select("h", "x", F.col("_y.v").alias("y"), F.col("_y.m").alias("y_mask"))
    return samples.transform(transform) if transform else samples


def look_back(origins: DataFrame, vectors: DataFrame, first: int, last: int, column: str = "vector", name: str = "x") -> DataFrame:
    """(h, name): the vectors of the hours h + first .. h + last of each origin, in order of time.

    Origins ask for their hours and meet the one table of vectors by an equi join, so overlapping windows
    share it; a group is one origin's window.
    """
    need = origins.select("h", F.explode(F.sequence(F.col("h") + first, F.col("h") + last)).alias("_at"))
    met = need.join(vectors.select(F.col("h").alias("_at"), F.col(column).alias("_v")), "_at")
    return met.groupBy("h").agg(F.array_sort(F.collect_list(F.struct("_at", "_v"))).alias("_w")).select("h", F.col("_w._v").alias(name))


def roll_positions(samples: DataFrame, model: MatrixModel, columns: Sequence[str], steps: int = 24, width: int = 7, flip_order: bool = False) -> DataFrame:
    """(h, horizon, position, value, error): every origin rolled ``steps`` hours ahead.

    ``samples``: (h, x, weather, error), hours x columns and hours x weather columns; a row whose error is
    set is not given to the model. ``model(window, weather, step, hours)`` gets [batch, hours, columns] and
    the ``width`` weather hours of the step, and returns [batch, targets]. ``position`` numbers the targets.
    A model that fails on a batch is run origin by origin, so only the origins it fails on are lost: they
    keep their rows with null values and the message in ``error``.
    """
    targets, time = np.array(target_positions(columns)), np.array(time_positions(columns))
    n_columns, batch = len(columns), BATCH
    periods = [clock.CYCLES[n] for n in (["day", "year", "week"] if flip_order else ["day", "week", "year"])]

    def time_row(hours: np.ndarray) -> np.ndarray:
        t = hours.astype(np.float64) * 3600.0
        half = [np.abs(f(t * (np.pi / p))) for p in periods for f in (np.sin, np.cos)]
        return np.stack(half + [f(t * (2 * np.pi / p)) for p in periods for f in (np.sin, np.cos)], 1)

    def advance(x: np.ndarray, weather: np.ndarray, hours: np.ndarray) -> np.ndarray:
        outs = []
        for k in range(steps):
            y = np.asarray(model(x, weather[:, k:k + width], k, hours + k), dtype=np.float64)
            if y.shape != (len(hours), len(targets)):
                raise ValueError(f"the model gave {y.shape} for {(len(hours), len(targets))}")
            outs.append(y)
            row = np.zeros((len(hours), 1, n_columns))
            row[:, 0, targets], row[:, 0, time] = y, time_row(hours + k)
            x = np.concatenate([x[:, 1:], row], axis=1)
        return np.stack(outs, axis=1)

    def safely(x: np.ndarray, weather: np.ndarray, hours: np.ndarray) -> tuple[np.ndarray, list[str | None]]:
        try:
            return advance(x, weather, hours), [None] * len(hours)
        except Exception as e:
            if len(hours) == 1:
                return np.full((1, steps, len(targets)), np.nan), [f"{type(e).__name__}: {e}"[:200]]
        parts = [safely(x[i:i + 1], weather[i:i + 1], hours[i:i + 1]) for i in range(len(hours))]
        return np.concatenate([p for p, _ in parts]), [m for _, ms in parts for m in ms]

    def matrices(col: pa.Array, n: int) -> np.ndarray:
        flat = col.flatten().flatten().to_numpy(zero_copy_only=False)
        return flat.astype(np.float64).reshape(n, len(col.flatten()) // n, -1)

    def rows(hours: np.ndarray, cube: np.ndarray, errors: list[str | None]) -> pa.RecordBatch:
        each = steps * len(targets)
        value = pa.array(cube.ravel(), mask=np.repeat(np.array([m is not None for m in errors], bool), each))
        said = pa.array(errors, pa.string()).take(pa.array(np.repeat(np.arange(len(hours)), each)))
        return pa.RecordBatch.from_arrays([pa.array(np.repeat(hours, each)), pa.array(np.tile(np.repeat(np.arange(1, steps + 1, dtype=np.int32), len(targets)), len(hours))),
                                           pa.array(np.tile(np.arange(len(targets), dtype=np.int32), len(hours) * steps)), value, said], ["h", "horizon", "position", "value", "error"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, batch):
                b = whole.slice(a, batch)
                bad = np.array([m is not None for m in b.column("error").to_pylist()], bool)
                for some, failed in ((b.filter(pa.array(~bad)), False), (b.filter(pa.array(bad)), True)):
                    n = some.num_rows
                    if not n:
                        continue
                    hours = some.column("h").to_numpy()
                    if failed:
                        yield rows(hours, np.full((n, steps, len(targets)), np.nan), some.column("error").to_pylist())
                    else:
                        yield rows(hours, *safely(matrices(some.column("x"), n), matrices(some.column("weather"), n), hours))

    return samples.select("h", "x", "weather", "error").mapInArrow(run, "h bigint, horizon int, position int, value double, error string")


def column_model(columns: Sequence[str], last: float = 0.5, oldest: float = 0.2, mean: float = 0.1, day: float = 0.3, weather: float = 0.2, shift: float = -0.05) -> MatrixModel:
    """A linear model over several columns and weather; stands in for any model of the same signature.

    Each target is ``last`` times its last value, ``oldest`` times its first one, ``mean`` times the mean of
    all targets in the last hour, ``day`` times the last hour's sine of the day, ``weather`` times the mean
    of the first weather column over the step's window, and ``shift``.
    """
    targets, sine = np.array(target_positions(columns)), list(columns).index("sin_day")

    def step(x: np.ndarray, w: np.ndarray, k: int, hours: np.ndarray) -> np.ndarray:
        now = x[:, -1][:, targets]
        common = mean * now.mean(1) + day * x[:, -1, sine] + weather * w[:, :, 0].mean(1) + shift
        return last * now + oldest * x[:, 0][:, targets] + common[:, None]

    return step
