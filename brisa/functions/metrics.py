"""Metric registry: name -> aggregate builder over (target, prediction) columns, or a plain function.

User metrics are added with :func:`register` or :func:`register_function`. A builder composes built-in
aggregates, so it is combined on the map side and no group is gathered in one task. A function of two
arrays that gives a value for each row is ranked by counts, whatever the size of a group. One that needs
all rows of a group at once runs as a grouped Arrow aggregate; groups over its bound are an error, not a guess.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F


@dataclass(frozen=True)
class Ranked:
    """The exact ``quantile``, between two values in proportion, of ``value(target, prediction)`` over a group's rows."""

    value: Callable[[Column, Column], Column]
    quantile: float


Metric = Callable[[Column, Column], Column]
_REGISTRY: dict[str, Metric | Ranked] = {}


def register(name: str, builder: Metric | Ranked | None = None):
    """Register a builder directly or as a decorator."""
    def add(fn: Metric | Ranked) -> Metric | Ranked:
        _REGISTRY[name] = fn
        return fn

    return add(builder) if builder is not None else add


MAX_ROWS = 2_000_000      # rows of a group that a function metric may gather in one task


def register_function(name: str, fn: Callable[[np.ndarray, np.ndarray], float | np.ndarray], max_rows: int = MAX_ROWS,
                      quantile: float | None = None) -> Metric | Ranked:
    """Register ``fn(target, prediction)``, any Python function of two arrays without nulls.

    With ``quantile`` (0 to 1, 0.5: median) it gives an array, one value for each row whatever the other
    rows are, and the metric is the exact quantile of a group's values; groups may be of any size.
    Without, it gives one float for all rows of a group. These reach one task, so ``max_rows`` bounds
    them: a group over it fails with its size instead of filling an executor's memory. A metric that sums
    up should be a builder.
    """
    if quantile is not None:
        if not 0 <= quantile <= 1:
            raise ValueError("quantile must be from 0 to 1")

        def values(t, p):
            out = np.asarray(fn(*(x.to_numpy(zero_copy_only=False).astype(float) for x in (t, p))), float)
            if out.shape != (len(t),):
                raise ValueError(f"metric {name}: {out.shape} values for {len(t)} rows")
            return pa.array(out)

        by_row = F.arrow_udf(values, "double", F.ArrowUDFType.SCALAR)
        return register(name, Ranked(lambda t, p: by_row(t.cast("double"), p.cast("double")), quantile))

    def aggregate(t, p):
        if len(t) > max_rows:
            raise ValueError(f"metric {name}: a group has {len(t)} rows, the bound is {max_rows}")
        t, p = t.to_numpy(zero_copy_only=False).astype(float), p.to_numpy(zero_copy_only=False).astype(float)
        both = ~(np.isnan(t) | np.isnan(p))
        return float(fn(t[both], p[both])) if both.any() else None

    grouped = F.arrow_udf(aggregate, "double", F.ArrowUDFType.GROUPED_AGG)
    return register(name, lambda t, p: grouped(t.cast("double"), p.cast("double")))


def get(name: str) -> Metric | Ranked:
    if name not in _REGISTRY:
        raise KeyError(f"unknown metric {name!r}; known: {sorted(_REGISTRY)}")
    return _REGISTRY[name]


def known() -> list[str]:
    return sorted(_REGISTRY)


register("mse", lambda t, p: F.avg((p - t) * (p - t)))
register("mae", lambda t, p: F.avg(F.abs(p - t)))
register("rmse", lambda t, p: F.sqrt(F.avg((p - t) * (p - t))))
register("r2", lambda t, p: 1 - F.try_divide(F.avg((p - t) * (p - t)), F.var_pop(t)))
register("explained_variance", lambda t, p: 1 - F.try_divide(F.var_samp(t - p), F.var_samp(t)))
register("mape", lambda t, p: F.avg(F.abs(p - t) / F.greatest(F.abs(t), F.lit(2.220446049250313e-16))))


def masked_mse(t: Column, p: Column, mask: Column) -> Column:
    """Metric form: both sides multiplied by the mask, divided by all elements."""
    return F.avg(F.pow(p * mask - t * mask, 2))


def masked_mse_loss(t: Column, p: Column, mask: Column) -> Column:
    """Loss form: filled values (mask 1) do not count."""
    return masked_mse(t, p, 1 - mask)


def masked_rmse(t: Column, p: Column, mask: Column) -> Column:
    return F.sqrt(masked_mse(t, p, mask))


def asymmetric_mse(t: Column, p: Column, mask: Column) -> Column:
    """Under-prediction weighs double; filled values weigh 0; divided by all elements."""
    w = F.when(p - t < 0, 2.0).otherwise(1.0)
    return F.avg(w * F.pow(p - t, 2) * (1 - mask))


def huber(t: Column, p: Column, delta: float = 1.0) -> Column:
    e = F.abs(p - t)
    return F.avg(F.when(e <= delta, e * e * 0.5).otherwise((e - delta / 2) * delta))


def weighted_mse(t: Column, p: Column, weight: Column) -> Column:
    return F.avg(weight * F.pow(p - t, 2))


def restricted_mse(t: Column, p: Column) -> Column:
    """Values scaled to 0..1 with -1 for a missing target; those add no error."""
    keep = F.ceil(t + 1e-5)
    return F.avg(F.pow(p * keep - t * keep, 2))


def dice(t: Column, p: Column, smooth: float = 1.0) -> Column:
    return (F.sum(t * p) * 2 + smooth) / (F.sum(t) + F.sum(p) + smooth)


def dice_clipped(t: Column, p: Column, smooth: float = 0.01) -> Column:
    return dice(t, F.least(p, F.lit(1.0)), smooth)


def lesion_terms(t: Column, p: Column, eps: float = 0.001) -> tuple[Column, Column]:
    """Labels 0/1/2: keep label 2 as truth, drop predictions where the label is 0."""
    half = t / 2.0
    return F.floor(half + eps), p * F.ceil(half - eps)


def dice_lesion(t: Column, p: Column, smooth: float = 1.0, clip: bool = False) -> Column:
    tt, pp = lesion_terms(t, p)
    return dice(tt, F.least(pp, F.lit(1.0)) if clip else pp, smooth)


def top_k_hit(scores: Column, label: Column, k: int = 1) -> Column:
    """1 when the label is among the k highest scores; equal scores favour the lower position."""
    s = F.element_at(scores, label + 1)
    better = F.size(F.filter(scores, lambda x, i: (x > s) | ((x == s) & (i < label))))
    return (better < k).cast("int")


def nll(log_probs: Column, label: Column) -> Column:
    return F.avg(-F.element_at(log_probs, label + 1))
