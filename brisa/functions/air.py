"""Air-quality indices and weather formulas as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Index breakpoints as (upper bound, multiplier, add, subtract); None = no bound.
IMECA = {
    "O3": [(0.070, 714.29, 0, 0), (0.095, 2041.67, 51, 0.071), (0.154, 844.83, 101, 0.096),
           (0.204, 1000, 151, 0.155), (0.404, 497.49, 201, 0.205), (None, 1000, -104, 0)],
    "SO2": [(None, 100 / 0.13, 0, 0)],
    "NO2": [(None, 100 / 0.21, 0, 0)],
    "CO": [(None, 100 / 11, 0, 0)],
    "PM10": [(40, 1.25, 0, 0), (75, 1.4412, 51, 41), (214, 0.3551, 101, 76),
             (354, 0.3525, 151, 215), (424, 1.4348, 201, 355), (None, 1, -104, 0)],
    "PM2.5": [(12, 4.1667, 0, 0), (45, 1.4894, 51, 12.1), (97.4, 0.9369, 101, 45.1),
              (150.4, 0.9263, 151, 97.5), (250.4, 0.991, 201, 150.5), (None, 0.6604, 401, 350.5)],
}
# Category names and limits.
IMECA_CATEGORIES = [(51, "Buena"), (101, "Regular"), (151, "Mala"), (201, "Muy Mala"), (None, "Extremadamente Mala")]
NOM_NAMES = ["Buena", "Aceptable", "Mala", "Muy Mala", "Extremadamente Mala"]
NOM_LIMITS = {"PM10": [45, 60, 132, 213], "PM2.5": [15, 33, 79, 130], "O3": [0.058, 0.090, 0.135, 0.175]}
NOWCAST_FACTOR = {"PM10": 0.714, "PM2.5": 0.694}
# Highest plausible reading per code, and for every other code.
QUALITY_LIMITS = {"pmdiez": 1000.0, "pmdoscinco": 500.0, "otres": 500.0}
QUALITY_DEFAULT = 1000.0


def _ladder(value: Column, steps: Sequence[tuple], make, strict: bool) -> Column:
    out = None
    for step in steps:
        bound, res = step[0], make(step)
        if bound is None:
            return res if out is None else out.otherwise(res)
        cond = value < bound if strict else value <= bound
        out = F.when(cond, res) if out is None else out.when(cond, res)
    return out


def imeca_raw(value: Column, pollutant: Column) -> Column:
    """Unrounded index; null for an unknown pollutant or a null value."""
    out = None
    for name, steps in IMECA.items():
        expr = _ladder(value, steps, lambda s: (value - F.lit(float(s[3]))) * F.lit(float(s[1])) + F.lit(float(s[2])), False)
        cond = (pollutant == name) & value.isNotNull()
        out = F.when(cond, expr) if out is None else out.when(cond, expr)
    return out


def imeca(value: Column, pollutant: Column) -> Column:
    return F.bround(imeca_raw(value, pollutant), 0)


def imeca_category(value: Column, pollutant: Column) -> Column:
    """Category taken from the unrounded index."""
    raw = imeca_raw(value, pollutant)
    return F.when(raw.isNotNull(), _ladder(raw, IMECA_CATEGORIES, lambda s: F.lit(s[1]), True))


def aq_category(value: Column, pollutant: Column) -> Column:
    out = None
    for name, limits in NOM_LIMITS.items():
        expr = _ladder(value, [*zip(limits, NOM_NAMES), (None, NOM_NAMES[-1])], lambda s: F.lit(s[1]), False)
        cond = (pollutant == name) & value.isNotNull()
        out = F.when(cond, expr) if out is None else out.when(cond, expr)
    return out


def nowcast(values: Column, factor: Column | float, newest_first: bool = False) -> Column:
    """Weighted mean of an array ordered oldest to newest; null below three readings.

    The oldest hour carries weight 1; ``newest_first`` gives that weight to the newest.
    """
    v = F.filter(values, lambda x: x.isNotNull())
    v = F.reverse(v) if newest_first else v
    top, low = F.array_max(v), F.array_min(v)
    ratio = F.when(top == 0, F.lit(0.0)).otherwise(F.try_divide(low, top))
    w = F.greatest(F.bround(ratio, 2), F.lit(0.5))
    zero = F.lit(0.0)
    num = F.aggregate(F.transform(v, lambda x, i: x * F.pow(w, i)), zero, lambda a, x: a + x)
    den = F.aggregate(F.transform(v, lambda x, i: F.pow(w, i)), zero, lambda a, x: a + x)
    fac = F.lit(factor) if isinstance(factor, float) else factor
    return F.when(F.size(v) >= 3, F.try_divide(num, den) * fac)


def quality_limit(pollutant: Column) -> Column:
    out = None
    for code, limit in QUALITY_LIMITS.items():
        cond = pollutant == code
        out = F.when(cond, F.lit(limit)) if out is None else out.when(cond, F.lit(limit))
    return out.otherwise(F.lit(QUALITY_DEFAULT))


def clean_value(value: Column, pollutant: Column) -> Column:
    """Null for a negative reading or one above the limit of its pollutant."""
    return F.when((value >= 0) & (value <= quality_limit(pollutant)) & ~F.isnan(value), value)


def wind_speed(u: Column, v: Column) -> Column:
    return F.sqrt(u * u + v * v)


def relative_humidity(t_kelvin: Column, mixing_ratio: Column, pressure_pa: Column) -> Column:
    """Percent, from Bolton's (1980) saturation pressure."""
    eps = F.lit(0.62198)
    p = pressure_pa / 100.0
    es = F.lit(6.112) * F.exp((t_kelvin - 273.15) * 17.67 / (t_kelvin - 29.65))
    ws = eps * es / (p - es)
    return mixing_ratio / (eps + mixing_ratio) * (eps + ws) / ws * 100.0
