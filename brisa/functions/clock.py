"""Time expressions on the local clock (UTC-6 stored as-is, session zone UTC)."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

DAY = 86400.0
# The three cycle lengths in seconds and the Spanish month folders.
CYCLES = {"day": DAY, "week": 7 * DAY, "year": 365.2425 * DAY}
MONTH_FOLDERS = ["01_enero", "02_febrero", "03_marzo", "04_abril", "05_mayo", "06_junio", "07_julio",
                 "08_agosto", "09_septiembre", "10_octubre", "11_noviembre", "12_diciembre"]
UTC_OFFSET_HOURS = -6


def seconds(ts: Column) -> Column:
    return F.unix_seconds(ts.cast("timestamp"))


def hour_index(ts: Column) -> Column:
    """Whole hours since 1970; the integer clock all hourly operators use."""
    return F.floor(seconds(ts) / 3600).cast("bigint")


def hour_stamp(h: Column) -> Column:
    return F.timestamp_seconds(h * 3600).cast("timestamp_ntz")


def day_index(ts: Column) -> Column:
    return F.floor(seconds(ts) / 86400).cast("bigint")


def shift_hours(ts: Column, hours: Column | int) -> Column:
    h = F.lit(hours) if isinstance(hours, int) else hours
    return F.timestamp_seconds(seconds(ts) + h * 3600).cast("timestamp_ntz")


def to_utc(ts: Column) -> Column:
    return shift_hours(ts, -UTC_OFFSET_HOURS)


def to_local(ts: Column) -> Column:
    return shift_hours(ts, UTC_OFFSET_HOURS)


def round_hour(ts: Column) -> Column:
    """Nearest full hour; half hours go to the even hour."""
    return F.timestamp_seconds(F.bround(F.unix_micros(ts.cast("timestamp")) / 3.6e9, 0).cast("bigint") * 3600) \
        .cast("timestamp_ntz")


def time_names() -> list[str]:
    """Names of :func:`time_features`, in order."""
    return [f"{kind}_{n}" for half in (["half_sin", "half_cos"], ["sin", "cos"]) for n in CYCLES for kind in half]


def time_features(ts: Column, flip_order: bool = False) -> dict[str, Column]:
    """Twelve cyclic columns. ``flip_order`` swaps week and year values, keeping the names."""
    t = seconds(ts)
    names = ["day", "week", "year"]
    periods = ["day", "year", "week"] if flip_order else names
    half, full = {}, {}
    for n, p in zip(names, periods):
        a = t * (math.pi / CYCLES[p])
        b = t * (2 * math.pi / CYCLES[p])
        half[f"half_sin_{n}"], half[f"half_cos_{n}"] = F.abs(F.sin(a)), F.abs(F.cos(a))
        full[f"sin_{n}"], full[f"cos_{n}"] = F.sin(b), F.cos(b)
    return {**half, **full}


def date_onehot(ts: Column) -> dict[str, Column]:
    """Scaled year, weekday (Monday 0), hour and ISO week; weeks 51 to 53 leave every week column 0."""
    out = {"year": (F.year(ts) - 1980) / F.lit(60.0)}
    for prefix, value, n in (("week_day", F.weekday(ts), 7), ("hour", F.hour(ts), 24), ("week", F.weekofyear(ts), 51)):
        out.update({f"{prefix}_{x}": (value == x).cast("int") for x in range(n)})
    return out


def hour_labels(start: Column, n: int) -> Column:
    """Text stamps ``yyyy_MM_dd HH:mm:ss`` of ``n`` hours from ``start``."""
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda k: F.date_format(shift_hours(start, k), "yyyy_MM_dd HH:mm:ss"))


def month_folder(month: Column) -> Column:
    return F.element_at(F.array(*[F.lit(m) for m in MONTH_FOLDERS]), month)


def parse_mixed(text: Column) -> Column:
    """Stamps with or without the time part; a bare date is its midnight."""
    return F.coalesce(
        F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss")), F.try_to_timestamp(text, F.lit("yyyy-MM-dd"))
    ).cast("timestamp_ntz")
