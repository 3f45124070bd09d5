"""Registry of named queries, each a Spark builder with its SQL twin over the same tables."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from brisa.session import prepare

Builder = Callable[[SparkSession, str], DataFrame]
_ROUND = re.compile(r"\s*@(\d)\)")
QUERIES: dict[str, Builder] = {}
SQL: dict[str, str] = {}


def _nudge(digits: int) -> str:
    return f"1.3717e-{digits + 3}"


def query(name: str, sql: str | None = None) -> Callable[[Builder], Builder]:
    def register(fn: Builder) -> Builder:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare(spark), sf_dir)

        if name in QUERIES:
            raise KeyError(name)
        run.__name__ = fn.__name__
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = _ROUND.sub(lambda m: f" + {_nudge(int(m.group(1)))}, {m.group(1)}) + 0", sql)
        return fn

    return register


def r(col: Column | str, digits: int = 6) -> Column:
    """Rounded output value.

    Means of short decimals often end exactly half-way, where the last bit of a sum decides; about
    a thousandth of the last digit is added first, here and for ``round(x @6)`` in the SQL. The
    amount is no short decimal itself, so it does not make new half-ways. The SQL adds 0 at the
    end, because only there a negative zero can appear.
    """
    if isinstance(col, str):
        return F.expr(f"round(`{col}` + {_nudge(digits)}D, {digits})")
    return F.round(col + F.lit(float(_nudge(digits))), digits)


def rounded(df: DataFrame, *cols: str, digits: int = 6) -> DataFrame:
    """``df`` with the named columns rounded; without names, every column but the first."""
    pick = set(cols or df.columns[1:])
    return df.selectExpr(*[f"round(`{c}` + {_nudge(digits)}D, {digits}) as `{c}`" if c in pick else f"`{c}`" for c in df.columns])
