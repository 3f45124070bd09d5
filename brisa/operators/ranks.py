"""Rows by rank without a sort of the table: histograms that close in on the wanted row.

Each pass counts the rows of a few hundred ranges and goes on inside the one that holds the rank. Only
counts leave the tasks; the table is neither written nor put in order.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import NumericType, StringType

from brisa.session import settle

RANGES = 256        # ranges of one pass
FEW = 4096          # rows that are put in order at the end


def _next_range(d: DataFrame, code: Column, rank: int) -> tuple[object, int, int]:
    """(value of ``code``, rows below it, rows in it) for the value that holds the ``rank``-th row; the counts of at most RANGES + 2 values."""
    below = 0
    for value, n in sorted(((r[0], r[1]) for r in d.groupBy(code.alias("c")).agg(F.count(F.lit(1)).alias("n")).collect()), key=lambda x: x[0]):
        if rank <= below + n:
            return value, below, n
        below += n
    raise ValueError("rank beyond the rows")


def _number(d: DataFrame, col: str) -> tuple[Column, bool]:
    """A column as a number of the same order, and whether it is whole."""
    kind = d.schema[col].dataType
    if kind.typeName() in ("timestamp", "timestamp_ntz"):
        return F.unix_micros(F.col(col).cast("timestamp")), True
    if kind.typeName() == "date":
        return F.unix_date(col), True
    if isinstance(kind, NumericType):
        return F.col(col), kind.typeName() in ("byte", "short", "integer", "long")
    return F.col(col).cast("int"), True


def _close_in_number(d: DataFrame, col: str, rank: int, few: int) -> tuple[DataFrame, int, int]:
    x, whole = _number(d, col)
    while True:
        lo, hi, n = d.agg(F.min(x), F.max(x), F.count(F.lit(1))).first()
        if lo == hi or n <= few:
            return d, rank, n
        width = max(float(hi) / RANGES - float(lo) / RANGES, 1.0 if whole else 0.0)
        code = F.floor(x / F.lit(width) - F.lit(float(lo) / width)) if width > 0 else (x > F.lit(lo)).cast("bigint")
        value, below, m = _next_range(d, code, rank)
        if m == n:
            # numbers too close for their ranges to differ: the least one against the others
            code = (x > F.lit(lo)).cast("bigint")
            value, below, m = _next_range(d, code, rank)
        d, rank = d.filter(code == value), rank - below


def _close_in_text(d: DataFrame, col: str, rank: int, few: int) -> tuple[DataFrame, int, int]:
    """By the first byte in which the texts differ, again and again; a text that has ended comes before all that go on."""
    raw = F.col(col).cast("binary")
    while True:
        lo, hi, n = d.agg(F.min(raw), F.max(raw), F.count(F.lit(1))).first()
        if lo == hi or n <= few:
            return d, rank, n
        lo, hi = bytes(lo), bytes(hi)
        at = next((i for i in range(len(lo)) if lo[i] != hi[i]), len(lo))
        code = F.coalesce(F.conv(F.hex(F.substring(raw, at + 1, 1)), 16, 10).try_cast("int"), F.lit(-1))
        value, below, _ = _next_range(d, code, rank)
        d, rank = d.filter(code == value), rank - below


def rank_row(df: DataFrame, order: Sequence[str], rank: int, few: int = FEW) -> dict[str, object]:
    """Values of ``order`` in the row at position ``rank`` (from 1); nulls come first, NaN last, text goes by its bytes.

    One column after the other is narrowed to a single value, or until ``few`` rows are left, which are
    then put in order. Every pass reads only these columns and gives out counts of at most 258 ranges.
    """
    d = df.select(*order)
    for col in order:
        kind = F.when(F.col(col).isNull(), 0).otherwise(2)
        if d.schema[col].dataType.typeName() in ("float", "double"):
            kind = F.when(F.isnan(col), 4).when(F.col(col) == float("inf"), 3).when(F.col(col) == float("-inf"), 1).when(F.col(col).isNull(), 0).otherwise(2)
        value, below, n = _next_range(d, kind, rank)
        d, rank = d.filter(kind == value), rank - below
        if value == 2 and n > few:
            close = _close_in_text if isinstance(d.schema[col].dataType, StringType) else _close_in_number
            d, rank, n = close(d, col, rank, few)
        if n <= few:
            break
    return d.orderBy(*order).offset(rank - 1).limit(1).first().asDict()


def below_row(order: Sequence[str], row: dict[str, object], schema) -> tuple[Column, Column]:
    """Whether a row comes before ``row`` by ``order``, and whether it is equal to it."""
    before, equal = F.lit(False), F.lit(True)
    for c in order:
        v = F.lit(row[c]).cast(schema[c].dataType)
        less = F.when(F.col(c).isNull(), F.lit(row[c] is not None)).otherwise(F.lit(False) if row[c] is None else F.col(c) < v)
        before = before | (equal & less)
        equal = equal & F.col(c).eqNullSafe(v)
    return before, equal


def split_at(df: DataFrame, order: Sequence[str], n_first: int, first: str, rest: str, name: str = "split") -> DataFrame:
    """``df`` with ``name``: ``first`` for exactly the first ``n_first`` rows by ``order``, ``rest`` for the others.

    Rows that tie with the last one of the first part are told apart by a hash of all their columns; rows
    equal in everything are counted and laid out again, so the sizes are exact.
    """
    if n_first <= 0:
        return df.withColumn(name, F.lit(rest))
    d = df.withColumn("_tie", F.xxhash64(*[x for c in df.columns for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]))
    by = [*order, "_tie"]
    row = rank_row(d, by, n_first)
    before, equal = below_row(by, row, d.schema)
    marked = d.withColumns({"_before": before, "_equal": equal})
    n_before = marked.filter("_before").count()
    ties = marked.filter("_equal").groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    up_to = F.sum("_n").over(_whole(order, df.columns))
    ties = ties.withColumn("_to", up_to).withColumn("_k", F.explode(F.sequence(F.col("_to") - F.col("_n") + 1, F.col("_to"))))
    ties = ties.select(*df.columns, F.when(F.col("_k") <= n_first - n_before, first).otherwise(rest).alias(name))
    return marked.filter(~F.col("_equal")).select(*df.columns, F.when(F.col("_before"), first).otherwise(rest).alias(name)).unionByName(ties)


def _whole(order: Sequence[str], columns: Sequence[str]):
    """Over the distinct rows that share one hash: one row but for a collision."""
    return Window.partitionBy(F.lit(0)).orderBy(*columns).rowsBetween(Window.unboundedPreceding, Window.currentRow)


_NAN = 0x7FF8       # the first 16 bits of NaN; infinity has 0x7FF0


def group_quantiles(df: DataFrame, by: Sequence[str], value: Column, quantile: float, name: str) -> DataFrame:
    """(_g, ``name``): the exact quantile of ``value`` (double, no nulls) in each group; ``_g`` is ``group_key(by)``.

    The first pass counts each group's values by their first 16 bits, the next ones go on with 16 more
    inside the ranges that hold the two wanted ranks. Counts are added up before the shuffle, so no group
    meets in one task, only its counts, at most 65,536 in a pass. A group with NaN has NaN.
    """
    last, nan = np.int64(np.iinfo(np.int64).max), np.int64(_NAN << 48)

    def order_bits(x):        # doubles as whole numbers of the same order; every NaN is one, and comes last
        v = x.to_numpy(zero_copy_only=False).astype(float) + 0.0
        b = np.where(np.isnan(v), nan, v.view(np.int64))
        return pa.array(np.where(b < 0, b ^ last, b))

    def from_bits(x):
        b = x.to_numpy(zero_copy_only=False)
        return pa.array(np.where(b < 0, b ^ last, b).view(float))

    bits = F.arrow_udf(order_bits, "bigint", F.ArrowUDFType.SCALAR)
    back = F.arrow_udf(from_bits, "double", F.ArrowUDFType.SCALAR)
    coded = df.select(group_key(by).alias("_g"), bits(value).alias("_k")).withColumn("_b", F.shiftright("_k", 48))
    bins = settle(coded.groupBy("_g", "_b").agg(F.count(F.lit(1)).alias("_n")).withColumn("_p", F.lit(0).cast("bigint")), "first-bits")
    h = (F.col("n") - 1) * F.lit(float(quantile))
    sides = F.array(*[F.struct(F.lit(k).alias("side"), f(h).cast("bigint").alias("rank")) for k, f in enumerate((F.floor, F.ceil))])
    sizes = bins.groupBy("_g").agg(F.sum("_n").alias("n"), (F.max("_b") == _NAN).alias("nan"), F.min("_p").alias("_p"))
    want = sizes.select("_g", "_p", "nan", (h - F.floor(h)).alias("share"), F.inline(sides))
    rows = None
    for shift in (48, 32, 16, 0):
        if shift < 48:
            held = want.select("_g", F.col("_p")).distinct()
            if rows is None:
                rows = coded.withColumnRenamed("_b", "_p").join(held, ["_g", "_p"], "left_semi").groupBy("_g", "_k").agg(F.count(F.lit(1)).alias("_n"))
            else:
                rows = rows.withColumn("_p", F.shiftright("_k", shift + 16)).join(held, ["_g", "_p"], "left_semi")
            rows = settle(rows.select("_g", "_k", "_n"), "ranked")
            bins = rows.groupBy("_g", F.shiftright("_k", shift + 16).alias("_p"), F.shiftright("_k", shift).alias("_b")).agg(F.sum("_n").alias("_n"))
        up_to = bins.withColumn("_to", F.sum("_n").over(Window.partitionBy("_g", "_p").orderBy("_b")))
        found = want.join(up_to, ["_g", "_p"]).where((F.col("rank") < F.col("_to")) & (F.col("rank") >= F.col("_to") - F.col("_n")))
        want = settle(found.select("_g", F.col("_b").alias("_p"), "nan", "share", "side", (F.col("rank") - F.col("_to") + F.col("_n")).alias("rank")), "ranks")
    ends = want.groupBy("_g", "nan", "share").agg(*[F.max(F.when(F.col("side") == k, F.col("_p"))).alias(c) for k, c in enumerate("ab")])
    ends = ends.select("_g", "nan", "share", back("a").alias("a"), back("b").alias("b"))
    between = F.when(F.col("a") == F.col("b"), F.col("a")).otherwise(F.col("a") * (1 - F.col("share")) + F.col("b") * F.col("share"))
    return ends.select("_g", F.when(F.col("nan"), float("nan")).otherwise(between).alias(name))


def group_key(by: Sequence[str]) -> Column:
    """The columns ``by`` in one that is never null, also when there is none."""
    return F.struct(F.lit(0).alias("_"), *by)
