"""Ordered work cut into bounded pieces.

A window over a whole series puts that series into one task. Every ordered operator
here goes through these helpers instead: rows are keyed by (series, time block), rows
near an edge are copied into the neighbouring block (the halo), and what must travel
further than a halo is first reduced to one row per block.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.window import WindowSpec

from brisa.session import settle

BLOCK_HOURS = 768


def windowed(df: DataFrame, keys: Sequence[str], hour: str, make: Callable[[WindowSpec], dict[str, Column]],
             before: int = 0, after: int = 0, block: int = BLOCK_HOURS) -> DataFrame:
    """Add window columns whose frames reach at most ``before``/``after`` hours.

    ``hour`` is the integer hour index. One exchange on (keys, block); a block holds at
    most ``block + before + after`` hours of a series.
    """
    h = F.col(hour)
    first, last = F.floor((h - after) / block), F.floor((h + before) / block)
    d = df.withColumn("_blk", F.explode(F.sequence(first, last)))
    w = Window.partitionBy(*keys, "_blk").orderBy(hour)
    d = d.select("*", *[c.alias(n) for n, c in make(w).items()])
    return d.filter(F.col("_blk") == F.floor(h / block)).drop("_blk")


def _totals(sizes: DataFrame, keys: Sequence[str], part: str, size: str) -> DataFrame:
    """Rows before each part (``_off``) and in all (``_tot``), from the table of part sizes."""
    w = Window.partitionBy(*(keys or [F.lit(0)]))
    before = F.sum(size).over(w.orderBy(part).rowsBetween(Window.unboundedPreceding, -1))
    return sizes.select(*keys, part, F.coalesce(before, F.lit(0)).alias("_off"), F.sum(size).over(w).alias("_tot"))


def positions(df: DataFrame, keys: Sequence[str], order: Sequence[str], bucket: Column, name: str = "pos",
              total: str | None = None) -> DataFrame:
    """1-based position within ``keys`` by ``order`` without sorting a key in one task.

    ``bucket`` must grow with ``order`` and be even by construction (a hash range, unique
    hours of a day); only its sizes are summed up over the whole key. For any other order see
    :func:`ranged_positions`.
    """
    d = df.withColumn("_b", bucket)
    w = Window.partitionBy(*keys, "_b").orderBy(*order)
    sizes = d.groupBy(*keys, "_b").agg(F.count(F.lit(1)).alias("_n"))
    numbered = d.withColumn("_rn", F.row_number().over(w)).join(_totals(sizes, keys, "_b", "_n"), [*keys, "_b"])
    extra = [F.col("_tot").alias(total)] if total else []
    return numbered.select(*df.columns, (F.col("_rn") + F.col("_off")).cast("bigint").alias(name), *extra)


def ranged_positions(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "pos", total: str | None = None) -> DataFrame:
    """1-based position within ``keys`` by ``order`` for data of any skew.

    Rows are range partitioned on (keys, order), so a hot key or a hot time is spread over many
    ranges; the ranges are written once, and their sizes and rows are both taken from that table.
    When ``keys`` and ``order`` are all columns, equal rows are counted first and laid out again after.
    """
    all_cols = list(df.columns)
    copies = set(keys) | set(order) == set(all_cols)
    d = df.groupBy(*all_cols).agg(F.count(F.lit(1)).alias("_n")) if copies else df.withColumn("_n", F.lit(1).cast("bigint"))
    d = settle(d.repartitionByRange(*keys, *order).withColumn("_p", F.spark_partition_id()), "ranges")
    sizes = d.groupBy(*keys, "_p").agg(F.sum("_n").alias("_m"))
    offsets = settle(_totals(sizes, keys, "_p", "_m"), "offsets")
    extra = [F.col("_tot").alias(total)] if total else []
    w = Window.partitionBy(*keys, "_p").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    last = F.col("_c") + F.col("_off")
    d = d.withColumn("_c", F.sum("_n").over(w)).join(offsets, [*keys, "_p"])
    if copies:
        return d.select(*all_cols, F.explode(F.sequence(last - F.col("_n") + 1, last)).alias(name), *extra)
    return d.select(*all_cols, last.alias(name), *extra)


def running_total(df: DataFrame, order: Sequence[str], bucket: Column, value: Column, name: str) -> DataFrame:
    """Inclusive prefix sum of ``value`` over the whole table, summed per bucket first."""
    d = df.withColumn("_b", bucket).withColumn("_v", value)
    sums = d.groupBy("_b").agg(F.sum("_v").alias("_s"))
    before = Window.partitionBy(F.lit(0)).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("_b", F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_off"))
    w = Window.partitionBy("_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (d.withColumn("_c", F.sum("_v").over(w)).join(offsets, "_b")
            .withColumn(name, F.col("_c") + F.col("_off")).drop("_b", "_v", "_c", "_off"))


def value_counts(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Occurrences of every value per group: (keys, _v, _c)."""
    return df.filter(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_c"))


def exact_quantiles(counts: DataFrame, keys: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """Exact linearly interpolated quantiles per group: (keys, p, q), from settled :func:`value_counts`.

    One way for groups of any size: the distinct values are range partitioned on (keys, value), the
    sizes of the ranges are summed up, and only ranges that hold a wanted rank are put in order,
    each by itself. No buffer holds a group.
    """
    n = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = settle(counts.repartitionByRange(n, *keys, "_v").withColumn("_part", F.spark_partition_id()), "ranges")
    sizes = ranged.groupBy(*keys, "_part").agg(F.sum("_c").alias("_m"))
    whole = Window.partitionBy(*(keys or [F.lit(0)]))
    upto = F.sum("_m").over(whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    sizes = sizes.select(*keys, "_part", (upto - F.col("_m")).alias("_off"), upto.alias("_end"), F.sum("_m").over(whole).alias("_n"))
    want = sizes.withColumn("p", F.explode(F.array(*[F.lit(float(p)) for p in probs]))).withColumn("_k", (F.col("_n") - 1) * F.col("p"))
    want = want.withColumn("_rank", F.explode(F.array_distinct(F.array(F.floor("_k"), F.ceil("_k")))))
    want = settle(want.filter((F.col("_rank") >= F.col("_off")) & (F.col("_rank") < F.col("_end"))).select(*keys, "_part", "_off", "p", "_k", "_rank"), "ranks")
    rows = ranged.join(want.select(*keys, "_part").distinct(), [*keys, "_part"], "left_semi")
    to = F.sum("_c").over(Window.partitionBy(*keys, "_part").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = rows.withColumn("_to", to).withColumn("_from", F.col("_to") - F.col("_c"))
    at = F.col("_rank") - F.col("_off")
    found = want.join(rows, [*keys, "_part"]).filter((at >= F.col("_from")) & (at < F.col("_to")))
    lo, hi, frac = F.min("_v"), F.max("_v"), F.max("_k") - F.floor(F.max("_k"))
    return found.groupBy(*keys, "p").agg((lo + (hi - lo) * frac).alias("q"))
