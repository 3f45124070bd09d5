"""Regular-grid operators on long cells ``(ts, var, i, j, lat, lon, value)``.

Axis tables hold one row per grid line and are settled, so Spark knows the size of what is
derived from them (crop bounds, weights, splits) and broadcasts it below its threshold; cells
meet them by equi joins and are reduced with map-side combine, one exchange per operator.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from brisa.functions import clock
from brisa.operators.blocks import BLOCK_HOURS, positions
from brisa.session import settle


def axes(wx: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The lat and lon axes as (idx, coord), from one pass over the cells."""
    lines = F.array(F.struct(F.lit("lat").alias("axis"), F.col("i").alias("idx"), F.col("lat").alias("coord")),
                    F.struct(F.lit("lon").alias("axis"), F.col("j").alias("idx"), F.col("lon").alias("coord")))
    both = settle(wx.select(F.inline(lines)).groupBy("axis", "idx").agg(F.min("coord").alias("coord")), "axes")
    return tuple(both.filter(F.col("axis") == a).select("idx", "coord") for a in ("lat", "lon"))


def crop_range(ax: DataFrame, lo: float, hi: float) -> tuple[int, int]:
    """Start index and exclusive stop of a crop along one settled axis.

    Start is the first index with coord >= lo; stop is one before the first with coord >= hi,
    so the last cell inside the box is left out. A bound beyond the axis keeps all. The two
    numbers come to the driver, so the crop reaches the scan as plain filters.
    """
    c, i = F.col("coord"), F.col("idx")
    r = ax.agg(F.coalesce(F.min(F.when(c >= lo, i)), F.min(i)), F.coalesce(F.min(F.when(c >= hi, i)) - 1, F.max(i) + 1)).first()
    return r[0], r[1]


def crop_axis(ax: DataFrame, lo: float, hi: float) -> DataFrame:
    start, stop = crop_range(ax, lo, hi)
    return ax.filter((F.col("idx") >= start) & (F.col("idx") < stop))


def crop(wx: DataFrame, bbox: tuple[float, float, float, float], lat_axis: DataFrame, lon_axis: DataFrame,
         first_steps: int | None = None, step: str = "t") -> DataFrame:
    """Cells inside ``(minlat, maxlat, minlon, maxlon)``, optionally only the first N steps."""
    (i0, i1), (j0, j1) = crop_range(lat_axis, bbox[0], bbox[1]), crop_range(lon_axis, bbox[2], bbox[3])
    d = wx.filter((F.col("i") >= i0) & (F.col("i") < i1) & (F.col("j") >= j0) & (F.col("j") < j1))
    return d.filter(F.col(step) < first_steps) if first_steps is not None else d


def target_count(lo: float, hi: float, step: float) -> int:
    return math.ceil((hi - lo) / step)


def axis_weights(ax: DataFrame, lo: float, hi: float, step: float) -> DataFrame:
    """Linear weights ``(idx, k, target, w, n)`` of source lines for the targets ``lo + k * step``.

    A target outside the source range keeps one row with a null weight. The window over the
    whole axis sees one row per grid line.
    """
    n = target_count(lo, hi, step)
    nxt = Window.partitionBy(F.lit(0)).orderBy("coord")
    seg = ax.select("idx", "coord", F.lead("idx").over(nxt).alias("idx1"), F.lead("coord").over(nxt).alias("c1"),
                    (F.lead("coord", 2).over(nxt).isNull()).alias("is_last"))
    seg = (seg.filter(F.col("idx1").isNotNull()).withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
           .withColumn("target", F.lit(float(lo)) + F.col("k") * F.lit(float(step))))
    t = F.col("target")
    seg = seg.filter((t >= F.col("coord")) & ((t < F.col("c1")) | (F.col("is_last") & (t <= F.col("c1")))))
    w1 = (t - F.col("coord")) / (F.col("c1") - F.col("coord"))
    both = F.array(F.struct(F.col("idx").alias("idx"), (1 - w1).alias("w")), F.struct(F.col("idx1").alias("idx"), w1.alias("w")))
    inside = seg.select("k", "target", F.inline(both)).filter(F.col("w") > 0)
    inside = inside.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("k")))
    everyone = ax.select(F.min("idx").alias("idx")).withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    outside = everyone.join(inside.select("k").distinct(), "k", "left_anti").select(
        "k", (F.lit(float(lo)) + F.col("k") * F.lit(float(step))).alias("target"), "idx", F.lit(None).cast("double").alias("w"), F.lit(1).cast("bigint").alias("n"))
    return inside.unionByName(outside)


def bilinear(wx: DataFrame, lat_w: DataFrame, lon_w: DataFrame, by: Sequence[str] = ("ts", "var")) -> DataFrame:
    """Bilinear values on the target grid; null outside the source or where a needed cell is null."""
    a = lat_w.select(F.col("idx").alias("i"), F.col("k").alias("row"), F.col("target").alias("lat_t"), F.col("w").alias("wa"), F.col("n").alias("na"))
    b = lon_w.select(F.col("idx").alias("j"), F.col("k").alias("col"), F.col("target").alias("lon_t"), F.col("w").alias("wb"), F.col("n").alias("nb"))
    part = F.col("wa") * F.col("wb") * F.col("value")
    d = wx.select(*by, "i", "j", "value").join(a, "i").join(b, "j").groupBy(*by, "row", "col").agg(
        F.sum(part).alias("_s"), F.count(part).alias("_c"), F.max(F.col("na") * F.col("nb")).alias("_need"),
        F.max("lat_t").alias("lat"), F.max("lon_t").alias("lon"))
    return d.select(*by, "row", "col", "lat", "lon", F.when(F.col("_c") == F.col("_need"), F.col("_s")).alias("value"))


def even_split(n: int, k: int, include_last: bool = False) -> list[tuple[int, int]]:
    """Start and exclusive end of ``k`` near-even parts of ``n`` points.

    Larger parts come first and the last bounds are clipped to n-2 and n-1, so the last line
    of a grid is unused unless ``include_last``. With no more points than parts each part is
    one nearest point.
    """
    if n <= k:
        width = (n - 1) / k
        return [(int(i * width), int(i * width) + 1) for i in range(1, k + 1)]
    base, extra = divmod(n, k)
    cuts = [0]
    for p in range(k):
        cuts.append(cuts[-1] + base + (1 if p < extra else 0))
    if include_last:
        return list(zip(cuts, cuts[1:]))
    return [(min(a, n - 2), min(b, n - 1)) for a, b in zip(cuts, cuts[1:])]


def quadrant_label(row: Column, col: Column) -> Column:
    return F.concat_ws("_", row.cast("string"), col.cast("string"))


def split_table(ax: DataFrame, k: int, name: str, include_last: bool = False) -> DataFrame:
    """``(part, idx)`` rows of an even split; only the axis length reaches the driver."""
    n = ax.agg(F.max("idx") + 1).first()[0]
    rows = [(p, i) for p, (a, b) in enumerate(even_split(n, k, include_last)) for i in range(a, b)]
    return ax.sparkSession.createDataFrame(rows, f"{name} int, idx int")


def subsample(wx: DataFrame, rows: int, cols: int, lat_axis: DataFrame, lon_axis: DataFrame, include_last: bool = False,
              by: Sequence[str] = ("ts", "var")) -> DataFrame:
    """Block means over ``rows`` x ``cols`` quadrants, with the mean coordinates of each block."""
    a = split_table(lat_axis, rows, "row", include_last).withColumnRenamed("idx", "i")
    b = split_table(lon_axis, cols, "col", include_last).withColumnRenamed("idx", "j")
    return wx.join(a, "i").join(b, "j").groupBy(*by, "row", "col").agg(
        F.avg("value").alias("value"), F.avg("lat").alias("lat"), F.avg("lon").alias("lon"))


def spatial_summary(wx: DataFrame, by: Sequence[str] = ("ts", "var")) -> DataFrame:
    return wx.groupBy(*by).agg(F.avg("value").alias("mean"), F.min("value").alias("min"), F.max("value").alias("max"))


def info(wx: DataFrame) -> DataFrame:
    """Shape, bytes as doubles and null cells of a grid table."""
    return wx.agg(F.count_distinct("ts").alias("n_times"), F.count_distinct("var").alias("n_vars"),
                  F.count_distinct("i").alias("n_lat"), F.count_distinct("j").alias("n_lon"),
                  F.count(F.lit(1)).alias("cells"), (F.count(F.lit(1)) * 8).alias("bytes"),
                  F.count_if(F.col("value").isNull()).alias("nulls"))


def check(wx: DataFrame, expected_vars: Sequence[str], steps: int, by: str) -> DataFrame:
    """Per product: steps found, expected variables missing, ok."""
    known = F.when(F.col("var").isin(list(expected_vars)), F.col("var"))
    return wx.groupBy(by).agg(F.count_distinct("ts").alias("n_steps"),
                              (F.lit(len(expected_vars)) - F.count_distinct(known)).alias("n_missing")).withColumn(
        "ok", ((F.col("n_steps") == steps) & (F.col("n_missing") == 0)).cast("int"))


def duplicates(wx: DataFrame) -> DataFrame:
    return wx.groupBy("ts", "var", "i", "j").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def flatten(wx: DataFrame, variables: Sequence[str], cells: int, width: int, digits: int = 4) -> DataFrame:
    """One row per time with ``{var}_{cell}`` columns, from an explicit pivot list."""
    key = F.concat_ws("_", "var", (F.col("i") * width + F.col("j")).cast("string"))
    return (wx.select("ts", key.alias("_k"), F.round("value", digits).alias("_v"))
            .groupBy("ts").pivot("_k", [f"{v}_{c}" for v in variables for c in range(cells)]).agg(F.max("_v")))


def stack(wx: DataFrame, variables: Sequence[str]) -> DataFrame:
    """``(ts, cells)``: all cells of a time in (variable, lat, lon) order, nulls as 0."""
    pos = F.array_position(F.array(*[F.lit(v) for v in variables]), F.col("var"))
    cell = F.struct(pos.alias("p"), "i", "j", F.coalesce("value", F.lit(0.0)).alias("v"))
    return (wx.filter(F.col("var").isin(list(variables))).groupBy("ts").agg(F.array_sort(F.collect_list(cell)).alias("_c"))
            .select("ts", F.transform("_c", lambda s: s["v"]).alias("cells")))


def frame(wx: DataFrame, index: int) -> DataFrame:
    """Cells of the ``index``-th time (from 0); an index out of range is an error of the job.

    Times are numbered in blocks of hours, of which only the sizes are summed up.
    """
    times = positions(wx.select("ts").distinct(), [], ["ts"], F.floor(clock.hour_index(F.col("ts")) / BLOCK_HOURS), "_r")
    pick = times.select(F.coalesce(F.max(F.when(F.col("_r") == index + 1, F.col("ts"))),
                                   F.raise_error(F.lit(f"time index {index} is out of range")).cast("timestamp_ntz"))).scalar()
    return wx.filter(F.col("ts") == pick)


def zero_fill_days(wx: DataFrame, start=None, end=None) -> DataFrame:
    """Missing days become 24 hours of zero cells marked ``is_synthetic``.

    The list of missing days is one small array; only the cells of the grid are copied per day.
    """
    d = clock.day_index(F.col("ts"))
    lo = wx.select(F.min(d)).scalar() if start is None else clock.day_index(F.lit(start).cast("timestamp_ntz"))
    hi = wx.select(F.max(d)).scalar() if end is None else clock.day_index(F.lit(end).cast("timestamp_ntz"))
    days = wx.select(F.collect_set(d)).scalar()
    cells = wx.groupBy("var", "i", "j").agg(F.min("lat").alias("lat"), F.min("lon").alias("lon"))
    gap = (cells.withColumn("_d", F.explode(F.array_except(F.sequence(lo, hi), days)))
           .withColumn("_h", F.explode(F.sequence(F.lit(0), F.lit(23)))))
    made = gap.select(clock.hour_stamp(F.col("_d") * 24 + F.col("_h")).alias("ts"), "var", "i", "j", "lat", "lon",
                      F.lit(0.0).alias("value"), F.lit(1).alias("is_synthetic"))
    return wx.select("ts", "var", "i", "j", "lat", "lon", "value", F.lit(0).alias("is_synthetic")).unionByName(made)


def combine_days(parts: Sequence[DataFrame], hours: int) -> DataFrame:
    """Days put end to end along time and cut to the first ``hours`` hours."""
    d = parts[0]
    for p in parts[1:]:
        d = d.unionByName(p, allowMissingColumns=True)
    first = d.select(F.min(clock.hour_index(F.col("ts")))).scalar()
    return d.filter(clock.hour_index(F.col("ts")) < first + hours)
