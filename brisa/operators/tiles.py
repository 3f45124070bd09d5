"""Tiled grids: one row per (time, variable, tile) with an array of cells, and small tables written next to them.

The axis catalogue says where each grid line lies and the manifest which times each file holds, so crops,
weights, splits and missing days are worked out without reading a cell, and cells are never exploded
to be reduced: the weights of a tile's lines are joined to the tile.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from brisa.functions import clock
from brisa.operators import grid
from brisa.sources import manifest

SIDE = 32      # lines of a tile in either direction


def to_tiles(wx: DataFrame, side: int = SIDE) -> DataFrame:
    """(ts, var, ti, tj, cells) of long cells; ``cells`` has side * side values row by row, null where there is no cell.

    A tile is gathered from at most side * side rows. Where a cell comes twice, its largest value counts.
    """
    at = (F.col("i") % side * side + F.col("j") % side).alias("_at")
    once = wx.groupBy("ts", "var", "i", "j").agg(F.max("value").alias("value"))
    d = once.select("ts", "var", F.floor(F.col("i") / side).cast("int").alias("ti"), F.floor(F.col("j") / side).cast("int").alias("tj"), at, "value")
    d = d.groupBy("ts", "var", "ti", "tj").agg(F.map_from_entries(F.collect_list(F.struct("_at", "value"))).alias("_m"))
    return d.withColumn("cells", F.transform(F.sequence(F.lit(0), F.lit(side * side - 1)), lambda k: F.try_element_at("_m", k))).drop("_m")


@dataclass(frozen=True)
class TileStore:
    """A tiled grid below ``path``: tiles, axes (axis, idx, coord) and a manifest of its files."""

    spark: SparkSession
    path: str
    side: int = SIDE

    def axes(self) -> tuple[DataFrame, DataFrame]:
        both = self.spark.read.parquet(f"{self.path}/axes")
        return tuple(both.filter(F.col("axis") == a).select("idx", "coord") for a in ("lat", "lon"))

    def shape(self) -> tuple[int, int]:
        """Lines of the two axes: two numbers from the catalogue."""
        return tuple(a.agg(F.max("idx")).first()[0] + 1 for a in self.axes())

    def manifest(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/manifest")

    def tiles(self, start=None, end=None, variables: Sequence[str] | None = None) -> DataFrame:
        """Tiles with ``start <= ts < end``; only the files that the manifest names are opened."""
        return manifest.scan(self.spark, f"{self.path}/tiles", self.manifest(), start, end, variables)

    def crop(self, bbox: tuple[float, float, float, float], start=None, end=None) -> DataFrame:
        """Cells (ts, var, i, j, value) inside a box, by the rule of :func:`grid.crop`; other tiles are filtered out at the scan."""
        (i0, i1), (j0, j1) = (grid.crop_range(a, *b) for a, b in zip(self.axes(), (bbox[:2], bbox[2:])))
        near = F.col("ti").between(i0 // self.side, (i1 - 1) // self.side) & F.col("tj").between(j0 // self.side, (j1 - 1) // self.side)
        d = cells(self.tiles(start, end).filter(near), self.side)
        return d.filter((F.col("i") >= i0) & (F.col("i") < i1) & (F.col("j") >= j0) & (F.col("j") < j1))


def write(wx: DataFrame, path: str, side: int = SIDE) -> TileStore:
    """Write long cells (ts, var, i, j, lat, lon, value) as tiles partitioned by variable and month, with catalogue and manifest.

    Tiles lie in order of place inside a file, so a crop skips row groups. Both small tables come from
    the cells while they are written: the only time that all are read.
    """
    spark = wx.sparkSession
    d = to_tiles(wx, side).withColumns({"year": F.year("ts"), "month": F.month("ts")})
    d.hint("rebalance", "var", "year", "month").sortWithinPartitions("var", "year", "month", "ti", "tj", "ts").write.partitionBy("var", "year", "month").parquet(f"{path}/tiles")
    lines = F.array(F.struct(F.lit("lat").alias("axis"), F.col("i").alias("idx"), F.col("lat").alias("coord")),
                    F.struct(F.lit("lon").alias("axis"), F.col("j").alias("idx"), F.col("lon").alias("coord")))
    wx.select(F.inline(lines)).groupBy("axis", "idx").agg(F.min("coord").alias("coord")).write.parquet(f"{path}/axes")
    manifest.build(spark, f"{path}/tiles").write.parquet(f"{path}/manifest")
    return TileStore(spark, path, side)


def cells(tiles: DataFrame, side: int = SIDE) -> DataFrame:
    """(ts, var, i, j, value) of tiles; places without a cell or with a null value are left out."""
    d = tiles.select("ts", "var", "ti", "tj", F.posexplode("cells").alias("_k", "value")).filter(F.col("value").isNotNull())
    return d.select("ts", "var", (F.col("ti") * side + F.floor(F.col("_k") / side)).cast("int").alias("i"), (F.col("tj") * side + F.col("_k") % side).cast("int").alias("j"), "value")


def _per_tile(lines: DataFrame, side: int, name: str, keep: Sequence[str]) -> DataFrame:
    """``lines`` (idx, part, more) as one row per strip of tiles: (t, parts: array of part, its values and its lines in the tile)."""
    inner = lines.groupBy(F.floor(F.col("idx") / side).cast("int").alias(f"t{name}"), "part", *keep).agg(F.collect_list(F.struct((F.col("idx") % side).alias("r"), "w")).alias("lines"))
    return inner.groupBy(f"t{name}").agg(F.collect_list(F.struct("part", *keep, "lines")).alias(f"p{name}"))


def _sums(tiles: DataFrame, rows: DataFrame, cols: DataFrame, side: int, more: str) -> DataFrame:
    """One row per tile and pair of parts: (ts, var, row, col, s, c, more): weighted sum and number of its cells, summed in the tile."""
    value = f"cells[a.r * {side} + b.r]"
    terms = f"flatten(transform(p.lines, a -> transform(q.lines, b -> a.w * b.w * {value})))"
    each = f"flatten(transform(pi, p -> transform(pj, q -> struct(p.part as row, q.part as col, {terms} as x{more}))))"
    d = tiles.join(rows, "ti").join(cols, "tj").select("ts", "var", F.inline(F.expr(each)))
    return d.withColumns({"s": F.expr("aggregate(x, cast(0 as double), (a, v) -> a + coalesce(v, 0D))"), "c": F.expr("size(filter(x, v -> v is not null))")}).drop("x")


def bilinear(tiles: DataFrame, lat_w: DataFrame, lon_w: DataFrame, side: int = SIDE) -> DataFrame:
    """As :func:`grid.bilinear`, from tiles: weights are joined to tiles and a target gets at most four partial sums."""
    strip = lambda w, name: _per_tile(w.withColumnRenamed("k", "part"), side, name, ["target", "n"])
    d = _sums(tiles, strip(lat_w, "i"), strip(lon_w, "j"), side, ", p.n * q.n as need, p.target as lat, q.target as lon")
    d = d.groupBy("ts", "var", "row", "col").agg(F.sum("s").alias("s"), F.sum("c").alias("c"), F.max("need").alias("need"), F.max("lat").alias("lat"), F.max("lon").alias("lon"))
    return d.select("ts", "var", "row", "col", "lat", "lon", F.when(F.col("c") == F.col("need"), F.col("s")).alias("value"))


def subsample(tiles: DataFrame, rows: int, cols: int, store: TileStore, include_last: bool = False) -> DataFrame:
    """As :func:`grid.subsample`, from tiles: block sums are made in the tile, block coordinates come from the catalogue."""
    parts = []
    for axis, k in zip(store.axes(), (rows, cols)):
        split = grid.split_table(axis, k, "part", include_last)
        place = axis.join(split, "idx").groupBy("part").agg(F.avg("coord").alias("place"))
        parts.append(split.join(place, "part").withColumn("w", F.lit(1.0)))
    d = _sums(tiles, _per_tile(parts[0], store.side, "i", ["place"]), _per_tile(parts[1], store.side, "j", ["place"]), store.side, ", p.place as lat, q.place as lon")
    d = d.groupBy("ts", "var", "row", "col").agg(F.sum("s").alias("s"), F.sum("c").alias("c"), F.max("lat").alias("lat"), F.max("lon").alias("lon"))
    return d.select("ts", "var", "row", "col", F.try_divide("s", "c").alias("value"), "lat", "lon")


def stack(tiles: DataFrame, variables: Sequence[str], store: TileStore) -> DataFrame:
    """(ts, pos, value): the places of a time in (variable, lat, lon) order, absent values as 0; a tile without any cell has no rows.

    A cell's position follows from the shape of the grid, so no row gathers more than a tile.
    """
    n_lat, n_lon = store.shape()
    side = store.side
    which = F.array_position(F.array(*[F.lit(v) for v in variables]), F.col("var")) - 1
    d = tiles.filter(F.col("var").isin(list(variables))).select("ts", which.alias("_v"), "ti", "tj", F.posexplode("cells").alias("_k", "_x"))
    i, j = F.col("ti") * side + F.floor(F.col("_k") / side), F.col("tj") * side + F.col("_k") % side
    d = d.filter((i < n_lat) & (j < n_lon))
    return d.select("ts", (F.col("_v") * (n_lat * n_lon) + i * n_lon + j).cast("int").alias("pos"), F.coalesce("_x", F.lit(0.0)).alias("value"))


def zero_days(store: TileStore, variables: Sequence[str]) -> DataFrame:
    """(ts, var, i, j, lat, lon, value, is_synthetic): 24 hours of zero cells for every day the manifest lacks.

    Days come from the manifest, places from the catalogue: no cell is read.
    """
    days = manifest.days(store.manifest())
    span = days.agg(F.min("day").alias("lo"), F.max("day").alias("hi"))
    gap = span.select(F.explode(F.sequence("lo", "hi")).alias("day")).join(days, "day", "left_anti")
    lat, lon = store.axes()
    rows = lat.select(F.collect_list(F.struct(F.col("idx").alias("i"), F.col("coord").alias("lat")))).scalar()
    cols = lon.select(F.collect_list(F.struct(F.col("idx").alias("j"), F.col("coord").alias("lon")))).scalar()
    d = gap.withColumn("_h", F.explode(F.sequence(F.lit(0), F.lit(23)))).withColumn("var", F.explode(F.array(*[F.lit(v) for v in variables])))
    d = d.withColumn("a", F.explode(rows)).withColumn("b", F.explode(cols))
    return d.select(clock.hour_stamp(F.col("day") * 24 + F.col("_h")).alias("ts"), "var", "a.i", "b.j", "a.lat", "b.lon", F.lit(0.0).alias("value"), F.lit(1).alias("is_synthetic"))
