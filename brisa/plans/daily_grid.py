"""Raw weather cells to the daily product: derive, crop, resample, rebase to local time."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from brisa.functions import air, clock
from brisa.operators import grid, windows
from brisa.session import settle

DERIVED = ["T2", "U10", "V10", "RAIN", "WS10", "RH"]


def derive(wx: DataFrame, file: str = "file") -> DataFrame:
    """RAIN, WS10 and RH next to T2, U10, V10; needs Q2 and PSFC cells for RH.

    One exchange by file and cell serves both steps: the variables of a cell side by side, then rain.
    """
    n = int(wx.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wx = wx.repartition(n, file, "i", "j")

    def var(name):
        return F.max(F.when(F.col("var") == name, F.col("value"))).alias(name)

    wide = wx.groupBy(file, "ts", "i", "j", "lat", "lon").agg(*[var(n) for n in ("T2", "U10", "V10", "RAINC", "RAINNC", "Q2", "PSFC")])
    wide = wide.withColumn("acc", F.col("RAINC") + F.col("RAINNC"))
    wide = windows.rain_deaccumulate(wide, [file, "i", "j"], "ts", "acc", "RAIN")
    wide = wide.withColumns({"WS10": air.wind_speed(F.col("U10"), F.col("V10")),
                             "RH": air.relative_humidity(F.col("T2"), F.col("Q2"), F.col("PSFC"))})
    return wide.unpivot([file, "ts", "i", "j", "lat", "lon"], DERIVED, "var", "value")


def daily_grid(wx: DataFrame, bbox: tuple[float, float, float, float], step: float, target: tuple[float, float, float, float],
               file: str = "file", steps_per_day: int = 24) -> tuple[DataFrame, DataFrame]:
    """All days at once: ``(product, incomplete)``.

    Of each file the first ``steps_per_day`` times count, so files that overlap do not mix: every value
    is made of one file's cells, and ``day`` is the day on which the file begins. Files with fewer
    times go to the second table, with the steps found, and are left out. The grid lines are read from
    the cells of one time; all files share them.
    """
    times = F.sort_array(F.collect_set("ts"))
    files = settle(wx.groupBy(file).agg(times.alias("_t")).select(file, F.size("_t").alias("n_steps"), F.col("_t")[0].alias("_first"),
                                                                   F.try_element_at("_t", F.lit(steps_per_day)).alias("_last")), "files")
    bad = files.filter(F.col("n_steps") < steps_per_day).select(file, "n_steps")
    good = wx.join(files.filter(F.col("_last").isNotNull()).select(file, "_last"), file).filter(F.col("ts") <= F.col("_last")).drop("_last")
    lat, lon = grid.axes(wx.filter(F.col("ts") == F.lit(files.agg(F.min("_first")).first()[0])))
    cells = derive(grid.crop(good, bbox, lat, lon), file)
    wa = grid.axis_weights(grid.crop_axis(lat, bbox[0], bbox[1]), target[0], target[1], step)
    wb = grid.axis_weights(grid.crop_axis(lon, bbox[2], bbox[3]), target[2], target[3], step)
    out = grid.bilinear(cells, wa, wb, (file, "ts", "var")).join(files.select(file, F.date_trunc("day", "_first").cast("timestamp_ntz").alias("day")), file)
    return out.withColumn("ts", clock.to_local(F.col("ts"))), bad
