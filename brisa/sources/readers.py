"""Scans: partitioned observation and grid tables, yearly CSVs, agency CSVs, forecast CSVs, logs.

Missing values (NaN, empty text) become SQL nulls here, so aggregates downstream skip them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from brisa.functions import clock, names
from brisa.schema import LOGS, OBS, WX
from brisa.session import settle

# Header lines of an agency file, name of a yearly file.
AGENCY_HEADER_LINES = 11
YEARLY_FILE = "{year}_AllStations.csv"


def _month_key(ts: Column) -> Column:
    return F.year(ts) * 12 + F.month(ts)


def scan_obs(spark: SparkSession, path: str) -> DataFrame:
    """Observation table written by :func:`brisa.sources.sinks.write_obs` (partitioned by pollutant, year)."""
    return spark.read.schema(OBS + ", year int").parquet(path).drop("year")


def jdbc_obs(spark: SparkSession, url: str, table: str, pollutant: str, lower: str, upper: str, parts: int = 64, **options: str) -> DataFrame:
    """One pollutant's table over JDBC, split by time; date and station filters are pushed to the database."""
    return (spark.read.format("jdbc").options(url=url, dbtable=table, partitionColumn="fecha", lowerBound=lower, upperBound=upper,
                                              numPartitions=str(parts), **options).load()
            .select(F.col("fecha").cast("timestamp_ntz").alias("fecha"), F.lit(pollutant).alias("pollutant"), "id_est",
                    F.col("val").cast("double").alias("val")))


def scan_grid(spark: SparkSession, path: str, start, end) -> DataFrame:
    """Grid cells with ``start <= ts < end``; only the months touched are listed and read."""
    lo, hi = F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")
    d = spark.read.schema(WX.replace("lat_idx", "i").replace("lon_idx", "j") + ", year int, month int").parquet(path)
    key = F.col("year") * 12 + F.col("month")
    return d.filter(key.between(_month_key(lo), _month_key(hi)) & (F.col("ts") >= lo) & (F.col("ts") < hi)).drop("year", "month")


def yearly_files(folder: str, first: int, last: int, pattern: str = YEARLY_FILE) -> list[str]:
    """File per year; also ``contaminantes_{year}.csv`` or ``meteorología_{year}.csv`` layouts."""
    return [f"{folder.rstrip('/')}/{pattern.format(year=y)}" for y in range(first, last + 1)]


def yearly_csv(spark: SparkSession, folder: str, first: int | None = None, last: int | None = None, index: str = "fecha") -> DataFrame:
    """Wide yearly files below ``folder`` united by column name; stamps without time are midnight, numbers are doubles.

    All files are read in one scan, whatever their years; each line is matched with the header of its
    own file, and only the names of the columns come to the driver. ``first`` and ``last`` bound the
    year of the stamps.
    """
    raw = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").text(folder).select(F.col("_metadata.file_path").alias("path"), "value")
    head = F.col("value").rlike(f"^{index}(,|$)")
    headers = settle(raw.filter(head).groupBy("path").agg(F.min("value").alias("_h")), "headers")
    columns = [r[0] for r in headers.select(F.posexplode(F.split("_h", ",")).alias("p", "c")).groupBy("c").agg(F.min("p").alias("p")).orderBy("p", "c").select("c").collect()]
    d = raw.filter(~head & (F.length("value") > 0)).join(headers, "path").select(F.split("value", ",").alias("_v"), F.split("_h", ",").alias("_n"))
    cell = lambda c: F.try_element_at("_v", F.nullif(F.array_position("_n", F.lit(c)).cast("int"), F.lit(0)))
    out = d.select(clock.parse_mixed(cell(index)).alias(index), *[F.nanvl(cell(c).try_cast("double"), F.lit(None).cast("double")).alias(c) for c in columns if c != index])
    year = F.year(index)
    return out.filter((year >= first if first is not None else F.lit(True)) & (year <= last if last is not None else F.lit(True)))


def agency_csv(spark: SparkSession, path: str, date_format: str = "dd/MM/yyyy") -> tuple[DataFrame, DataFrame]:
    """Agency lines ``date hour:00,station,parameter,value,unit`` to ``(rows, bad lines)``.

    Hours 1..24 become 0..23, empty values are dropped, the parameter picks the table. A text header
    line neither begins with a date nor has three commas; any other line that does not parse, or is
    cut short, goes to the second table.
    """
    lines = spark.read.text(path)
    p = F.split("value", ",")
    d = lines.filter((F.size(p) >= 4) | F.col("value").rlike(r"^\s*\d{1,2}/\d{1,2}/\d{2,4}")).select(
        F.col("value").alias("line"), F.split(p[0], " ")[0].alias("_d"), F.try_element_at(F.split(p[0], "[ :]"), F.lit(2)).alias("_h"),
        F.trim(F.get(p, F.lit(1))).alias("id_est"), names.param_table(F.get(p, F.lit(2))).alias("table"), F.trim(F.get(p, F.lit(3))).alias("_v"))
    hour = F.expr("try_cast(_h as int)") - 1
    day = F.try_to_timestamp("_d", F.lit(date_format)).cast("timestamp_ntz")
    d = d.withColumns({"fecha": clock.shift_hours(day, hour), "val": F.expr("try_cast(_v as double)")})
    keep = F.col("fecha").isNotNull() & F.col("table").isNotNull() & hour.between(0, 23) & F.col("_v").isNotNull()
    bad = ~F.coalesce(keep, F.lit(False)) | ((F.col("_v") != "") & F.col("val").isNull())
    rows = d.filter(~bad & (F.col("_v") != "")).select("fecha", "table", "id_est", "val")
    return rows, d.filter(bad).select("line")


def detect_date_format(lines: DataFrame, by: str = "path", column: str = "value") -> DataFrame:
    """DD/MM or MM/DD per file, by which of the two parts ever exceeds 12; null when neither does."""
    m = F.split(F.split(column, "[ ,]")[0], "/")
    a, b = F.expr("try_cast(_m[0] as int)"), F.expr("try_cast(_m[1] as int)")
    g = lines.withColumn("_m", m).filter(F.size("_m") >= 2).groupBy(by).agg(F.max(a).alias("_a"), F.max(b).alias("_b"))
    fmt = F.when(F.col("_a") > 12, "DD/MM/YYYY/HH24").when(F.col("_b") > 12, "MM/DD/YYYY/HH24")
    return g.select(by, fmt.alias("date_format"))


def forecast_lines(spark: SparkSession, folder: str, glob: str = "*.csv") -> DataFrame:
    """Prediction files below ``folder``, long: (path, ts, pollutant, station, target, pred).

    Files may have different columns, so each line is matched with the header of its own file:
    the header table has one row per file and is settled.
    """
    raw = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).text(folder).select(
        F.col("_metadata.file_path").alias("path"), "value")
    head = F.col("value").rlike("^,?timestamp,")
    headers = settle(raw.filter(head).groupBy("path").agg(F.min("value").alias("_h")), "headers")
    d = raw.filter(~head & (F.length("value") > 0)).join(headers, "path")
    cells = d.select("path", F.split("value", ",").alias("_v"), F.split("_h", ",").alias("_n"))
    cells = cells.withColumn("ts", clock.parse_mixed(F.try_element_at("_v", F.array_position("_n", F.lit("timestamp")).cast("int"))))
    long = cells.select("path", "ts", F.explode(F.arrays_zip(F.col("_n").alias("n"), F.col("_v").alias("v"))).alias("c"))
    n = F.col("c.n")
    long = long.filter(n.rlike("^(pred|target)_cont_")).select(
        "path", "ts", F.split(n, "_")[0].alias("kind"), names.series_pollutant(n).alias("pollutant"), names.series_station(n).alias("station"),
        F.expr("nanvl(try_cast(c.v as double), null)").alias("x"))
    return long.groupBy("path", "ts", "pollutant", "station").agg(
        F.max(F.when(F.col("kind") == "target", F.col("x"))).alias("target"), F.max(F.when(F.col("kind") == "pred", F.col("x"))).alias("pred"))


def forecast_csvs(spark: SparkSession, folder: str) -> DataFrame:
    """All models' horizon files ``<model>/<run>/..forecast_<h>.csv`` as one forecast table."""
    parts = F.split("path", "/")
    return forecast_lines(spark, folder).select(
        F.element_at(parts, -3).alias("model"), F.element_at(parts, -2).alias("run"),
        names.forecast_hour(F.col("path")).alias("predicted_hour"), "ts", "pollutant", "station", "target", "pred")


def logs(spark: SparkSession, folder: str) -> DataFrame:
    """One row per log file."""
    d = spark.read.option("recursiveFileLookup", True).text(folder, wholetext=True)
    return d.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("content")).to(
        spark.createDataFrame([], LOGS).schema)


def tables(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(t.name, t.tableType) for t in spark.catalog.listTables()], "name string, kind string")


def files(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """Path, size and time of files below a folder; the content column is never read."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(folder)
            .select("path", "length", "modificationTime"))


def keep_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Listed columns; one that is absent becomes a null double."""
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("double").alias(c) for c in columns])
