"""File manifests: first and last time, hours and variables of every file of a grid table.

Scans, required days and gaps are answered from this table of one row per file and variable, before a file is opened.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from brisa.functions import clock


def build(spark: SparkSession, folder: str, ts: str = "ts", var: str = "var") -> DataFrame:
    """(path, var, first, last, hours) of all files below ``folder``; only these two columns are read.

    ``hours`` lists the hours a file has of a variable; a file lies in one month's partition, so they are 744 at most.
    """
    d = spark.read.parquet(folder).select(F.col("_metadata.file_path").alias("path"), F.col(var).alias("var"), F.col(ts).alias("ts"))
    once = d.groupBy("path", "var", clock.hour_index(F.col("ts")).alias("h")).agg(F.min("ts").alias("first"), F.max("ts").alias("last"))
    return once.groupBy("path", "var").agg(F.min("first").alias("first"), F.max("last").alias("last"), F.sort_array(F.collect_set("h")).alias("hours"))


def files(manifest: DataFrame, start=None, end=None, variables: Sequence[str] | None = None) -> list[str]:
    """Paths of the files that can hold rows with ``start <= ts < end`` of the listed variables."""
    d = manifest
    if start is not None:
        d = d.filter(F.col("last") >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        d = d.filter(F.col("first") < F.lit(end).cast("timestamp_ntz"))
    if variables is not None:
        d = d.filter(F.col("var").isin(list(variables)))
    return sorted(r[0] for r in d.select("path").distinct().collect())


def scan(spark: SparkSession, folder: str, manifest: DataFrame, start=None, end=None, variables: Sequence[str] | None = None) -> DataFrame:
    """Rows of the table below ``folder`` in a time range, read from the files that count only.

    Path names come to the driver, as they do for any scan; rows are still filtered by time.
    """
    paths = files(manifest, start, end, variables)
    schema = spark.read.parquet(folder).schema
    d = spark.read.schema(schema).option("basePath", folder).parquet(*paths) if paths else spark.createDataFrame([], schema)
    if start is not None:
        d = d.filter(F.col("ts") >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        d = d.filter(F.col("ts") < F.lit(end).cast("timestamp_ntz"))
    return d.filter(F.col("var").isin(list(variables))) if variables is not None else d


def days(manifest: DataFrame, hours: int = 1) -> DataFrame:
    """(day): day indices for which the files have at least ``hours`` hours of every variable they hold."""
    d = manifest.select("var", F.explode("hours").alias("h")).distinct()
    per = d.groupBy(F.floor(F.col("h") / 24).alias("day"), "var").agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy("day").agg(F.min("n").alias("n")).filter(F.col("n") >= hours).select("day")
