"""Writers and delivery tables.

Partitioned writes go through a rebalance hint: rows of one partition value sit together, and
AQE splits a value that is too large and joins small ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from brisa.session import settle

# Delivery id, constant text, station of the statistics rows, tables with a delivery id.
FORECAST_TYPE = 7
VAL_TEXT = "-1"
STATS_STATION = "NET"
TABLES_WITH_TYPE = ["nox", "pmdiez", "sodos"]
STAT_NAMES = {"min": "min", "max": "max", "mean": "avg"}
HOURS = range(1, 25)


def write_partitioned(df: DataFrame, path: str, by: Sequence[str], sort: Sequence[str] = (), mode: str = "errorifexists",
                      fmt: str = "parquet") -> None:
    d = df.hint("rebalance", *by)
    d = d.sortWithinPartitions(*by, *sort) if sort else d
    w = d.write.mode(mode).partitionBy(*by)
    (w.option("header", True) if fmt == "csv" else w).format(fmt).save(path)


def write_obs(obs: DataFrame, path: str, mode: str = "errorifexists") -> None:
    write_partitioned(obs.withColumn("year", F.year("fecha")), path, ["pollutant", "year"], ["id_est", "fecha"], mode)


def write_grid(wx: DataFrame, path: str, mode: str = "errorifexists") -> None:
    write_partitioned(wx.withColumns({"year": F.year("ts"), "month": F.month("ts")}), path, ["year", "month"], ["ts", "var"], mode)


def export_series(obs: DataFrame, path: str, fmt: str = "parquet") -> None:
    """One folder per (pollutant, station), ordered by time; an empty series has none."""
    write_partitioned(obs.filter(F.col("val").isNotNull()), path, ["pollutant", "id_est"], ["fecha"], fmt=fmt)


def export_by_year(df: DataFrame, path: str, ts: str = "fecha", fmt: str = "parquet") -> None:
    write_partitioned(df.withColumn("year", F.year(ts)), path, ["year"], [ts], fmt=fmt)


def export_by_horizon(fc: DataFrame, path: str, fmt: str = "parquet") -> None:
    write_partitioned(fc, path, ["predicted_hour"], ["ts"], fmt=fmt)


def snapshot(df: DataFrame, path: str) -> DataFrame:
    """Prepared table kept at ``path``: written when absent, read otherwise."""
    df.write.mode("ignore").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_params_once(params: DataFrame, path: str) -> DataFrame:
    """Parameter file: an existing one is kept and returned."""
    return snapshot(params.coalesce(1), path)


def save_columns(df: DataFrame, path: str) -> None:
    from brisa.operators.panel import column_list
    column_list(df).coalesce(1).write.mode("overwrite").json(path)


def copy_table(spark: SparkSession, source: str, target: str, by: Sequence[str] = (), mode: str = "append") -> None:
    """Store to store copy of a delivered table."""
    w = spark.read.parquet(source).write.mode(mode)
    (w.partitionBy(*by) if by else w).parquet(target)


def _hour_columns(prefix: str, cond: str = "true") -> list[Column]:
    return [F.expr(f"round(max(case when horizon = {h} and {cond} then value end), 2) as {prefix}hour_p{h:02d}") for h in HOURS]


def deliver_stations(fc: DataFrame, stations: Sequence[str], pollutant: str = "otres") -> DataFrame:
    """One row per origin and listed station with 24 hour columns; stations without values are skipped."""
    d = fc.filter((F.col("pollutant") == pollutant) & F.col("id_est").isin(list(stations)) & F.col("value").isNotNull())
    return d.groupBy(F.col("origin").alias("fecha"), "id_est").agg(*_hour_columns("")).select(
        "fecha", F.lit(FORECAST_TYPE).alias("id_tipo_pronostico"), "id_est", F.lit(VAL_TEXT).alias("val"), *[f"hour_p{h:02d}" for h in HOURS])


def skipped_stations(fc: DataFrame, stations: Sequence[str], pollutant: str = "otres") -> DataFrame:
    """Listed stations without any forecast."""
    want = fc.sparkSession.createDataFrame([(s,) for s in stations], "id_est string")
    return want.join(fc.filter((F.col("pollutant") == pollutant) & F.col("value").isNotNull()).select("id_est").distinct(), "id_est", "left_anti")


def deliver_stats(fc: DataFrame) -> DataFrame:
    """One row per origin, pollutant and statistic; only that statistic's 24 columns are filled.

    ``id_est`` of the input is min, max or mean; mean is delivered as avg.
    """
    cols = [c for s, n in STAT_NAMES.items() for c in _hour_columns(f"{n}_", f"id_est = '{s}'")]
    typ = F.when(F.col("pollutant").isin(TABLES_WITH_TYPE), F.lit(FORECAST_TYPE))
    d = fc.filter(F.col("id_est").isin(list(STAT_NAMES))).groupBy(F.col("origin").alias("fecha"), "pollutant", F.col("id_est").alias("stat")).agg(*cols)
    return d.withColumns({"id_est": F.lit(STATS_STATION), "val": F.lit(VAL_TEXT), "id_tipo_pronostico": typ,
                          "table": F.concat(F.lit("forecast_"), F.col("pollutant"))})


def upsert(existing: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Existing rows with those of ``new`` replacing rows of the same key."""
    return existing.join(new.select(*keys).distinct(), list(keys), "left_anti").unionByName(new, allowMissingColumns=True)


def patch_rows(existing: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Existing rows with the values of ``new`` over those of the same key; a null in ``new`` leaves the old value."""
    both = existing.withColumn("_new", F.lit(False)).unionByName(new.withColumn("_new", F.lit(True)), allowMissingColumns=True)
    rest = [c for c in new.columns if c not in keys]
    return both.groupBy(*keys).agg(*[F.coalesce(F.max(F.when(F.col("_new"), F.col(c))), F.max(F.when(~F.col("_new"), F.col(c)))).alias(c) for c in rest]).select(new.columns)


def upsert_table(spark: SparkSession, path: str, new: DataFrame, keys: Sequence[str], partition: str, patch: bool = False) -> None:
    """Upsert into a partitioned Parquet table, rewriting only the partitions ``new`` touches.

    With ``patch``, only the columns that are not null in ``new`` are replaced.
    """
    new = settle(new, "upsert")
    try:
        old = spark.read.parquet(path)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return write_partitioned(new, path, [partition])
    touched = old.join(new.select(partition).distinct(), partition, "left_semi")
    merged = settle((patch_rows if patch else upsert)(touched.select(new.columns), new, keys), "merged")
    merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)


def delete_from_year(df: DataFrame, year: int, ts: str = "fecha") -> DataFrame:
    """Rows before ``year``; ``year`` 0 clears the table."""
    return df.filter(F.year(ts) < year)


def swap_without_years(spark: SparkSession, path: str, target: str, year: int) -> None:
    """Copy of a year-partitioned table without ``year`` and later; later partitions are never read."""
    spark.read.parquet(path).filter(F.col("year") < year).write.mode("overwrite").partitionBy("year").parquet(target)
