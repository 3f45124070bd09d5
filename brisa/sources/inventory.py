"""Reports over file listings ``(path, length, modificationTime)`` and run folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from brisa.functions import clock, names

SMALL_FILE = 0.3 * 1024 * 1024
# Old-layout file name and its coordinate companion.
OLD_FILE = r"a(\d{4})/salidas/wrfout_c1h_d01_(\d{4}-\d{2}-\d{2})_00:00:00\.a\d{4}"
OLD_COORDS = "%s/a%d/salidas/wrfout_c15d_d01_%d-01-01_00:00:00.a%d"


def wrf_files(listing: DataFrame, start, end, domain: str = "d02") -> DataFrame:
    """New layout ``year/month/wrfout_<domain>_<day>_00*`` with ``start <= day < end``."""
    p = names.wrf_parts(F.col("path"))
    d = listing.select("path", p["domain"].alias("domain"), F.try_to_timestamp(p["day"], F.lit("yyyy-MM-dd")).cast("timestamp_ntz").alias("day"),
                       p["hour"].alias("_h"))
    return d.filter((F.col("domain") == domain) & (F.col("_h") == "00")).filter(_in_range(start, end)).drop("_h")


def _in_range(start, end):
    return (F.col("day") >= F.lit(start).cast("timestamp_ntz")) & (F.col("day") < F.lit(end).cast("timestamp_ntz"))


def wrf_files_old(listing: DataFrame, start, end) -> DataFrame:
    """Old layout ``a<year>/salidas/...`` with the companion that holds the year's coordinates."""
    folder = F.regexp_extract("path", r"^(.*)/a\d{4}/salidas/", 1)
    year = F.nullif(F.regexp_extract("path", OLD_FILE, 1), F.lit("")).cast("int")
    d = listing.select("path", F.try_to_timestamp(F.regexp_extract("path", OLD_FILE, 2), F.lit("yyyy-MM-dd")).cast("timestamp_ntz").alias("day"),
                       F.format_string(OLD_COORDS, folder, year, year, year).alias("coords_path"))
    return d.filter(F.col("day").isNotNull()).filter(_in_range(start, end))


def gap_report(required: DataFrame, found: DataFrame) -> DataFrame:
    """Required days against day files (``day``, ``length``): present or missing.

    Two or more files below 0.3 MB mean a broken run: every day then counts as missing.
    """
    small = required.join(found, "day").select(F.count_if(F.col("length") < SMALL_FILE) >= 2).scalar()
    have = found.select("day", "length")
    d = required.join(have, "day", "left").withColumn("broken_run", small)
    ok = F.col("length").isNotNull() & ~F.col("broken_run")
    return d.withColumn("status", F.when(ok, "present").otherwise("missing"))


def removable(required: DataFrame, found: DataFrame) -> DataFrame:
    """Files of days that are not required any more (a report; nothing is removed)."""
    return found.join(required.select("day").distinct(), "day", "left_anti")


def latest_available(found: DataFrame, today, days_back: int = 7, default="2023-05-05") -> DataFrame:
    """Newest day with a file among the last ``days_back`` days, else the default; and the day-before fallback flag."""
    t = F.lit(today).cast("timestamp_ntz")
    ok = (F.col("day") <= t) & (F.col("day") > clock.shift_hours(t, -24 * days_back))
    best = F.max(F.when(ok, F.col("day")))
    return found.agg(F.coalesce(best, F.lit(default).cast("timestamp_ntz")).alias("day"), best.isNull().cast("int").alias("is_default"))


def with_fallback(required: DataFrame, found: DataFrame) -> DataFrame:
    """Each required day with the file day to use: its own, else the day before, else null."""
    have = found.select("day").distinct()
    own = have.select(F.col("day").alias("_own"))
    prev = have.select(F.col("day").alias("_prev"))
    d = required.join(own, F.col("day") == F.col("_own"), "left").join(prev, clock.shift_hours(F.col("day"), -24) == F.col("_prev"), "left")
    return d.select(*required.columns, F.coalesce("_own", "_prev").alias("use_day"))


def trained_runs(listing: DataFrame, marker: str = "model_best.pth") -> DataFrame:
    """Run folders ``<model>/<MMDD_HHMMSS>`` that hold the marker file."""
    parts = F.split("path", "/")
    d = listing.select(F.element_at(parts, -3).alias("model"), F.element_at(parts, -2).alias("run"), F.element_at(parts, -1).alias("_f"))
    return d.filter((F.col("_f") == marker) & F.col("run").rlike(f"^{names.RUN_NAME}")).select("model", "run").distinct()


def newest_first(listing: DataFrame) -> DataFrame:
    return listing.orderBy(F.col("modificationTime").desc())


# Texts that decide the status of a training log, first hit wins.
LOG_STATUS = [("Training completed successfully", "success"), ("Training timed out", "timeout"), ("Exception occurred", "exception")]


def log_status(logs: DataFrame) -> DataFrame:
    """Configuration (the file name without its last two parts, time and GPU), status, GPU, start and end of each training log."""
    c = F.col("content")
    status = None
    for text, name in LOG_STATUS:
        status = F.when(c.contains(text), name) if status is None else status.when(c.contains(text), name)

    def grab(pattern: str):
        return F.nullif(F.regexp_extract(c, pattern, 1), F.lit(""))

    gpu = F.coalesce(F.nullif(F.regexp_extract("path", r"gpu(\d+)", 1), F.lit("")), grab(r"GPU ID: (\d+)"))
    return logs.filter(~F.col("path").contains("training_summary_")).select(
        "path", F.regexp_extract("path", r"([^/]*)_[^_/]*_[^_/]*\.log$", 1).alias("config"), status.otherwise("failed").alias("status"), gpu.alias("gpu_id"),
        grab(r"Started at: ([^\n]+)").alias("started"), grab(r"Completed at: ([^\n]+)").alias("completed"))


def config_logs(status: DataFrame) -> DataFrame:
    """Per configuration: its logs in order of name, the status of the last one and how many succeeded."""
    return status.groupBy("config").agg(F.array_join(F.sort_array(F.collect_list("path")), ",").alias("log_files"), F.max_by("status", "path").alias("status"),
                                        F.count_if(F.col("status") == "success").alias("n_success"))


def log_summary(status: DataFrame) -> DataFrame:
    """Counts per status and the success rate in percent."""
    n = F.count(F.lit(1))
    s = F.col("status")
    return status.agg(n.alias("total"), *[F.count_if(s == x).alias(x) for x in ("success", "timeout", "exception", "failed")],
                      F.round(F.try_divide(F.count_if(s == "success") * 100.0, n), 1).alias("success_rate"))
