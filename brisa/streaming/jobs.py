"""Structured Streaming twins of the hourly jobs.

Each job is a transformation of a streaming DataFrame; :func:`run_available` drives it with the
availableNow trigger, so the same code serves a continuous run and an hourly schedule. Windows are
Spark's own, with a watermark; jobs that look back keep tables of hours in the shared folder.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from brisa.functions import clock
from brisa.operators import impute, panel, windows
from brisa.session import settle
from brisa.sources import sinks


def file_stream(spark: SparkSession, folder: str, schema, glob: str = "*.parquet", files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def run_available(df: DataFrame, path: str, checkpoint: str, partition: Sequence[str] = ()) -> DataFrame:
    """Process what is there, append it as Parquet, and return the table written so far."""
    w = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    w = w.partitionBy(*partition) if partition else w
    w.trigger(availableNow=True).start().awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ingest(stream: DataFrame, keys: Sequence[str], ts: str, delay: str = "6 hours") -> DataFrame:
    """First arrival of every key; later copies and rows older than the watermark are dropped."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def late_rows(raw: DataFrame, ingested: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Correction table: raw rows whose key never made it through the watermark."""
    return raw.join(ingested.select(*keys), list(keys), "left_anti")


def hourly_stats(stream: DataFrame, by: Sequence[str], ts: str, value: str, delay: str = "6 hours") -> DataFrame:
    """Tumbling one-hour statistics per key."""
    g = stream.withWatermark(ts, delay).groupBy(F.window(ts, "1 hour").alias("w"), *by)
    return g.agg(F.count(value).alias("n"), F.avg(value).alias("mean"), F.min(value).alias("min"), F.max(value).alias("max")).select(
        F.col("w.start").alias("hour"), *by, "n", "mean", "min", "max")


def sliding_max(stream: DataFrame, by: Sequence[str], ts: str, value: str, length: str = "24 hours", slide: str = "1 hour",
                delay: str = "6 hours") -> DataFrame:
    g = stream.withWatermark(ts, delay).groupBy(F.window(ts, length, slide).alias("w"), *by)
    return g.agg(F.max(value).alias("max")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *by, "max")


def high_sessions(stream: DataFrame, by: Sequence[str], ts: str, value: str, threshold: float, gap: str = "1 hour",
                  delay: str = "6 hours") -> DataFrame:
    """Sessions of readings above a threshold that follow each other within ``gap``."""
    d = stream.filter(F.col(value) > threshold).withWatermark(ts, delay)
    g = d.groupBy(F.session_window(ts, gap).alias("w"), *by)
    return g.agg(F.count(value).alias("n"), F.max(value).alias("top")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *by, "n", "top")


PART_HOURS = 744     # hours in one partition of a table of readings or results


def _part(h: Column) -> Column:
    return F.floor(h / PART_HOURS)


def _table(spark: SparkSession, path: str, schema) -> DataFrame:
    """The table at ``path``, or an empty one before the first batch."""
    try:
        return spark.read.schema(schema).parquet(path)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def _parts(df: DataFrame, first: Column, last: Column) -> list[int]:
    """Partitions from ``first`` to ``last`` of every row: one number per month of data touched, so a list for a scan's filter."""
    return [r[0] for r in df.select(F.explode(F.sequence(_part(first), _part(last))).alias("p")).distinct().collect()]


def _calendar(touched: DataFrame, lo: Column, hi: Column) -> DataFrame:
    """``touched`` (series, lo, …) with every hour between two columns."""
    n = int(touched.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = touched.select("*", F.explode(F.sequence(_part(lo), _part(hi))).alias("_b")).repartition(n, *panel.SERIES, "_b")
    first = F.col("_b") * PART_HOURS
    return blocks.withColumn("h", F.explode(F.sequence(F.greatest(lo, first), F.least(hi, first + PART_HOURS - 1)))).drop("_b")


def _each_batch(stream: DataFrame, checkpoint: str, write: Callable[[DataFrame, int], None], mode: str = "append") -> None:
    stream.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


READING = "pollutant string, id_est string, h bigint, k string, val double, part bigint"
TAIL = "pollutant string, id_est string, top bigint, part bigint"


def _keep_current(stream: DataFrame, path: str, checkpoint: str, schema: str, make: Callable[[DataFrame, DataFrame, DataFrame], DataFrame], before: int, after: int | None) -> DataFrame:
    """Drives a job whose results are kept in step with all readings seen so far, in whatever order they come.

    Each micro-batch is merged into the table of readings, one row for each reading's own key ``k``, so
    a replay adds nothing and several readings of an hour count as their mean, whichever batch brings
    them. ``make(readings, results, touched)`` then gives the results of the hours that it can change, and
    they replace the old ones. ``touched`` has the first and the last new hour of each series and
    partition; only partitions from ``before`` hours ahead of a touched hour to ``after`` hours behind it
    are read. A late reading thereby corrects what was given out before. With ``after`` None a reading
    can change all that follows: ``touched`` then has one row a series and begins no later than the hour
    after the series' last result, which a table of one row for each series holds.
    """
    readings, results, tails = f"{path}/readings", f"{path}/results", f"{path}/tails"

    def write(batch: DataFrame, _id: int) -> None:
        spark = batch.sparkSession
        new = batch.filter(F.col("val").isNotNull()).select(*panel.SERIES, "h", F.col("k").cast("string").alias("k"), "val")
        new = settle(new.groupBy(*panel.SERIES, "h", "k").agg(F.max("val").alias("val")).withColumn("part", _part(F.col("h"))), "batch")
        touched = new.groupBy(*panel.SERIES, "part").agg(F.min("h").alias("lo"), F.max("h").alias("hi"))
        if after is None:
            last = _table(spark, tails, TAIL).select(*panel.SERIES, (F.col("top") + 1).alias("_next"))
            touched = touched.groupBy(*panel.SERIES).agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).join(last, panel.SERIES, "left").withColumn("lo", F.least("lo", "_next")).drop("_next")
        touched = settle(touched, "touched")
        parts = _parts(touched, F.col("lo") - before, F.col("hi") + (after or 0))
        if not parts:
            return
        sinks.upsert_table(spark, readings, new, [*panel.SERIES, "h", "k"], "part")
        near = F.col("part").isin(parts) if after is not None else F.col("part") >= min(parts)
        hourly = _table(spark, readings, READING).filter(near).groupBy(*panel.SERIES, "h").agg(F.avg("val").alias("val"))
        out = make(hourly, _table(spark, results, schema + ", part bigint").filter(near), touched.drop("part"))
        if after is None:
            out = settle(out, "results")
        sinks.upsert_table(spark, results, out.withColumn("part", _part(F.col("h"))), [*panel.SERIES, "h"], "part")
        if after is None:
            sinks.upsert_table(spark, tails, out.groupBy(*panel.SERIES).agg(F.max("h").alias("top"), F.lit(0).cast("bigint").alias("part")), panel.SERIES, "part")

    _each_batch(stream, checkpoint, write)
    return _table(stream.sparkSession, results, schema + ", part bigint").drop("part")


NOWCAST_OUT = "pollutant string, id_est string, h bigint, nowcast double"


def nowcast(stream: DataFrame, path: str, checkpoint: str, pollutant: str = "PM10", hours: int = 12) -> DataFrame:
    """Weighted mean of the last ``hours`` hours for every hour with a reading ``(pollutant, id_est, h, k, val)``.

    A reading changes its own hour and the ``hours - 1`` after it.
    """
    reach = hours - 1

    def make(hourly: DataFrame, _results: DataFrame, touched: DataFrame) -> DataFrame:
        cal = _calendar(touched, F.col("lo") - reach, F.col("hi") + reach).groupBy(*panel.SERIES, "h").agg(F.max(F.col("h") >= F.col("lo")).alias("_own"))
        done = windows.nowcast12(cal.join(hourly, [*panel.SERIES, "h"], "left"), pollutant, hours)
        return done.filter(F.col("val").isNotNull() & F.col("_own")).select(*panel.SERIES, "h", "nowcast")

    return _keep_current(stream, path, checkpoint, NOWCAST_OUT, make, reach, reach)


FILL_OUT = "pollutant string, id_est string, h bigint, val double, flag string"


def persistence(stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Hours with readings as they are, and the hours up to a series' last one filled with the last value at the same hour of day.

    A reading can change all later hours of its series; what lies before is taken from the 24 results
    ahead of it, which hold the last value of every hour of day.
    """
    def make(hourly: DataFrame, results: DataFrame, touched: DataFrame) -> DataFrame:
        mine = hourly.join(touched.select(*panel.SERIES, "lo"), panel.SERIES).filter(F.col("h") >= F.col("lo")).drop("lo")
        span = touched.join(mine.groupBy(*panel.SERIES).agg(F.max("h").alias("top")), panel.SERIES)
        before = results.join(touched.select(*panel.SERIES, "lo"), panel.SERIES).filter(F.col("h").between(F.col("lo") - 24, F.col("lo") - 1))
        known = mine.unionByName(before.select(mine.columns))
        full = _calendar(span, F.col("lo") - 24, F.col("top")).join(known, [*panel.SERIES, "h"], "left")
        done = impute.fill_persistence_chain(impute.start_flags(full))
        return done.filter((F.col("h") >= F.col("lo")) & F.col("val").isNotNull()).select(*panel.SERIES, "h", "val", "flag")

    return _keep_current(stream, path, checkpoint, FILL_OUT, make, 24, None)


def _hour(ts: Column) -> Column:
    return F.floor(F.unix_seconds(ts) / 3600)


def keep_windows(stream: DataFrame, path: str, checkpoint: str, job: Callable[[DataFrame], DataFrame], key: str, ts: str, by: Sequence[str], length: int) -> DataFrame:
    """Results of a tumbling or sliding window job over all readings so far, late ones included.

    A batch is merged into the table of readings by their ``key``; the windows it falls into are worked
    out anew from the readings of their hours and laid over what was given out. ``job`` is the job as it
    runs on a stream; its windows start at ``start`` or ``hour`` and are ``length`` hours long. State is
    the table alone, so nothing is dropped and any order and split gives the same.
    """
    readings, results = f"{path}/readings", f"{path}/results"
    schema = stream.withColumn("part", F.lit(0).cast("bigint")).schema

    def write(batch: DataFrame, _id: int) -> None:
        spark = batch.sparkSession
        new = settle(batch.dropDuplicates([key]).withColumn("part", _part(_hour(F.col(ts)))), "batch")
        given = job(new.drop("part"))
        start = next(c for c in ("start", "hour") if c in given.columns)
        touched = settle(given.select(start, *by).distinct(), "touched")
        h = _hour(F.col(start))
        parts = _parts(touched.select(start).distinct(), h, h + length - 1)
        if not parts:
            return
        sinks.upsert_table(spark, readings, new, [key], "part")
        near = _table(spark, readings, schema).filter(F.col("part").isin(parts)).drop("part")
        # a series that the batch does not have is not worked out again
        again = job(near.join(touched.select(*by).distinct(), list(by), "left_semi")).join(touched, [start, *by], "left_semi")
        sinks.upsert_table(spark, results, again.withColumn("part", _part(_hour(F.col(start)))), [start, *by], "part")

    _each_batch(stream, checkpoint, write)
    return stream.sparkSession.read.parquet(results).drop("part")


def keep_sessions(stream: DataFrame, path: str, checkpoint: str, job: Callable[[DataFrame], DataFrame], key: str, ts: str, by: Sequence[str], gap: str = "1 hour") -> DataFrame:
    """Results of a session job over all readings so far; a late reading may lengthen a session or join two.

    The sessions given out that a new reading touches are taken back and made again from their readings
    and the new ones. A session taken back stays as a row that is not ``live`` until its partition is
    written again, because a partition left without rows would keep its old file.
    """
    readings, results = f"{path}/readings", f"{path}/results"
    schema = stream.withColumn("part", F.lit(0).cast("bigint")).schema
    pause = F.expr(f"interval {gap}")

    def write(batch: DataFrame, _id: int) -> None:
        spark = batch.sparkSession
        new = settle(batch.dropDuplicates([key]).withColumn("part", _part(_hour(F.col(ts)))), "batch")
        fresh = settle(job(new.drop("part")), "fresh")
        if fresh.isEmpty():
            sinks.upsert_table(spark, readings, new, [key], "part")
            return
        shape = fresh.withColumns({"live": F.lit(True), "part": F.lit(0).cast("bigint")}).schema
        sinks.upsert_table(spark, readings, new, [key], "part")
        given = _table(spark, results, shape).filter("live")
        # sessions that share a block of hours with a fresh one, and then those that meet it
        blocks = lambda lo, hi: F.explode(F.sequence(F.floor(_hour(lo) / 24), F.floor(_hour(hi) / 24)))
        f = fresh.select(*by, F.col("start").alias("_a"), F.col("end").alias("_z")).withColumn("_b", blocks(F.col("_a"), F.col("_z")))
        met = given.withColumn("_b", blocks(F.col("start"), F.col("end"))).join(f, [*by, "_b"])
        old = settle(met.filter((F.col("start") <= F.col("_z")) & (F.col("end") >= F.col("_a"))).select(given.columns).distinct(), "met")
        reach = old.select(*by, "start", "end").unionByName(fresh.select(*by, "start", "end"))
        parts = _parts(reach.select("start", "end").distinct(), _hour(F.col("start")), _hour(F.col("end")))
        near = _table(spark, readings, schema).filter(F.col("part").isin(parts)).drop("part").withColumn("_b", F.floor(_hour(F.col(ts)) / 24))
        inside = near.join(reach.select(*by, "start", "end", blocks(F.col("start"), F.col("end")).alias("_b")), [*by, "_b"])
        mine = inside.filter((F.col(ts) >= F.col("start")) & (F.col(ts) <= F.col("end") - pause)).dropDuplicates([key]).select(batch.columns)
        again = job(mine).withColumns({"live": F.lit(True), "part": _part(_hour(F.col("start")))})
        gone = old.join(again.select(*by, "start"), [*by, "start"], "left_anti").withColumn("live", F.lit(False))
        sinks.upsert_table(spark, results, again.unionByName(gone), [*by, "start"], "part")

    _each_batch(stream, checkpoint, write)
    return stream.sparkSession.read.parquet(results).filter("live").drop("live", "part")


def deliver(stream: DataFrame, make: Callable[[DataFrame], DataFrame], path: str, checkpoint: str, keys: Sequence[str], partition: str) -> DataFrame:
    """Every micro-batch becomes delivery rows that are laid over rows of the same key.

    A column that the batch does not have keeps what was delivered before. A batch that is replayed
    after a failure writes the same rows again, so delivery is idempotent.
    """
    def write(batch: DataFrame, _id: int) -> None:
        sinks.upsert_table(batch.sparkSession, path, make(batch), keys, partition, patch=True)

    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.read.parquet(path)


def with_open(done: DataFrame, raw: DataFrame, job: Callable[[DataFrame], DataFrame], ts: str, end: Column, reach: str, delay: str = "6 hours") -> DataFrame:
    """``done``, the windows a job has given out, and those that a run leaves open because the watermark has not passed their ``end``.

    The job itself, run over the readings less than ``reach`` before the watermark, makes the open ones.
    """
    mark = raw.select((F.max(ts) - F.expr(f"interval {delay}")).alias("m")).scalar()
    late = job(raw.filter(F.col(ts) > mark - F.expr(f"interval {reach}")))
    return done.unionByName(late.filter(end > mark))


def open_sessions(done: DataFrame, raw: DataFrame, job: Callable[[DataFrame], DataFrame], by: Sequence[str], ts: str) -> DataFrame:
    """``done`` and the sessions still open: those made of readings after the last session given out for their key."""
    last = done.groupBy(*by).agg(F.max("end").alias("_last"))
    rest = raw.join(last, list(by), "left").filter(F.col("_last").isNull() | (F.col(ts) >= F.col("_last"))).drop("_last")
    return done.unionByName(job(rest))


def with_hour(obs: DataFrame, key: str | None = None) -> DataFrame:
    """``(pollutant, id_est, h, k, val)`` of an observation stream or table; a reading's own key is ``key``, else its time."""
    k = F.col(key) if key else F.unix_micros(F.col("fecha").cast("timestamp"))
    return obs.select("pollutant", "id_est", clock.hour_index(F.col("fecha")).alias("h"), k.cast("string").alias("k"), "val")
