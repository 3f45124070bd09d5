"""Session set-up and the shared working folder.

Nothing here holds data on the driver. Small derived tables (parameters,
climatologies, axis bounds) are *settled*: written once to the shared folder and
read back, so that Catalyst plans with their true size and broadcasts them only
when they fall below ``spark.sql.autoBroadcastJoinThreshold``. Above it the same
join runs as a shuffle join under AQE.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # both sides of a join may stay partitioned by some of its keys where an operator asked for that
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # streaming state on disk instead of executor memory
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app: str = "brisa", master: str | None = None, shuffle_partitions: int | None = None,
                  driver_memory: str | None = None, **extra: str) -> SparkSession:
    b = SparkSession.builder.appName(app).config("spark.python.sql.dataFrameDebugging.enabled", "false")
    if master:
        b = b.master(master)
    for k, v in SESSION_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if driver_memory:
        b = b.config("spark.driver.memory", driver_memory)
    for k, v in extra.items():
        b = b.config(k, v)
    return prepare(b.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the runtime settings every operator relies on (UTC stamps, AQE)."""
    for k, v in SESSION_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder named by ``spark.checkpoint.dir``.

    Only a local master may run without that setting; it then gets a folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="brisa-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/brisa/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return the written table."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
