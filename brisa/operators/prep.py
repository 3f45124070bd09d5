"""Splits, weighted draws and model input vectors."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from brisa.functions import clock
from brisa.operators import ranks
from brisa.operators.blocks import positions
from brisa.session import settle


def tail_split(df: DataFrame, share: float | int, order: Sequence[str], weights: str | None = None) -> DataFrame:
    """Last part in time becomes ``val``; a weight column is kept on ``train`` rows only.

    ``share`` is a fraction (rounded down) or a row count. The row at the cut is found by counting
    (:mod:`brisa.operators.ranks`); the table is neither sorted nor copied.
    """
    n = df.count()
    held = min(share if isinstance(share, int) else math.floor(n * share), n)
    d = ranks.split_at(df, order, n - held, "train", "val")
    return d.withColumn(weights, F.when(F.col("split") == "train", F.col(weights))) if weights else d


def uniform(seed: int, *cols: str) -> Column:
    """Number in [0, 1) fixed by the row's key and the seed, so lost tasks redraw the same."""
    return F.pmod(F.xxhash64(F.lit(seed), *cols), F.lit(1 << 52)) / float(1 << 52)


def random_split(df: DataFrame, ids: Sequence[str], val: float = 0.1, test: float = 0.1, seed: int = 42) -> DataFrame:
    """Exact random split: ``ceil`` sizes for val and test, the rest train.

    Rows are ranked by a hash of their id; the rank is summed up over hash ranges.
    """
    d = df.withColumn("_u", uniform(seed, *ids))
    d = positions(d, [], ["_u", *ids], F.floor(F.col("_u") * 65536), "_p", total="_n")
    n = F.col("_n")
    n_val, n_test = F.ceil(n * F.lit(val)), F.ceil(n * F.lit(test))
    p = F.col("_p")
    split = F.when(p <= n_val, "val").when(p <= n_val + n_test, "test").otherwise("train")
    return d.withColumn("split", split).drop("_u", "_p", "_n")


def event_weights(hours: DataFrame, events: DataFrame, repetition: int = 20) -> DataFrame:
    """Weight ``repetition`` on high-event hours, 1 otherwise. ``events`` has at most the hours of the panel."""
    hit = events.select("fecha").distinct().withColumn("_e", F.lit(1))
    return hours.join(hit, "fecha", "left").withColumn("weight", F.when(F.col("_e") == 1, repetition).otherwise(1)).drop("_e")


LEAF_ROWS, SPLIT_BITS = 4096, 10      # distinct rows a last range holds on average; a task splits a range into at most 2 ** 10


def _dealt(parents: DataFrame, children: DataFrame, seed: int, level: int) -> DataFrame:
    """(child, draws): the draws of every parent split among its children by weight, a chain of seeded binomial splits."""
    def split(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("child", kind="stable")
        w = pdf["w"].to_numpy(dtype=float)
        rng = np.random.default_rng([seed, level, int(pdf["parent"].iloc[0]) % (1 << 63)])
        got = rng.multinomial(int(pdf["draws"].iloc[0]), w / w.sum())
        return pd.DataFrame({"child": pdf["child"], "draws": got})[got > 0]

    return children.join(parents, "parent").groupBy("parent").applyInPandas(split, "child bigint, draws bigint")


def weighted_resample(df: DataFrame, weight: str = "weight", seed: int = 42) -> DataFrame:
    """As many draws with replacement as rows, with probability weight / total; ``draw`` numbers the draws of a row.

    The rows' keys are a hash, so its ranges are even whatever the weights. The number of draws goes
    down a tree of ranges: each range's draws are split among its parts by seeded binomial splits until
    a range holds a few thousand rows, which are then drawn among. No task sees more than the parts of
    one range, no prefix sum runs over the table, and a lost task draws the same again. Rows that are
    equal in all columns are one with their joint weight; rows without a positive weight are never drawn.
    """
    cols = [F.col(f"`{c}`") for c in df.columns]
    parts = [x for c in cols for x in (c, c.isNull())]
    rows = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n")).withColumn("_w", F.col(f"`{weight}`").cast("double") * F.col("_n"))
    n = df.count()
    depth = max(0, math.ceil(math.log2(max(n, 1) / LEAF_ROWS)))
    leaf = F.shiftrightunsigned(F.xxhash64(*parts), 64 - depth) if depth else F.lit(0).cast("bigint")
    rows = settle(rows.filter(F.col("_w") > 0).withColumns({"_leaf": leaf, "_id": F.xxhash64(F.lit(seed), *parts)}), "weighted-rows")
    weights = settle(rows.groupBy("_leaf").agg(F.sum("_w").alias("w")), "range-weights")
    draws = df.sparkSession.createDataFrame([(0, n)], "parent bigint, draws bigint")
    for at in range(0, depth, SPLIT_BITS):
        to = min(at + SPLIT_BITS, depth)
        children = weights.groupBy(F.shiftright("_leaf", depth - to).alias("child")).agg(F.sum("w").alias("w")).withColumn("parent", F.shiftright("child", to - at))
        draws = settle(_dealt(draws, children, seed, at), "range-draws").withColumnRenamed("child", "parent")
    last = rows.select(F.col("_leaf").alias("parent"), F.col("_id").alias("child"), F.col("_w").alias("w"))
    drawn = settle(_dealt(draws, last, seed, depth), "draws").select(F.col("child").alias("_id"), "draws")
    return rows.join(drawn, "_id").select(*cols, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("draws"))).alias("draw"))


def sampling_info(weighted: DataFrame, threshold: float, repetition: int) -> DataFrame:
    w = F.col("weight")
    return weighted.agg(F.count(F.lit(1)).alias("total_samples"), F.count_if(w > 1).alias("high_events"),
                        F.min(w).alias("min_weight"), F.max(w).alias("max_weight"), F.sum(w).alias("total_weight")).withColumns(
        {"threshold": F.lit(threshold), "repetition": F.lit(repetition)})


def model_columns(stations: Sequence[str], others: Sequence[str], keep: str = "otres") -> list[str]:
    """Column order of a model input: kept stations, 12 time columns, mean/min/max of the others."""
    return ([f"cont_{keep}_{s}" for s in stations] + clock.time_names()
            + [f"cont_{p}_{a}" for p in others for a in ("mean", "min", "max")])


def model_vector(stats_long: DataFrame, stations: Sequence[str], others: Sequence[str], keep: str = "otres",
                 flip_order: bool = False) -> DataFrame:
    """``(fecha, vector)`` in :func:`model_columns` order from the long hourly statistics; nulls become 0."""
    series = [(keep, s) for s in stations] + [(p, a) for p in others for a in ("mean", "min", "max")]
    wide = stats_long.groupBy("fecha").agg(*[
        F.expr(f"coalesce(max(case when pollutant = '{p}' and id_est = '{s}' then val end), 0.0D) as `cont_{p}_{s}`") for p, s in series])
    wide = wide.withColumns(clock.time_features(F.col("fecha"), flip_order))
    return wide.select("fecha", F.array(*model_columns(stations, others, keep)).alias("vector"))
