"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from brisa.llm.common import fresh, row_hash
from brisa.session import settle

UNIT = 1 << 24          # expected copies are whole multiples of 1/UNIT, so that their sums are exact
SIZE_STEP, SIZE_BUCKETS, SPREAD = 32, 1024, 256


def word_count(text: str | Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: list[int], share: float, cap: float) -> DataFrame:
    """(source, source_size, target) from (source, size): ``share`` of all sizes, dealt by weight under a cap.

    Sources in order of code point, null last, weigh ``weights`` in turn. No target goes over ``cap``
    times its source's size; what is over is dealt again by weight. That is the water level at which
    min(cap, level * weight) fills the total, found from prefix sums over the sources ordered by
    cap / weight. One row per source; the sum over documents is aggregated before the shuffle.
    """
    one = W.partitionBy(F.lit(0))
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(one.orderBy(F.col("source").asc_nulls_last())) - 1
    per = per.select("source", "source_size", F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int")).alias("w"),
                     (F.sum("source_size").over(one) * share).alias("total"))
    per = per.withColumn("most", F.col("source_size") * cap)
    by = one.orderBy(F.col("most") / F.col("w"), F.col("source").asc_nulls_last())
    per = per.select("*", (F.sum("most").over(by.rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("most")).alias("before"),
                     F.sum("w").over(by.rowsBetween(W.currentRow, W.unboundedFollowing)).alias("w_left"))
    per = per.withColumn("level", (F.col("total") - F.col("before")) / F.col("w_left"))
    # the first source whose own cap lies above the level sets the level for it and all after it
    per = per.withColumn("water", F.min(F.when(F.col("level") * F.col("w") <= F.col("most"), F.struct(F.col("most") / F.col("w"), "level"))).over(one)["level"])
    return per.select("source", "source_size", F.least(F.col("most"), F.coalesce(F.col("water") * F.col("w"), F.col("most"))).alias("target"))


def _hex(c: Column, digits: int) -> Column:
    return F.conv(F.substring(F.md5(F.coalesce(c.cast("string"), F.lit(""))), 1, digits), 16, 10).cast("long")


def sample_copies(sizes: DataFrame, plan: DataFrame, key: str = "doc_id", more: Sequence[str] = ()) -> DataFrame:
    """(key, source, size, source_size, target, copies, more): how often the mix takes each document.

    The expected copies of a document, target / source_size, are laid end to end within its source;
    one offset is added and a copy is taken for every whole number crossed. Documents lie in order of
    size (in steps), so each stretch of the line sees all sizes alike and the words taken stay close
    to the target. The prefix sum is exact in whole units and has two levels: totals of the buckets
    (size step, hash of key), then a sum inside each bucket, so a hot source is spread over at most
    262,144 buckets. Equal keys are separate rows, in order of size and of the ``more`` columns; null
    keys and null sources are ordinary values.
    """
    at = ["source", "step", "h"]
    rows = (sizes.join(plan.withColumnRenamed("source", "p_source"), F.col("source").eqNullSafe(F.col("p_source"))).drop("p_source")
            .withColumn("e", F.when(F.col("source_size") > 0, F.round(F.col("target") / F.col("source_size") * UNIT)).otherwise(0).cast("long"))
            .withColumn("step", F.least(F.expr(f"size div {SIZE_STEP}"), F.lit(SIZE_BUCKETS - 1)))
            .withColumn("h", _hex(F.col(key), 2)))
    tot = rows.groupBy(*at).agg(F.sum("e").alias("t"))
    by = W.partitionBy("source").orderBy("step", "h").rowsBetween(W.unboundedPreceding, W.currentRow)
    tot = tot.select(F.col("source").alias("b_source"), F.col("step").alias("b_step"), F.col("h").alias("b_h"),
                     (F.sum("t").over(by) - F.col("t") + _hex(F.col("source"), 6)).alias("base"))
    inside = W.partitionBy(*at).orderBy(key, "size", *more).rowsBetween(W.unboundedPreceding, W.currentRow)
    rows = rows.withColumn("upto", F.sum("e").over(inside))
    rows = rows.join(tot, F.col("source").eqNullSafe(F.col("b_source")) & (F.col("step") == F.col("b_step")) & (F.col("h") == F.col("b_h")))
    end = F.col("base") + F.col("upto")
    return rows.select(key, "source", "size", "source_size", "target",
                       F.expr(f"(base + upto) div {UNIT} - (base + upto - e) div {UNIT}").alias("copies"), *more)


def mix_documents(docs: DataFrame, weights: list[int] | None = None, share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """``docs`` with every row repeated as often as the mix takes it (not at all where that is 0); ``copy`` numbers the copies.

    Sizes are counted once and settled. Rows are told apart by a hash of all their columns, so copies
    belong to the text they were drawn for, whatever ids and sources are null or repeated; rows equal in
    everything are one with their joint copies. Null and empty texts have size 0 and are not taken, nor
    are sources without a word; an empty table gives an empty one. Any column names may occur; a column
    ``copy`` is replaced.
    """
    row = fresh("row", docs)
    keyed = docs.withColumn(row, row_hash(docs))
    sizes = settle(keyed.select("doc_id", "source", word_count("text").alias("size"), F.col(row).alias("_row")), "sizes")
    n = sample_copies(sizes, targets(sizes, weights or [3, 1, 2], share, cap), more=["_row"])
    n = n.groupBy("_row").agg(F.sum("copies").cast("int").alias("_copies"), F.count(F.lit(1)).alias("_equal")).where("_copies > 0")
    n = settle(n.withColumnRenamed("_row", row), "copies")
    one = keyed.join(n.where("_equal = 1").select(row, F.col("_copies").alias(row + "n")), row)
    some = keyed.join(n.where("_equal > 1").select(row, F.col("_copies").alias(row + "n")), row).dropDuplicates([row])
    each = F.explode(F.sequence(F.lit(1), F.col(row + "n"))).alias("copy")
    return one.unionByName(some).select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() != "copy"], each)
