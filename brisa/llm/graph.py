"""Connected components of a link table by label propagation with shortcuts, on DataFrames only."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from brisa.session import settle


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component): the smallest id each linked id can reach. Ids without links are absent.

    Every round writes the star-shaped link table anew to the shared folder: each node points to the
    smallest neighbour it knows, and its larger neighbours are handed to that neighbour, until all
    point to a root. Links are pre-aggregated before each shuffle, and a hot node's neighbours are
    never gathered. Null ids and self-links are ignored; repeated links are one link.
    """
    e = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    e = settle(e, "links")
    size = None
    while True:
        # large star: the neighbours above u move to u's smallest neighbour
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        big = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star: the neighbours below u and u itself move to the smallest of them
        low = big.groupBy("u").agg(F.min("v").alias("m"))
        nxt = big.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).distinct()
        e = settle(nxt, "links")
        now = e.agg(F.count("*"), F.count_distinct("u"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == size or now[0] == 0:
            break
        size = now
    roots = e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)
