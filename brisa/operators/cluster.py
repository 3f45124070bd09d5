"""Station profiles on the climatology calendar: standardising, k-means, distance to the mean profile."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from brisa.session import settle

KEY = ["month", "day", "hour"]


def standardized(clim: DataFrame) -> DataFrame:
    """Per calendar hour: missing stations get the hour's mean, then population standardising.

    A filled station lies on the mean (z = 0) and narrows the deviation; an hour nobody
    reports or without spread is 0 for all.
    """
    good = F.when(~F.isnan("val") & (F.abs("val") != float("inf")), F.col("val"))
    d = clim.withColumn("val", good)
    per = d.groupBy("pollutant", *KEY).agg(F.avg("val").alias("_m"), F.count("val").alias("_v"), F.count(F.lit(1)).alias("_n"), F.var_pop("val").alias("_s2"))
    sd = F.sqrt(F.col("_s2") * F.col("_v") / F.col("_n"))
    z = F.when(sd > 0, (F.coalesce("val", "_m") - F.col("_m")) / sd).otherwise(0.0)
    return d.join(per, ["pollutant", *KEY]).select("pollutant", "id_est", *KEY, F.coalesce(z, F.lit(0.0)).alias("z"))


def _nearest(z: DataFrame, centers: DataFrame) -> DataFrame:
    """``(pollutant, id_est, cluster)``: the nearest center of each profile, ties to the lower cluster.

    Distances are rounded to 12 digits, so that the order in which a sum is taken decides no tie.
    """
    gap = F.col("z") - F.col("c")
    far = z.join(centers, ["pollutant", *KEY]).groupBy("pollutant", "id_est", "cluster").agg(F.round(F.sum(gap * gap), 12).alias("_d"))
    return far.groupBy("pollutant", "id_est").agg(F.min_by("cluster", F.struct("_d", "cluster")).alias("cluster"))


def centers_of(z: DataFrame, assigned: DataFrame) -> DataFrame:
    return z.join(assigned, ["pollutant", "id_est"]).groupBy("pollutant", "cluster", *KEY).agg(F.avg("z").alias("c"))


def clusters(clim: DataFrame, k: int = 3) -> DataFrame:
    """``(pollutant, id_est, cluster)``: k-means of the standardised profiles, each pollutant by itself.

    Lloyd's steps as grouped aggregates from a fixed start: the stations at even ranks of distance
    from the mean profile. They go on until no station changes its cluster, which one count a step
    tells. Ties go to the lower cluster; a cluster that loses all stations ends. The result depends
    on neither partitions nor a seed.
    """
    z = settle(standardized(clim), "profiles")
    d = z.groupBy("pollutant", "id_est").agg(F.sum(F.col("z") * F.col("z")).alias("_d"))
    by = Window.partitionBy("pollutant")
    d = d.select("pollutant", "id_est", (F.row_number().over(by.orderBy("_d", "id_est")) - 1).alias("_r"), F.count(F.lit(1)).over(by).alias("_n"))
    start = d.withColumn("cluster", F.explode(F.sequence(F.lit(0), F.lit(k - 1)))).filter(F.col("_r") == F.floor(F.col("cluster") * (F.col("_n") - 1) / max(k - 1, 1)))
    centers = z.join(start.select("pollutant", "id_est", "cluster"), ["pollutant", "id_est"]).select("pollutant", "cluster", *KEY, F.col("z").alias("c"))
    assigned = None
    while True:
        now = settle(_nearest(z, settle(centers, "centers")), "assigned")
        if assigned is not None and now.exceptAll(assigned).isEmpty():
            return now
        assigned, centers = now, centers_of(z, now)


def cluster_sizes(assigned: DataFrame) -> DataFrame:
    return assigned.groupBy("pollutant", "cluster").agg(F.count(F.lit(1)).alias("stations"))


def cluster_profiles(clim: DataFrame, assigned: DataFrame) -> DataFrame:
    """Mean profile of each cluster."""
    return clim.join(assigned, ["pollutant", "id_est"]).groupBy("pollutant", "cluster", *KEY).agg(F.avg("val").alias("val"))


def distance_to_mean(clim: DataFrame) -> DataFrame:
    """Euclidean length of each station's standardised profile, i.e. its distance from the mean station."""
    return standardized(clim).groupBy("pollutant", "id_est").agg(F.sqrt(F.sum(F.col("z") * F.col("z"))).alias("distance"))
