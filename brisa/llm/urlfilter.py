"""URL filters by a temporal list join: what a list said at the time of each fetch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from brisa.session import settle

BUCKET_DAYS = 32
_SCHEME = r"^[A-Za-z][A-Za-z0-9+.\-]*://"


def host(url: str) -> Column:
    """Lower-cased host without user, port or a dot at the end; empty where there is none."""
    return F.regexp_replace(F.lower(F.regexp_extract(url, _SCHEME + r"(?:[^/?#@]*@)?([^/?#:]*)", 1)), r"\.+$", "")


def first_folder(url: str) -> Column:
    """The first path segment, empty for the root."""
    return F.regexp_extract(url, _SCHEME + r"[^/?#]*/([^/?#]*)", 1)


def lookup_keys(url: str) -> Column:
    """What a URL is looked up by: (kind, value, rank), the most specific with the highest rank.

    ``prefix``: host and first folder, ``host``, and ``domain``: each ending of the host with at least two labels.
    """
    h, p = host(url), first_folder(url)
    labels = F.split(h, r"\.")
    ends = F.transform(F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))),
                       lambda i: F.struct(F.lit("domain").alias("kind"), F.array_join(F.slice(labels, i, F.size(labels)), ".").alias("value"), (F.size(labels) - i).alias("rank")))
    own = F.array(F.struct(F.lit("prefix").alias("kind"), F.concat(h, F.lit("/"), p).alias("value"), F.lit(1001).alias("rank")),
                  F.struct(F.lit("host").alias("kind"), h.alias("value"), F.lit(1000).alias("rank")))
    return F.when(h == "", F.array().cast("array<struct<kind:string,value:string,rank:int>>")).otherwise(F.concat(own, F.when(F.size(labels) > 1, ends).otherwise(F.array().cast("array<struct<kind:string,value:string,rank:int>>"))))


def validity(entries: DataFrame) -> DataFrame:
    """(kind, value, action, since, until) from dated entries (kind, value, action, day, entry_id).

    An entry holds from its day until the next entry for the same value (end excluded, null: open).
    ``remove`` ends what came before and holds nothing itself. Of entries of one day the one with the
    largest id counts, of equal ids the action first in order; entries without value or day are left out.
    """
    e = entries.where("kind is not null and value is not null and day is not null")
    e = e.groupBy("kind", "value", "day").agg(F.max_by("action", F.struct(F.coalesce("entry_id", F.lit(-1)), F.col("action") == "block", F.col("action") == "allow")).alias("action"))
    by = W.partitionBy("kind", "value").orderBy("day")
    return e.select("kind", "value", "action", F.col("day").alias("since"), F.lead("day").over(by).alias("until")).where("action <> 'remove'")


def evaluate(captures: DataFrame, entries: DataFrame, key: str = "page_id", url: str = "url", day: str = "day", bucket_days: int = BUCKET_DAYS) -> DataFrame:
    """(key, day, verdict, kind, value, since): each capture judged by the most specific entry active on its day.

    An as-of join: what is asked of a value (its days, however many captures fall on one) and its
    intervals are put in order within stretches of ``bucket_days`` days, and what began before a stretch
    comes from a table of one row for each stretch that has rows. Nothing is laid out over days, so open
    intervals and captures far in the future cost nothing; a hot host is one row a day. Captures without
    day or host, and those with no active entry, get verdict ``none``. Rows with equal keys are judged each.
    """
    c = captures.select(F.col(key).alias("c_key"), F.col(url).alias("c_url"), F.col(day).cast("date").alias("c_day"))
    v = settle(validity(entries), "intervals")
    # equal captures are judged once
    one = c.where("c_day is not null").select("c_url", "c_day").distinct()
    k = one.select("c_url", "c_day", F.explode(lookup_keys("c_url")).alias("k")).select("c_url", "c_day", "k.kind", "k.value", "k.rank")
    began = v.select("kind", "value", F.col("since").alias("day"), F.struct("since", "until", "action").alias("entry"))
    asked = k.select("kind", "value", F.col("c_day").alias("day")).distinct().withColumn("entry", F.lit(None).cast(began.schema["entry"].dataType))
    both = asked.unionByName(began).withColumn("cell", F.expr(f"floor(datediff(day, date'1970-01-01') / {bucket_days})"))
    # of entries that have begun the latest counts, and it is the largest
    before = W.partitionBy("kind", "value").orderBy("cell").rowsBetween(W.unboundedPreceding, -1)
    edges = both.groupBy("kind", "value", "cell").agg(F.max("entry").alias("entry")).select("kind", "value", "cell", F.max("entry").over(before).alias("earlier"))
    own = F.max("entry").over(W.partitionBy("kind", "value", "cell").orderBy("day"))
    active = both.withColumn("own", own).where("entry is null").join(edges, ["kind", "value", "cell"])
    active = active.select("kind", "value", F.col("day").alias("c_day"), F.coalesce("own", "earlier").alias("e")).where("e is not null and (e.until is null or c_day < e.until)")
    hit = k.join(active.select("kind", "value", "c_day", "e.action", "e.since"), ["kind", "value", "c_day"])
    best = hit.groupBy("c_url", "c_day").agg(F.max_by(F.struct("action", "kind", "value", "since"), F.struct("rank", "since", "value")).alias("m"))
    best = best.select(F.col("c_url").alias("b_url"), F.col("c_day").alias("b_day"), "m")
    out = c.join(best, (F.col("c_url") == F.col("b_url")) & (F.col("c_day") == F.col("b_day")), "left")
    return out.select(F.col("c_key").alias(key), F.col("c_day").alias(day), F.coalesce("m.action", F.lit("none")).alias("verdict"), "m.kind", "m.value", "m.since")
