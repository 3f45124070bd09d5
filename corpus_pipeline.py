"""Corpus pipeline: language, near duplicates, repeated passages, benchmark passages, source mixture.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; its result is written
as Parquet and read again as the next stage's ``docs``. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from brisa.llm import decontaminate, language, mixing, neardup, repeats
from brisa.llm.common import fresh, load, row_hash
from brisa.session import settle

SHINGLE = 5           # words of a shingle in the near-duplicate stage; op5's contract alone asks for 2


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps texts whose words fit the languages learned from ``lang``, in one language or several.

    Null and letterless texts go, as do random strings and languages that no row is marked with. A row
    without ``lang`` is judged like any other; if no row has one, nothing is known and all rows go.
    Repeated rows stay or go alike, other columns are untouched; an empty table stays empty.
    """
    return language.keep_known(docs, language.fit(docs, F.lit(True)))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near duplicates, that with the smallest id; rows without id come last.

    Every row takes part by a key of its own, whatever its id; rows equal in all columns are one. Texts
    without a word have no shingle and stay, as do null texts.
    """
    row = fresh("row", docs)
    worded = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    keyed = docs.where(worded).withColumn(row, row_hash(docs))
    again = settle(keyed.groupBy(row).count().where("count > 1").select(row), "equal-rows")
    rows = keyed.join(again, row, "left_anti").unionByName(keyed.join(again, row, "left_semi").dropDuplicates([row]))
    groups = neardup.near_duplicates(rows.select(F.col(row).alias("row"), "text"), "row", SHINGLE).select("row", "component_id")
    groups = groups.join(rows.select(F.col(row).alias("row"), "doc_id"), "row").select("row", "component_id", F.struct(F.col("doc_id").isNull(), "doc_id", "row").alias("place"))
    groups = settle(groups, "groups")
    first = groups.groupBy("component_id").agg(F.min("place").alias("first"), F.count("*").alias("n")).where("n > 1")
    # only what goes is looked up: the rows of larger groups that are not the first
    gone = settle(groups.join(first, "component_id").where("place <> first").select(F.col("row").alias(row)), "gone")
    return rows.join(gone, row, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns]).unionByName(docs.where(~worded))


def repeats_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts every passage of 200 bytes or more that also stands elsewhere; a text with nothing left goes.

    Null and empty texts stay; ``n_chars`` counts what is left (0 for null). Rows equal in id and text are
    copies of each other and lose what they share, like any others.
    """
    was = fresh("was_empty", docs)
    out = repeats.without_repeats(docs.withColumn(was, F.coalesce(F.col("text") == "", F.lit(True))))
    left = out.where(F.col(was) | (F.col("text") != ""))
    return left.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast("long")).select(*[F.col(f"`{c}`") for c in docs.columns])


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of which a twentieth or more of the words stand in benchmark passages.

    Null and wordless texts stay. Rows are told apart by a hash of all their columns, so rows that are
    equal in everything go or stay together.
    """
    row = fresh("row", docs)
    keyed = docs.withColumn(row, row_hash(docs))
    found = decontaminate.contamination(keyed.select(F.col(row).alias("row"), "text"), load(spark, sf_dir, "benchmark"), key="row")
    bad = settle(found.where("contaminated").select(F.col("row").alias(row)).distinct(), "contaminated")
    return keyed.join(bad, row, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or leaves out documents so that sources have their share of words; ``copy`` numbers the copies.

    Texts of no words are not taken; null ids and null sources are ordinary values; rows that share an id
    are taken each by itself.
    """
    return mixing.mix_documents(docs, [3, 1, 2], 1.5, 2.0)


STAGES = [("language", language_stage), ("near_duplicates", near_duplicate_stage), ("repeats", repeats_stage),
          ("decontamination", decontamination_stage), ("mixing", mixing_stage)]

# Near duplicates, trained languages and common prefixes over whole texts are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
