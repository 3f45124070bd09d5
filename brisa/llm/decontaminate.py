"""Benchmark decontamination over a distributed positional inverted index, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from brisa.llm.common import lower_ascii
from brisa.session import settle

SPAN = 13
END = "\0"        # no word: its posting stands behind a document's last word
RAREST = 2        # lists that are intersected for a window before its words are compared


def raw_words(text: str) -> Column:
    """Words as they are written: runs of digits, ASCII letters and all that is not ASCII; null has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), lambda x: x != "")


def lowered(word: str | Column) -> Column:
    """A-Z lower-cased, other letters as they are; most words have nothing to lower and are told by a quick test."""
    c = F.col(word) if isinstance(word, str) else word
    return F.when(F.lower(c) == c, c).otherwise(lower_ascii(c))


def words(text: str) -> Column:
    return F.transform(raw_words(text), lowered)


def row_key(key: str, text: str) -> Column:
    return F.xxhash64(key, text)


def windows(items: DataFrame, item_key: str = "item_id", text: str = "text", span: int = SPAN) -> DataFrame:
    """(item, iw, k, length): windows of ``span`` consecutive words, or one window of all words of a shorter item."""
    i = items.select(F.col(item_key).cast("string").alias("item"), words(text).alias("iw")).where(F.size("iw") > 0).distinct()
    n = F.size("iw")
    return i.select(F.xxhash64("item", "iw").alias("q"), "item", "iw", F.explode(F.sequence(F.lit(0), F.greatest(n - span, F.lit(0)))).alias("k"), F.least(n, F.lit(span)).alias("length"))


def term_counts(docs: DataFrame, terms: DataFrame, text: str = "text") -> DataFrame:
    """(term, f): how often each test term occurs in all documents; counted before the shuffle."""
    all_words = docs.select(F.explode(raw_words(text)).alias("term")).select(lowered("term").alias("term")).join(terms, "term")
    return terms.join(all_words.groupBy("term").agg(F.count("*").alias("f")), "term", "left").select("term", F.coalesce("f", F.lit(0)).alias("f"))


def rarest_terms(wins: DataFrame, counts: DataFrame, rarest: int = RAREST) -> DataFrame:
    """``wins`` with ``need``: the item positions of each window's rarest terms, and only windows whose terms all occur."""
    terms = wins.select("q", "k", F.col("length"), F.posexplode(F.slice("iw", F.col("k") + 1, F.col("length"))).alias("at", "term"))
    by = W.partitionBy("q", "k").orderBy("f", "at")
    t = terms.join(counts, "term").withColumn("nth", F.row_number().over(by))
    need = t.groupBy("q", "k").agg(F.min("f").alias("least"), F.sort_array(F.collect_list(F.when(F.col("nth") <= rarest, F.col("k") + F.col("at")))).alias("need"))
    return wins.join(need.where("least > 0").drop("least"), ["q", "k"])


def postings(docs: DataFrame, terms: DataFrame, key: Column, text: str = "text") -> DataFrame:
    """The index: (term, u, pos) of every occurrence of ``terms``, written to the shared folder by the tasks that read the texts.

    One posting of END for each document says where it ends.
    """
    both = terms.unionByName(terms.sparkSession.range(1).select(F.lit(END).alias("term")))
    p = docs.select(key.alias("u"), F.posexplode(F.concat(raw_words(text), F.array(F.lit(END)))).alias("pos", "term"))
    return settle(p.select("u", "pos", lowered("term").alias("term")).join(settle(both, "index-terms"), "term").select("term", "u", "pos"), "index")


def alignments(index: DataFrame, wins: DataFrame) -> DataFrame:
    """(q, u, shift, ks): windows ``ks`` of an item whose rarest terms all stand in a document at one shift.

    Each list is adjusted by its term's position in the item, so lists of one item intersect where
    document and shift are equal. A group holds at most one entry for each item position.
    """
    anchors = wins.select("q", "iw", F.explode("need").alias("p")).select("q", "p", F.element_at("iw", F.col("p") + 1).alias("term")).distinct()
    lists = index.join(anchors, "term").select("q", "u", (F.col("pos") - F.col("p")).alias("shift"), "p")
    got = lists.groupBy("q", "u", "shift").agg(F.collect_set("p").alias("ps"))
    # settled: a table as small as the benchmark, next to which a frequent item's rows can be split
    per_item = settle(wins.groupBy("q").agg(F.collect_list(F.struct("k", "need")).alias("ws"), F.min(F.size("need")).alias("least")), "item-windows")
    hit = got.join(per_item, "q").where(F.size("ps") >= F.col("least")).withColumn("ks", F.expr("transform(filter(ws, w -> size(array_except(w.need, ps)) = 0), w -> w.k)"))
    return hit.where(F.size("ks") > 0).select("q", "u", "shift", "ks")


def proximity(index: DataFrame, wins: DataFrame, slop: int) -> DataFrame:
    """(item, k, u, pos): places where all of a window's rarest terms stand within ``slop`` words of where the phrase has them.

    Positions are dealt to stretches of ``slop`` + 1 words and each is also posted to the next one, so
    that lists meet in one stretch instead of being crossed.
    """
    need = wins.select("item", "q", "k", "iw", F.size("need").alias("m"), F.explode("need").alias("p"))
    a = need.select("item", "q", "k", "m", "p", F.element_at("iw", F.col("p") + 1).alias("term"))
    lists = index.join(a, "term").select("item", "q", "k", "m", "p", "u", (F.col("pos") - F.col("p")).alias("shift"))
    cell = F.floor(F.col("shift") / (slop + 1))
    lists = lists.withColumn("cell", F.explode(F.array(cell, cell + 1)))
    first = lists.groupBy("item", "q", "k", "m", "u", "cell").agg(F.collect_set(F.struct("shift", "p")).alias("s"))
    # a start is good if every term has an entry no further than ``slop`` from it
    good = first.withColumn("at", F.explode(F.array_distinct(F.expr("transform(s, x -> x.shift)"))))
    near = F.size(F.array_distinct(F.expr(f"transform(filter(s, x -> x.shift between at and at + {slop}), x -> x.p)")))
    return good.where(near >= F.col("m")).select("item", "k", "u", F.col("at").alias("pos")).distinct()


def build(docs: DataFrame, items: DataFrame, key: str = "doc_id", item_key: str = "item_id", span: int = SPAN) -> tuple[DataFrame, DataFrame]:
    """The windows of ``items`` with their rarest terms, and the index of those terms over ``docs``."""
    wins = settle(windows(items, item_key, span=span), "windows")
    terms = settle(wins.select(F.explode("iw").alias("term")).distinct(), "terms")
    wins = settle(rarest_terms(wins, settle(term_counts(docs, terms), "term-counts")), "rarest")
    rare = wins.select("iw", F.explode("need").alias("p")).select(F.element_at("iw", F.col("p") + 1).alias("term")).distinct()
    return wins, postings(docs, rare, row_key(key, "text"))


def matches(docs: DataFrame, wins: DataFrame, index: DataFrame, key: str = "doc_id") -> DataFrame:
    """(u, hits): exact occurrences of windows in documents that have any; hits: array of (item, s, length), s in words.

    The document's words are compared with the window's wherever the rarest terms agree, in the
    document's own row; ``u`` is ``xxhash64(key, text)``.
    """
    item = wins.select("q", "item", "iw", "length").distinct()
    per_doc = alignments(index, wins).join(item, "q").groupBy("u").agg(F.collect_set(F.struct("item", "iw", "length", "shift", "ks")).alias("c"))
    # the texts always meet the candidates by a shuffle on u, whose cost follows the texts whatever is found
    d = docs.select(row_key(key, "text").alias("u"), "text").hint("merge").join(settle(per_doc, "candidates"), "u").select("u", words("text").alias("w"), "c")
    hits = F.expr("""flatten(transform(c, x -> transform(filter(x.ks, k -> x.shift + k >= 0 and x.shift + k + x.length <= size(w)
        and slice(w, x.shift + k + 1, x.length) = slice(x.iw, k + 1, x.length)), k -> struct(x.item as item, x.shift + k as s, x.length as length))))""")
    # the test for hits comes after the rows are made single: below that, Spark would work out the words again for it
    return d.select("u", hits.alias("hits")).dropDuplicates(["u"]).where(F.size("hits") > 0)


def contamination(docs: DataFrame, items: DataFrame, key: str = "doc_id", item_key: str = "item_id", span: int = SPAN, share: int = 20) -> DataFrame:
    """(key, n_words, n_hit, n_items, items_sha256, contaminated) of every document.

    A word is hit inside any occurrence of a window; a document is contaminated where at least one
    word, and 1 / ``share`` of all its words, are hit. Null and empty texts have no words. Items without
    a word match nothing; rows with equal item ids are one item; an item without id can hit words but
    is not counted. Documents equal in key and text get equal rows. Repeated windows count once.
    """
    wins, index = build(docs, items, key, item_key, span)
    m = matches(docs, wins, index, key)
    ids = F.expr("array_distinct(filter(transform(hits, h -> h.item), i -> i is not null))")
    m = m.select("u", F.size(F.expr("array_distinct(flatten(transform(hits, h -> sequence(h.s, h.s + h.length - 1))))")).alias("n_hit"), F.array_sort(ids).alias("ids"))
    ends = index.where(F.col("term") == END).groupBy("u").agg(F.max("pos").cast("long").alias("n_words"))
    out = docs.select(key, row_key(key, "text").alias("u")).join(ends, "u").join(m, "u", "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return out.select(key, "n_words", n_hit.alias("n_hit"), F.when(F.col("ids").isNull(), 0).otherwise(F.size("ids")).cast("long").alias("n_items"),
                      F.sha2(F.array_join(F.coalesce("ids", F.array().cast("array<string>")), ","), 256).alias("items_sha256"),
                      ((n_hit > 0) & (n_hit * share >= F.col("n_words"))).alias("contaminated"))
