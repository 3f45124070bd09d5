"""Named queries opN_… over the given tables, with SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from brisa.llm import decontaminate, embeddings, language, mixing, neardup, negatives, pii, quality, repeats, spelling, tokens, urlfilter, warc
from brisa.llm.common import load
from brisa.session import settle

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def remainder(n: int, key: str = "doc_id"):
    return F.crc32(F.col(key).cast("string")) % n


@query("op3_language_id")
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    model = language.fit(docs, F.coalesce(remainder(4) != 2, F.lit(True)))
    out = language.spans(docs, model)
    return out.select("doc_id", F.coalesce(remainder(4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score", F.size("spans").alias("n_spans"))


@query("op5_minhash_near_dedup")
def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(load(spark, sf_dir, "documents"), words=2)


OP8_SQL = r"""
with sizes as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size from documents),
per as (
  select source, source_size, [3, 1, 2][((row_number() over (order by source nulls last) - 1) % 3 + 1)::int] as w, 1.5 * sum(source_size) over () as total
  from (select source, sum(size)::bigint as source_size from sizes group by source)),
lv as (
  select *, 2.0 * source_size as most, coalesce(sum(2.0 * source_size) over (order by 2.0 * source_size / w, source nulls last rows between unbounded preceding and 1 preceding), 0) as before,
         sum(w) over (order by 2.0 * source_size / w, source nulls last rows between current row and unbounded following) as w_left
  from per),
water as (select min_by((total - before) / w_left, most / w) as level from lv where (total - before) / w_left * w <= most),
plan as (select source as p_source, source_size, least(most, coalesce(level * w, most))::double as target from lv, water),
e as (
  select doc_id, source, size, source_size, target, case when source_size > 0 then round(target / source_size * 16777216)::bigint else 0 end as e,
         least(size // 32, 1023) as step, ('0x' || substr(md5(coalesce(doc_id::varchar, '')), 1, 2))::bigint as h
  from sizes join plan on source is not distinct from p_source),
c as (
  select *, sum(e) over (partition by source order by step, h, doc_id, size rows between unbounded preceding and current row)
            + ('0x' || substr(md5(coalesce(source, '')), 1, 6))::bigint as upto
  from e)
select doc_id, size, source_size, target, (size * (upto::bigint // 16777216 - (upto::bigint - e) // 16777216))::bigint as taken from c"""


@query("op8_systematic_mixing", OP8_SQL)
def op8_systematic_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = settle(load(spark, sf_dir, "documents").select("doc_id", "source", mixing.word_count("text").alias("size")), "sizes")
    out = mixing.sample_copies(sizes, mixing.targets(sizes, [3, 1, 2], 1.5, 2.0))
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


@query("op9_token_counts")
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return tokens.count_tokens(load(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def _hash(c: str, first: int, digits: int) -> str:
    return f"cast(conv(substr(md5({c}), {first}, {digits}), 16, 10) as int)"


def list_entries(pages: DataFrame) -> DataFrame:
    """A dated list over all hosts, folders and domains of ``pages``: each value has one to four entries that a hash of it names."""
    keys = pages.select(F.explode(urlfilter.lookup_keys("url")).alias("k")).select("k.kind", "k.value").distinct()
    e = keys.withColumn("n", F.explode(F.sequence(F.lit(0), F.expr(_hash("concat(kind, value)", 1, 2) + " % 4"))))
    h = _hash("concat(kind, value, cast(n as string))", 1, 4)
    a = _hash("concat(kind, value, cast(n as string))", 5, 2)
    return e.select("kind", "value", F.expr(f"date_add(date'2024-01-01', {h} % 1000)").alias("day"), F.expr(f"element_at(array('block', 'remove', 'allow', 'block'), 1 + {a} % 4)").alias("action"), F.col("n").alias("entry_id"))


OP1_SQL = r"""
with parts as (
  select page_id, url, cast(date '2024-01-01' + cast((page_id * 37) % 1000 as int) as date) as day,
         regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)), '\.+$', '') as h,
         regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*/([^/?#]*)', 1) as p from pages),
lab as (select *, string_split(h, '.') as l from parts where h <> ''),
k as (
  select url, day, 'prefix' as kind, h || '/' || p as value, 1001 as rank from lab
  union select url, day, 'host', h, 1000 from lab
  union select url, day, 'domain', array_to_string(l[i:len(l)], '.'), len(l) - i from (select *, unnest(range(1, len(l))) as i from lab where len(l) > 1)),
v as (select distinct kind, value from k),
e as (
  select kind, value, n, cast(date '2024-01-01' + cast(('0x' || substr(md5(kind || value || n::varchar), 1, 4))::int % 1000 as int) as date) as since,
         ['block', 'remove', 'allow', 'block'][1 + ('0x' || substr(md5(kind || value || n::varchar), 5, 2))::int % 4] as action
  from (select *, unnest(range(0, 1 + ('0x' || substr(md5(kind || value), 1, 2))::int % 4)) as n from v)),
d as (select kind, value, since, max_by(action, n) as action from e group by all),
i as (select *, lead(since) over (partition by kind, value order by since) as until from d),
hit as (
  select url, day, action, k.kind, k.value, since, row_number() over (partition by url, day order by rank desc, since desc, k.value desc) as nth
  from k join i on k.kind = i.kind and k.value = i.value and since <= day and (until is null or day < until) where action <> 'remove')
select page_id, parts.day, coalesce(action, 'none') as verdict, kind, value, since
from parts left join hit on parts.url = hit.url and parts.day = hit.day and nth = 1"""


@query("op1_url_filter", OP1_SQL)
def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = load(spark, sf_dir, "pages")
    captures = pages.select("page_id", "url", F.expr("date_add(date'2024-01-01', cast((page_id * 37) % 1000 as int))").alias("day"))
    return urlfilter.evaluate(captures, list_entries(pages))


@query("op2_suffix_dedup")
def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(load(spark, sf_dir, "documents"))


OP4_SQL = r"""
with d as (
  select row_number() over () as r, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w
  from documents),
b as (
  select item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w
  from benchmark),
wins as (select distinct item_id, least(len(w), 13) as n, array_to_string(w[k:k + least(len(w), 13) - 1], ' ') as s from (select *, unnest(range(1, greatest(len(w) - 13, 0) + 2)) as k from b where len(w) > 0)),
lens as (select distinct n from wins),
pos as (select r, k, n, array_to_string(w[k:k + n - 1], ' ') as s from (select r, w, n, unnest(range(1, len(w) - n + 2)) as k from d, lens where len(w) >= n)),
hit as (select r, k, pos.n, item_id from pos join wins on pos.s = wins.s and pos.n = wins.n),
h as (select r, count(distinct p) as n_hit from (select r, unnest(range(k, k + n)) as p from hit) group by r),
i as (select r, count(*) as n_items, string_agg(item, ',' order by item) as items from (select distinct r, item_id::varchar as item from hit where item_id is not null) group by r)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(items, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from d left join h on d.r = h.r left join i on d.r = i.r"""


@query("op4_benchmark_decontamination", OP4_SQL)
def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


OP6_SQL = """
with p as (select page_id, octet_length(encode(coalesce(html, '')))::bigint as payload_bytes, sha1(coalesce(html, '')) as payload_digest from pages),
t as (select payload_digest, max(page_id) as top from p where payload_bytes >= 1000 group by payload_digest)
select page_id, payload_bytes, p.payload_digest, case when page_id <> top then 'revisit' else 'response' end as record_type, case when page_id <> top then top end as refers_to
from p left join t on p.payload_digest = t.payload_digest"""


@query("op6_warc_round_trip", OP6_SQL)
def op6_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(load(spark, sf_dir, "pages"))


OP7_SQL = """
with recursive ok as (
  select vec_id, label, embedding::double[] as v from embeddings
  where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
unit as (select vec_id, label, v, sqrt(list_dot_product(v, v)) as l from ok),
links as (
  select a.vec_id as a, b.vec_id as b from unit a join unit b on a.label = b.label and len(a.v) = len(b.v) and a.vec_id <> b.vec_id
  where list_dot_product(a.v, b.v) / (a.l * b.l) >= 0.93),
reach(a, b) as (select a, b from links union select reach.a, links.b from reach join links on reach.b = links.a)
select vec_id, coalesce(n, 0)::bigint as n_links, least(vec_id, coalesce(low, vec_id)) as component_id, vec_id = least(vec_id, coalesce(low, vec_id)) as kept
from embeddings left join (select a, count(*) as n from links group by a) x on vec_id = x.a left join (select a, min(b) as low from reach group by a) y on vec_id = y.a"""


@query("op7_embedding_near_dedup", OP7_SQL)
def op7_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicate_vectors(load(spark, sf_dir, "embeddings"))


@query("op10_quality_pu")
def op10_quality_pu(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels")
    out = quality.classify(docs, labels, F.coalesce(remainder(3) != 1, F.lit(False)))
    return out.select("doc_id", F.coalesce(remainder(3) == 1, F.lit(False)).alias("held_out"), "score", "predicted")


def _pii_sql() -> str:
    """Literal twin of :func:`pii.find_pii`: matches and the pieces between them, starts by a running sum, validators and context in SQL."""
    against = "order|invoice|isbn|version|sku|serial|build"
    call = "phone|tel|telephone|call|mobile|fax|cell"
    part = "0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
    digits = "regexp_replace(m, '[^0-9]', '', 'g')"
    lengths = "AD24 AE23 AT20 BE16 BG22 CH21 CY28 CZ24 DE22 DK18 EE20 ES24 FI18 FR27 GB22 GR27 HR21 HU28 IE22 IL23 IS26 IT27 LI21 LT20 LU20 LV21 MC27 MT31 NL18 NO15 PL28 PT25 RO24 SA24 SE24 SI19 SK24 SM27 TR26"
    size = "case m[1:2] " + " ".join(f"when '{x[:2]}' then {x[2:]}" for x in lengths.split()) + " end"
    luhn = (f"len({digits}) between 12 and 19 and list_sum(list_transform(range(0, len({digits})), lambda i: case when i % 2 = 0 then {digits}[len({digits}) - i]::int "
            f"else {digits}[len({digits}) - i]::int * 2 - case when {digits}[len({digits}) - i]::int > 4 then 9 else 0 end end)) % 10 = 0")
    mod97 = ("m <> '' and list_reduce(list_prepend(0, list_transform(list_filter(string_split(replace(m, ' ', '')[5:] || replace(m, ' ', '')[1:4], ''), lambda c: c <> ''), lambda c: case when c >= 'A' then 100 + ord(c) - 55 else ord(c) - 48 end)), "
             "lambda a, c: case when c >= 100 then (a * 100 + c - 100) % 97 else (a * 10 + c) % 97 end) = 1")
    # kind, base, pattern, words, prior, valid, part of the match, before, after
    kinds = [("email", True, r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "email|mail|contact|write|address", 0.9, "true", "m", None, None),
             ("ip", True, r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "ip|server|host|login|address", 0.6, f"regexp_matches(m, '^{part}(\\.{part}){{3}}$')", "m", None, None),
             ("card", True, r"[0-9]([\x20-]?[0-9])+", "card|visa|mastercard|credit|debit|payment", 0.8, luhn, "m", None, None),
             ("phone", True, r"\+[0-9][\x20().0-9-]+[0-9]", call, 0.7, f"len({digits}) between 9 and 15", "m", None, None),
             ("iban", False, r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}", "iban|account|bank|transfer", 0.7, mod97,
              f"coalesce(m[1:list_filter(range(15, len(m) + 1), lambda i: len(replace(m[1:i], ' ', '')) = {size})[1]], '')", r"[A-Za-z0-9]\z", None),
             ("ssn", False, r"[0-9]{3}-[0-9]{2}-[0-9]{4}", "ssn|social|security|taxpayer", 0.3, "not regexp_matches(m, '^(000|666|9)|-00-|-0000$')", "m", r"[A-Za-z0-9-]\z", "^[A-Za-z0-9-]"),
             ("local_phone", False, r"(?:\([0-9]{3}\)\x20?|[0-9]{3}[.\x20-])[0-9]{3}[.\x20-][0-9]{4}", call, 0.3, "true", "m", r"[A-Za-z0-9+(-]\z|[0-9][\x20.-]\z", "^[A-Za-z0-9-]")]
    parts = []
    for rank, (name, base, pattern, words, prior, valid, cut, before, after) in enumerate(kinds):
        near = "translate(right(l, 40) || ' ' || left(n, 40), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
        score = f"least(1, round({prior} + case when regexp_matches({near}, '(?:^|[^a-z])(?:{words})(?:[^a-z]|$)') then 0.3 else 0 end - case when regexp_matches({near}, '(?:^|[^a-z])(?:{against})(?:[^a-z]|$)') then 0.3 else 0 end, 2))"
        beside = "".join(f" and not regexp_matches({side}, '{p}')" for side, p in (("l", before), ("n", after)) if p)
        least = "" if base else f" and {score} >= 0.5"
        parts.append(f"""select r, {rank} as rank, '{name}' as kind, start, start + len(m) as stop, {score} as score from (
    select r, start, l, n, {cut} as m from (
      select r, unnest(ms) as m, unnest(ps[1:len(ms)]) as l, unnest(ps[2:]) as n,
             unnest(list_transform(range(1, len(ms) + 1), lambda i: coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: len(x))), 0) + list_sum(list_transform(ps[1:i], lambda x: len(x)))))::bigint as start
      from (select r, regexp_extract_all(t, '{pattern}') as ms, string_split_regex(t, '{pattern}') as ps from d) where len(ms) > 0)) where {valid}{beside}{least}""")
    return """with d as (select row_number() over () as r, doc_id, coalesce(text, '') as t from documents),
s as (""" + "\n  union all ".join(parts) + """),
a as (select r, count(*) filter (rank = 0) as n_email, count(*) filter (rank = 1) as n_ip, count(*) filter (rank = 2) as n_card, count(*) filter (rank = 3) as n_phone,
             coalesce(string_agg(kind || ':' || start || ':' || stop, ',' order by start, rank) filter (rank < 4), '') as base,
             string_agg(kind || ':' || start || ':' || stop, ',' order by start, rank) as spans, max(score) as top_score from s group by r)
select doc_id, coalesce(n_email, 0)::bigint as n_email, coalesce(n_ip, 0)::bigint as n_ip, coalesce(n_card, 0)::bigint as n_card, coalesce(n_phone, 0)::bigint as n_phone,
       sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans, top_score::double as top_score
from d left join a on d.r = a.r"""


@query("op11_pii", _pii_sql())
def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = pii.find_pii(load(spark, sf_dir, "documents"))
    base = F.filter("pii", lambda s: s["rank"] < len(pii.BASE))
    counts = [F.size(F.expr(f"filter(pii, s -> s.kind = '{k.name}')")).cast("bigint").alias(f"n_{k.name}") for k in pii.BASE]
    return docs.select("doc_id", *counts, F.sha2(pii.written(base), 256).alias("base_sha256"), pii.written(F.col("pii")).alias("spans"), F.array_max("pii.score").alias("top_score"))


# Checksums of words and paths of forms over whole tables are beyond fast SQL; tests hold the query against brute force.
@query("op12_spelling_variants")
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(spelling.damaged_words(load(spark, sf_dir, "documents")))


OP13_SQL = """
with v as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, list_transform(embedding, lambda x: floor(256 * x::double)) as v from embeddings
  where vec_id is not null and label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select a.vec_id as anchor_id, b.vec_id as id, a.label = b.label as same, list_dot_product(a.v, b.v)::bigint as score
      from v a join v b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id and len(a.v) = len(b.v)),
p as (select anchor_id, id as positive_id, score as positive_score from s where same qualify row_number() over (partition by anchor_id order by score desc, id) <= 5)
select p.anchor_id, positive_id, row_number() over w::int as rank, id as negative_id, positive_score, score as negative_score
from p join s on p.anchor_id = s.anchor_id and not same and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score
window w as (partition by p.anchor_id, positive_id order by score desc, id) qualify row_number() over w <= 10"""


@query("op13_hard_negatives", OP13_SQL)
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(load(spark, sf_dir, "embeddings").withColumn("label", label))
