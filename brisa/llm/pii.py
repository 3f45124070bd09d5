"""Personal data: regular expressions propose spans, checksums confirm them, context words adjust their score.

DataFrame functions only: each text is one row from scan to result, nothing is shuffled. Positions come
from cutting a text at its matches; sums of the pieces' lengths in two levels give every match its start.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from brisa.llm.common import lower_ascii

CONTEXT = 40        # code points looked at on either side, as far as the next match of the same kind
LEAST_SCORE = 0.5   # a span of an added kind needs this much
SPAN = "array<struct<start: bigint, rank: int, stop: bigint, kind: string, score: double>>"

# Length of an IBAN by country.
IBAN_LENGTHS = {"AD": 24, "AE": 23, "AT": 20, "BE": 16, "BG": 22, "CH": 21, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "EE": 20, "ES": 24, "FI": 18, "FR": 27, "GB": 22, "GR": 27,
                "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IS": 26, "IT": 27, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MT": 31, "NL": 18, "NO": 15, "PL": 28, "PT": 25,
                "RO": 24, "SA": 24, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "TR": 26}
AGAINST = ["order", "invoice", "isbn", "version", "sku", "serial", "build"]


@dataclass(frozen=True)
class Kind:
    """``pattern`` proposes, ``cut`` names the part of a match that counts, ``valid`` confirms it.

    ``before`` and ``after`` are patterns that must not stand next to a match. ``base`` kinds are given
    out whatever their score.
    """

    name: str
    pattern: str
    words: list[str]
    prior: float
    valid: Callable[[Column], Column]
    base: bool = True
    cut: Callable[[Column], Column] | None = None
    before: str | None = None
    after: str | None = None


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once."""
    return F.transform(F.array(value), use)[0]


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Check sum of a short digit string: every second digit from the right counts double."""
    def value(i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int") * (1 + i % 2)
        return F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), lambda acc, i: acc + value(i)) % 10 == 0


def mod97(iban: Column) -> Column:
    """First four characters to the end, letters as 10 to 35, remainder 1."""
    chars = F.split(F.concat(F.substring(iban, F.lit(5), F.length(iban)), F.substring(iban, 1, 4)), "")
    worth = lambda c: F.ascii(c) - F.when(c >= "A", 55).otherwise(48)
    step = lambda acc, c: (acc * F.when(c >= "A", 100).otherwise(10) + worth(c)) % 97
    return F.aggregate(F.filter(chars, lambda c: c != ""), F.lit(0), step) == 1


def _card(m: Column) -> Column:
    return let(_digits(m), lambda d: F.when(F.length(d).between(12, 19), luhn(d)).otherwise(False))


def _iban_end(m: Column) -> Column:
    """The match up to the length its country prescribes; empty if the country is unknown or the match too short."""
    size = F.element_at(F.create_map(*[F.lit(x) for kv in IBAN_LENGTHS.items() for x in kv]), F.substring(m, 1, 2))
    upto = lambda i: F.substring(m, F.lit(1), i)
    ends = F.filter(F.sequence(F.lit(15), F.length(m)), lambda i: F.length(F.replace(upto(i), F.lit(" "), F.lit(""))) == size)
    return F.coalesce(upto(F.get(ends, F.lit(0))), F.lit(""))


# The four base kinds. A possessive + and a match that starts at a run's first character (or where the last
# match ended) give what the plain patterns give, in linear time and without a deep stack.
BASE = [
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", ["email", "mail", "contact", "write", "address"], 0.9, lambda m: F.lit(True)),
    Kind("ip", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", ["ip", "server", "host", "login", "address"], 0.6,
         lambda m: m.rlike(r"^0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(\.0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])){3}$")),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", ["card", "visa", "mastercard", "credit", "debit", "payment"], 0.8, _card),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", ["phone", "tel", "telephone", "call", "mobile", "fax", "cell"], 0.7, lambda m: F.length(_digits(m)).between(9, 15))]
ADDED = [
    Kind("iban", r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}", ["iban", "account", "bank", "transfer"], 0.7, lambda m: F.when(m != "", mod97(F.replace(m, F.lit(" "), F.lit("")))).otherwise(False),
         base=False, cut=_iban_end, before=r"[A-Za-z0-9]\z"),
    Kind("ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", ["ssn", "social", "security", "taxpayer"], 0.3, lambda m: ~m.rlike("^(000|666|9)|-00-|-0000$"), base=False, before=r"[A-Za-z0-9-]\z", after="^[A-Za-z0-9-]"),
    Kind("local_phone", r"(?:\([0-9]{3}\)\x20?|[0-9]{3}[.\x20-])[0-9]{3}[.\x20-][0-9]{4}", ["phone", "tel", "telephone", "call", "mobile", "fax", "cell"], 0.3, lambda m: F.lit(True),
         base=False, before=r"[A-Za-z0-9+(-]\z|[0-9][\x20.-]\z", after="^[A-Za-z0-9-]")]
KINDS = BASE + ADDED


def _any(words: list[str]) -> str:
    return "(?:^|[^a-z])(?:" + "|".join(words) + ")(?:[^a-z]|$)"


def _starts(pieces: Column, matches: Column) -> Column:
    """Start of each match: lengths before it, summed in blocks of about the root of their number."""
    n = F.size(matches)
    first_to = lambda k: F.sequence(F.lit(0), k - 1)
    total = lambda a, at, k: F.aggregate(F.slice(a, at + 1, k), F.lit(0).cast("bigint"), lambda acc, x: acc + x)
    size = F.transform(first_to(n), lambda i: (F.length(F.get(pieces, i)) + F.length(F.get(matches, i))).cast("bigint"))
    width = F.ceil(F.sqrt(n)).cast("int")

    def with_blocks(lens: Column) -> Column:
        sums = F.transform(first_to(F.ceil(n / width).cast("int")), lambda b: total(lens, b * width, width))
        before = lambda s: F.transform(first_to(F.size(s)), lambda b: total(s, F.lit(0), b))
        at = lambda pre, i: F.get(pre, F.floor(i / width).cast("int")) + total(lens, i - i % width, i % width) + F.length(F.get(pieces, i))
        return let(sums, lambda s: let(before(s), lambda pre: F.transform(first_to(n), lambda i: at(pre, i))))

    return let(size, with_blocks)


def _spans_of(text: Column, kind: Kind, rank: int, context: int) -> Column:
    def span(pieces: Column, matches: Column, starts: Column, i: Column) -> Column:
        whole, left, right = F.get(matches, i), F.get(pieces, i), F.get(pieces, i + 1)
        part = kind.cut(whole) if kind.cut else whole
        near = lower_ascii(F.concat(F.right(left, F.lit(context)), F.lit(" "), F.left(right, F.lit(context))))
        beside = F.lit(True)
        if kind.before:
            beside = beside & ~left.rlike(kind.before)
        if kind.after:
            beside = beside & ~right.rlike(kind.after)
        score = let(near, lambda c: F.round(F.lit(kind.prior) + F.when(c.rlike(_any(kind.words)), 0.3).otherwise(0.0) - F.when(c.rlike(_any(AGAINST)), 0.3).otherwise(0.0), 2))
        made = lambda p: F.struct(F.get(starts, i).alias("start"), F.lit(rank).alias("rank"), (F.get(starts, i) + F.length(p)).alias("stop"), F.lit(kind.name).alias("kind"),
                                  F.when(kind.valid(p) & beside, F.least(F.lit(1.0), score)).alias("score"))
        return let(part, made)

    def found(matches: Column) -> Column:
        def cut(pieces: Column) -> Column:
            every = let(_starts(pieces, matches), lambda s: F.transform(F.sequence(F.lit(0), F.size(matches) - 1), lambda i: span(pieces, matches, s, i)))
            return F.filter(every, lambda s: s["score"].isNotNull() if kind.base else s["score"] >= LEAST_SCORE)

        return F.when(F.size(matches) > 0, let(F.split(text, kind.pattern, -1), cut)).otherwise(F.array().cast(SPAN))

    return let(F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)), found)


def find_pii(docs: DataFrame, text: str = "text", out: str = "pii", context: int = CONTEXT) -> DataFrame:
    """``docs`` with ``out``: its spans as (start, rank, stop, kind, score), by start and then as KINDS lists them.

    Starts and ends count code points, the end is exclusive. Matches of one kind are leftmost and do not
    overlap; those of different kinds may. A match that its validator refuses is dropped and not tried
    again. The score is the kind's own value, 0.3 more if one of its words stands near, 0.3 less for words
    that name other numbers; base kinds stay at any score, added ones need LEAST_SCORE. Null and empty
    texts have an empty list. Rows are not changed, joined or counted, so repeated rows, null ids and any
    other columns stay as they are (``out`` replaces a column of its name). Work is linear in the text but
    for n spans of one kind, which cost n times the root of n.
    """
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    lists = [_spans_of(body, k, rank, context) for rank, k in enumerate(KINDS)]
    return docs.withColumn(out, F.array_sort(F.concat(*lists)))


def written(spans: Column) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def masked(docs: DataFrame, text: str = "text", spans: str = "pii", mask: Callable[[Column], Column] = lambda kind: F.concat(F.lit("["), kind, F.lit("]"))) -> DataFrame:
    """``docs`` with every stretch that spans cover replaced by the mask of the kind that begins it.

    Overlapping spans are one stretch. Null texts stay null. A text with n stretches is cut n times.
    """
    s = F.col(spans)
    end_before = lambda i: F.coalesce(F.array_max(F.transform(F.slice(s, F.lit(1), i), lambda x: x["stop"])), F.lit(0).cast("bigint"))
    heads = F.filter(F.transform(F.sequence(F.lit(0), F.size(s) - 1), lambda i: F.struct(F.get(s, i)["start"].alias("start"), end_before(i).alias("free"), F.get(s, i)["kind"].alias("kind"))),
                     lambda x: x["start"] >= x["free"])
    t = F.col(f"`{text}`")
    piece = lambda x: F.concat(F.substring(t, (x["free"] + 1).cast("int"), (x["start"] - x["free"]).cast("int")), mask(x["kind"]))
    rest = F.substring(t, (end_before(F.size(s)) + 1).cast("int"), F.length(t))
    return docs.withColumn(text, F.when(F.size(s) > 0, F.concat(F.array_join(F.transform(heads, piece), ""), rest)).otherwise(t))
