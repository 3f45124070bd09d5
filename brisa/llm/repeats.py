"""Repeated passages: common-prefix interval trees over suffix arrays dealt out by content-defined anchors.

Every window of ``window`` bytes names one *anchor*, the smallest hash among its grams, so two equal
windows name equal grams at equal offsets. The suffixes of a document are thereby dealt to anchors: a
*segment* is a stretch of neighbouring windows with one anchor. Suffixes with a common prefix of a
window's length always meet under the same anchor hash, and only anchors that hold at least two
different segments need a suffix array at all; equal segments are told by their hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from brisa.llm.common import Rolling, chunks, group_starts, partitions, small_batches, sorted_groups, text_bytes, together
from brisa.session import settle

WINDOW, GRAM = 200, 48
SPLIT = 2000                      # different segments of one anchor that a single suffix array takes
_BITS = np.uint64((1 << 28) - 1)  # low bits of a gram's order: its place in the chunk


def _sliding_min(a: np.ndarray, w: int) -> np.ndarray:
    n = len(a)
    x = np.full(-(-n // w) * w, np.iinfo(np.uint64).max, np.uint64)
    x[:n] = a
    x = x.reshape(-1, w)
    ahead = np.minimum.accumulate(x, axis=1).ravel()
    behind = np.minimum.accumulate(x[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n - w + 1], ahead[w - 1:n])


def segments(data: np.ndarray, off: np.ndarray, window: int, gram: int):
    """Segments of all rows of a chunk: anchor hash, segment hash, row, first window, anchor, last window."""
    none = np.zeros(0, np.int64)
    if len(data) < window:
        return none.astype(np.uint64), none.astype(np.uint64), none, none, none, none
    roll = Rolling(data)
    g = roll.every(gram)
    order = (g & ~_BITS) | np.arange(len(g), dtype=np.uint64)
    anchor = (_sliding_min(order, window - gram + 1) & _BITS).astype(np.int64)
    i = np.arange(len(anchor))
    valid = i + window <= np.repeat(off[1:], np.diff(off))[:len(anchor)]
    same = np.append(False, valid[:-1] & (anchor[1:] == anchor[:-1]))
    lo = np.flatnonzero(valid & ~same)
    hi = np.flatnonzero(valid & ~np.append(same[1:] & valid[1:], False))
    p = anchor[lo]
    return g[p], roll.of(lo, hi + window), np.searchsorted(off, lo, "right") - 1, lo, p, hi


def _segment_rows(docs: DataFrame, window: int, gram: int, combine: bool) -> DataFrame:
    """Segments of ``docs`` (u, text): (fp, sh, u, at) each, or with ``combine`` (fp, sh, u, n), equal ones of a batch in one row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            u = b.column(0).to_numpy(zero_copy_only=False)
            data, off = text_bytes(b.column(1))
            parts = []
            for i, j in chunks(off):
                fp, sh, row, lo, p, hi = segments(data[off[i]:off[j]], off[i:j + 1] - off[i], window, gram)
                start = lo - (off[i:j] - off[i])[row]
                parts.append((fp.view(np.int64), sh.view(np.int64), u[i:j][row], start << 20 | (p - lo) << 10 | (hi - lo)))
            if not parts:
                continue
            fp, sh, who, at = (np.concatenate(x) for x in zip(*parts))
            if combine:
                o = np.lexsort((sh, fp))
                fp, sh, who = fp[o], sh[o], who[o]
                first = np.flatnonzero(np.append(True, (fp[1:] != fp[:-1]) | (sh[1:] != sh[:-1]))) if len(fp) else np.zeros(0, np.int64)
                at = np.diff(np.append(first, len(fp)))
                fp, sh, who = fp[first], sh[first], np.minimum.reduceat(who, first) if len(first) else who
            yield pa.RecordBatch.from_arrays([pa.array(fp), pa.array(sh), pa.array(who), pa.array(at)], ["fp", "sh", "u", "n" if combine else "at"])

    return docs.select("u", "text").mapInArrow(run, f"fp bigint, sh bigint, u bigint, {'n' if combine else 'at'} bigint")


def _lcp(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    lo, hi = 0, n                 # equal below lo, different somewhere below hi
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo


def intervals(lcp: list[int]) -> Iterator[tuple[int, int, int]]:
    """Interval tree of a list of common-prefix lengths, bottom up: (depth, first, last); ``lcp[i]`` is between i-1 and i."""
    stack = [(0, 0)]
    for i in range(1, len(lcp) + 1):
        cur = lcp[i] if i < len(lcp) else -1
        left = i - 1
        while stack and stack[-1][0] > cur:
            depth, left = stack.pop()
            if i - 1 > left:
                yield depth, left, i - 1
        if not stack or stack[-1][0] < cur:
            stack.append((cur, left))


def repeat_groups(left: list[bytes], right: list[bytes], window: int) -> Iterator[tuple[int, int, list[int]]]:
    """Maximal repeats of at least ``window`` bytes over the suffixes ``right``: (bytes to the left, bytes to the right, members).

    The suffixes are sorted, a stack scan of their common-prefix lengths gives the interval tree, and
    each interval is split by what stands to the left (``left``, read backwards). A group is given out
    where its members differ on the left of it (left-extension diversity) and on the right of it.
    """
    n = len(right)
    if n == 2:
        a, b = _lcp(left[0], left[1]), _lcp(right[0], right[1])
        if a + b >= window:
            yield a, b, [0, 1]
        return
    order = sorted(range(n), key=right.__getitem__)
    lcp = [0] + [_lcp(right[order[i - 1]], right[order[i]]) for i in range(1, n)]
    by_left = {m: k for k, m in enumerate(sorted(range(n), key=left.__getitem__))}
    place = {m: k for k, m in enumerate(order)}
    for depth, first, last in intervals(lcp):
        need = max(window - depth, 0)
        members = [m for m in order[first:last + 1] if len(left[m]) >= need]
        if len(members) < 2:
            continue
        members.sort(key=by_left.__getitem__)
        back = [0] + [_lcp(left[members[i - 1]], left[members[i]]) for i in range(1, len(members))]
        if max(back) < need:
            continue
        ends = np.cumsum(np.array(lcp[first:last + 1]) == depth)       # borders between the interval's children
        for reach, a, b in intervals(back):
            if reach >= need:
                at = [place[m] - first for m in members[a:b + 1]]
                if ends[max(at)] > ends[min(at)]:
                    yield reach, depth, members[a:b + 1]


_SUFFIXES = ("fp bigint, sh bigint, n bigint, u bigint, lo bigint, s bigint, e bigint, "
             "groups array<struct<id:bigint,start:bigint,length:bigint>>")


def _scan_anchors(rows: DataFrame, window: int) -> DataFrame:
    """``rows`` (fp, sh, n, u, lo, mid, body) with what repeats of each segment: bytes s to e, and its maximal repeats."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in sorted_groups(batches, ["fp"]):
            at = group_starts(t, ["fp"])
            body, mid = t.column("body").to_pylist(), t.column("mid").to_pylist()
            sh, lo = t.column("sh").to_pylist(), t.column("lo").to_pylist()
            s, e, found = [None] * t.num_rows, [None] * t.num_rows, [[] for _ in range(t.num_rows)]
            for i, j in zip(at[:-1].tolist(), at[1:].tolist()):
                one = {sh[k]: k for k in range(i, j)}                  # each segment once
                rows_ = list(one.values())
                if len(rows_) < 2:
                    continue
                left = [body[k][:mid[k]][::-1] for k in rows_]
                right = [body[k][mid[k]:] for k in rows_]
                for back, ahead, members in repeat_groups(left, right, window):
                    gid = int.from_bytes(hashlib.blake2b(left[members[0]][:back] + b"|" + right[members[0]][:ahead], digest_size=8).digest(), "little", signed=True)
                    for m in members:
                        k = rows_[m]
                        p = lo[k] + mid[k]
                        s[k] = p - back if s[k] is None else min(s[k], p - back)
                        e[k] = p + ahead if e[k] is None else max(e[k], p + ahead)
                        found[k].append({"id": gid, "start": p - back - lo[k], "length": back + ahead})
            keep = [k for k in range(t.num_rows) if s[k] is not None]
            if keep:
                got = t.take(pa.array(keep))
                yield pa.RecordBatch.from_arrays([*[got.column(c).combine_chunks() for c in ("fp", "sh", "n", "u", "lo")], pa.array([s[k] for k in keep], pa.int64()),
                                                  pa.array([e[k] for k in keep], pa.int64()),
                                                  pa.array([found[k] for k in keep], pa.list_(pa.struct([("id", pa.int64()), ("start", pa.int64()), ("length", pa.int64())])))],
                                                 ["fp", "sh", "n", "u", "lo", "s", "e", "groups"])

    return together(rows, "fp").mapInArrow(run, _SUFFIXES)


def _windows(rows: DataFrame, window: int) -> DataFrame:
    """One row for every window of the segments in ``rows``: (wh, fp, sh, n, u, lo, at)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, off = text_bytes(b.column(b.schema.get_field_index("body")))
            for i, j in chunks(off, 1 << 18):
                d, o = data[off[i]:off[j]], off[i:j + 1] - off[i]
                count = np.diff(o) - window + 1
                k = np.repeat(np.arange(j - i), count)
                at = np.concatenate([np.arange(c) for c in count])
                pos = o[k] + at
                wh = Rolling(d).of(pos, pos + window).view(np.int64)
                part = b.slice(i, j - i)
                cols = [part.column(part.schema.get_field_index(c)).to_numpy(zero_copy_only=False)[k] for c in ("fp", "sh", "n", "u", "lo")]
                yield pa.RecordBatch.from_arrays([pa.array(wh), *map(pa.array, cols), pa.array(at)], ["wh", "fp", "sh", "n", "u", "lo", "at"])

    return rows.mapInArrow(run, "wh bigint, fp bigint, sh bigint, n bigint, u bigint, lo bigint, at bigint")


def _scan_hot(rows: DataFrame, window: int) -> DataFrame:
    """As ``_scan_anchors`` for anchors with too many segments: their suffixes are split by whole windows, counted before the shuffle."""
    w = _windows(rows, window)
    many = w.groupBy("fp", "wh").agg(F.sum("n").alias("c")).where("c > 1").drop("c")
    hit = w.join(many, ["fp", "wh"])
    group = F.struct(F.col("wh").alias("id"), F.col("at").alias("start"), F.lit(window).cast("bigint").alias("length"))
    return hit.groupBy("fp", "sh", "n", "u", "lo").agg((F.min("at") + F.col("lo")).alias("s"), (F.max("at") + F.col("lo") + window).alias("e"), F.collect_set(group).alias("groups"))


class Repeats:
    """What repeats in the texts of ``docs``, found once and kept in the shared folder.

    ``work``: one row per document, with the text of those that are ``later`` finished because some of
    their segments need a suffix array, and the result for all others; ``partly``: what the suffix arrays
    say of such segments. With ``carry``, every row of ``work`` keeps its text and its other columns
    (``row``), so that the documents need not be joined again.
    Rows are told apart by a 64-bit hash of key and text; rows equal in both are copies of each other.
    """

    def __init__(self, docs: DataFrame, key: str = "doc_id", window: int = WINDOW, gram: int = GRAM, carry: bool = False):
        if not window // 8 <= gram < window < 1024:
            raise ValueError("gram must be below window and window below 1024")
        small_batches(docs.sparkSession)
        self.key, self.window, self.gram, self.carry = key, window, gram, carry
        n = partitions(docs.sparkSession)
        row = F.struct(F.col("text").isNull().alias("_null"), *[F.col(f"`{c}`") for c in docs.columns if c != "text"]) if carry else F.lit(None).cast("struct<_null:boolean>")
        rows = docs.select(key, F.coalesce("text", F.lit("")).alias("text"), row.alias("row")).withColumn("u", F.xxhash64(key, "text"))
        # equal segments are combined in their batch, so the most frequent one comes once from each batch
        seen = _segment_rows(rows, window, gram, True).repartition(n, "fp").groupBy("fp", "sh").agg(F.sum("n").alias("n"), F.min("u").alias("rep"))
        seen = seen.withColumn("d", F.count("*").over(Window.partitionBy("fp"))).where("d > 1 or n > 1")
        at = _segment_rows(rows, window, gram, False).join(seen, ["fp", "sh"])
        need = (F.col("d") > 1) & ((F.col("n") == 1) | (F.col("rep") == F.col("u")))
        lists = at.groupBy("u").agg(F.collect_set(F.when(F.col("n") > 1, F.col("at"))).alias("whole"),
                                    F.collect_set(F.when(need, F.struct("at", "fp", "sh", "n", (F.col("d") > SPLIT).alias("hot")))).alias("open"))
        self.work = settle(self._begin(rows.join(lists, "u", "left")), "repeats")
        open_ = self._bodies(self.work.where("later").select("u", "text", "open"))
        open_ = settle(open_, "suffixes")
        cold = _scan_anchors(open_.where("not hot").drop("hot"), window)
        hot = _scan_hot(open_.where("hot").drop("hot").dropDuplicates(["fp", "sh"]), window)
        self.partly = settle(cold.unionByName(hot), "suffix-groups")
        self._rows = rows

    def _begin(self, rows: DataFrame) -> DataFrame:
        window, carry = self.window, self.carry
        entry = pa.struct([("at", pa.int64()), ("fp", pa.int64()), ("sh", pa.int64()), ("n", pa.int64()), ("hot", pa.bool_())])
        result = (("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                text, whole, opened = b.column(1), b.column(3).to_pylist(), b.column(4)
                counts = opened.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                spans = [merge_spans([(a >> 20, (a >> 20) + (a & 1023) + window) for a in w or ()]) for w in whole]
                done = [None if counts[i] or carry else digest(text[i].as_py(), spans[i]) for i in range(b.num_rows)]
                later = pa.array(counts > 0)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), text if carry else pc.if_else(later, text, pa.scalar(None, text.type)), b.column(2),
                     pa.array([[x for p in s for x in p] for s in spans], pa.list_(pa.int64())), opened.cast(pa.list_(entry)), b.column(5), later,
                     *[pa.array([d and d[k] for d in done], t) for k, (_, t) in enumerate(result)]],
                    [b.schema.names[0], "text", "u", "spans", "open", "row", "later", *[c for c, _ in result]])

        rows = rows.select(self.key, "text", "u", "whole", "open", "row")
        kept = [rows.schema[c] for c in (self.key, "text", "u")]
        more = "spans array<bigint>, open array<struct<at:bigint,fp:bigint,sh:bigint,n:bigint,hot:boolean>>"
        last = "later boolean, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
        fields = [StructField(f.name, f.dataType) for f in kept] + StructType.fromDDL(more).fields + [StructField("row", rows.schema["row"].dataType)] + StructType.fromDDL(last).fields
        return rows.mapInArrow(run, StructType(fields))

    def _bodies(self, rows: DataFrame) -> DataFrame:
        window = self.window

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                out: dict[str, list] = {c: [] for c in ("fp", "sh", "n", "u", "lo", "mid", "body", "hot")}
                for u, text, opened in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                    raw = text.encode()
                    for x in opened:
                        lo, mid, last = x["at"] >> 20, x["at"] >> 10 & 1023, x["at"] & 1023
                        for c, v in (("fp", x["fp"]), ("sh", x["sh"]), ("n", x["n"]), ("u", u), ("lo", lo), ("mid", mid), ("body", raw[lo:lo + last + window]), ("hot", x["hot"])):
                            out[c].append(v)
                types = {"body": pa.binary(), "hot": pa.bool_(), "mid": pa.int32()}
                yield pa.RecordBatch.from_arrays([pa.array(v, types.get(c, pa.int64())) for c, v in out.items()], list(out))

        return rows.mapInArrow(run, "fp bigint, sh bigint, n bigint, u bigint, lo bigint, mid int, body binary, hot boolean")

    def occurrences(self) -> DataFrame:
        """(group_id, length, u, start): every occurrence of every repeat group, in bytes; ``u`` is ``xxhash64(key, text)``.

        A repeat that spans several anchors comes as one group for each, overlapping by less than a window.
        """
        window = self.window
        at = _segment_rows(self._rows, window, self.gram, False)
        lo, last = F.shiftright("at", 20), F.col("at").bitwiseAND(F.lit(1023))
        seen = at.groupBy("fp", "sh").agg(F.count("*").alias("c")).where("c > 1")
        whole = at.join(seen, ["fp", "sh"]).select(F.col("sh").alias("group_id"), (last + window).alias("length"), "u", lo.alias("start"))
        part = self.partly.select("fp", "sh", F.explode("groups").alias("g"))
        part = at.join(part, ["fp", "sh"]).select(F.col("g.id").alias("group_id"), F.col("g.length").alias("length"), "u", (lo + F.col("g.start")).alias("start"))
        return whole.unionByName(part).distinct()

    def spans(self) -> DataFrame:
        """(key, text, u, spans, row, extra) of the documents that are not finished yet."""
        extra = self.partly.where("n = 1").groupBy("u").agg(F.collect_set(F.struct("s", "e")).alias("extra"))
        return self.work.where("later").select(self.key, "text", "u", "spans", "row").join(extra, "u", "left")

    def removed(self) -> DataFrame:
        """(key, n_bytes, n_removed, n_spans, kept_sha256) of every document."""
        key = self.key
        cols = [key, "n_bytes", "n_removed", "n_spans", "kept_sha256"]
        kind = self.work.schema[key].dataType.simpleString()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                done = [digest(t, merge_spans(_pairs(s) + [(x["s"], x["e"]) for x in e or ()])) for t, s, e in zip(*(b.column(k).to_pylist() for k in (1, 2, 3)))]
                yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array([d[k] for d in done], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string()))]], cols)

        rest = self.spans().select(key, "text", "spans", "extra").mapInArrow(run, f"`{key}` {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")
        return self.work.where("not later").select(*cols).unionByName(rest)


def _pairs(flat: list[int]) -> list[tuple[int, int]]:
    return list(zip(flat[::2], flat[1::2]))


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs covered by ``spans``, in order."""
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def cut(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    kept, at = [], 0
    for s, e in spans:
        kept.append(raw[at:s])
        at = e
    return b"".join([*kept, raw[at:]])


def digest(text: str, spans: list[tuple[int, int]]) -> tuple[int, int, int, str]:
    raw = text.encode()
    return len(raw), sum(e - s for s, e in spans), len(spans), hashlib.sha256(cut(raw, spans)).hexdigest()


def remove_repeats(docs: DataFrame, key: str = "doc_id", window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept_sha256): each document without the bytes of ``window``-byte strings that also start elsewhere.

    Texts count as UTF-8 bytes, null as empty; matches never cross documents; texts shorter than the
    window keep all. Overlapping occurrences count, and strings are judged on the input. Rows equal in
    key and text are copies like any others. Nothing is capped: a frequent string costs one row a batch.
    """
    return Repeats(docs, key, window, gram).removed()


def without_repeats(docs: DataFrame, key: str = "doc_id", window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``docs`` with the repeated bytes cut out of ``text``; a character cut in part goes as a whole. Other columns stay."""
    found = Repeats(docs, key, window, gram, carry=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = [cut(t.encode(), merge_spans(_pairs(s) + [(x["s"], x["e"]) for x in e or ()])).decode("utf-8", "ignore") if s or e else t
                    for t, s, e in zip(*(b.column(k).to_pylist() for k in (0, 1, 2)))]
            yield pa.RecordBatch.from_arrays([pa.array(text, pa.string()), b.column(3)], ["text", "row"])

    cols = ["text", "spans", "extra", "row"]
    done = found.work.where("not later").withColumn("extra", F.lit(None).cast("array<struct<s:bigint,e:bigint>>")).select(*cols)
    rows = done.unionByName(found.spans().select(*cols))
    out = rows.mapInArrow(run, StructType([StructField("text", StringType()), StructField("row", rows.schema["row"].dataType)]))
    return out.select(*[F.when(~F.col("row")["_null"], F.col("text")).alias(c) if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])
