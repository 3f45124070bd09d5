"""Hard negatives: exact integer scores by a residue number system, then selection inside a score window.

Vectors of integers are multiplied modulo several small primes in float32, where every product of a
strip stays below 2**24 and is therefore exact; Chinese remaindering gives the signed score back. Anchors
and candidates are dealt in blocks, each pair of blocks is one task's tile, and tiles give out only the
rows that can be among an anchor's best.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from brisa.llm.common import group_starts, ranges, sorted_groups, together
from brisa.session import settle

# Primes below 1024, so that 64 products of centred residues stay under 2**24.
PRIMES = [1021, 1019, 1013, 1009, 997, 991]
STRIP = 64
ANCHORS, CANDIDATES = 2048, 4096   # rows of a block
CELLS = 1 << 20                    # scores held at once
LARGEST = 2.0 ** 55                # squared length a row may have, so that 100 * score fits a long


def residues(x: np.ndarray, p: int) -> np.ndarray:
    """Centred residues of whole numbers held as float64 (exact at any size)."""
    r = np.fmod(x, p)
    r = np.where(r > p // 2, r - p, r)
    return np.where(r < -(p // 2), r + p, r).astype(np.float32)


def exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Signed products of the rows of two matrices of whole numbers (float64), as int64.

    As many primes are used as the longest rows ask for: a score is at most the product of their lengths.
    """
    bound = float(np.sqrt((a * a).sum(1).max(initial=0.0)) * np.sqrt((b * b).sum(1).max(initial=0.0)))
    n, modulus = 0, 1
    while modulus <= 2.001 * bound + 1:
        modulus *= PRIMES[n]
        n += 1
    out, upto = np.zeros((len(a), len(b)), np.int64), 1
    for p in PRIMES[:n]:
        ra, rb = residues(a, p), residues(b, p)
        s = np.zeros(out.shape, np.int64)
        for k in range(0, a.shape[1], STRIP):
            s += (ra[:, k:k + STRIP] @ rb[:, k:k + STRIP].T).astype(np.int64)
        # the next mixed-radix digit brings the number so far to this prime's residue
        out += upto * ((s - out) % p * pow(upto, -1, p) % p)
        upto *= p
    return np.where(out > upto // 2, out - upto, out)


def _strips(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict[str, np.ndarray], np.ndarray, np.ndarray, np.ndarray, pa.Table]]:
    """(columns, rows of some anchors, rows of candidates by id, scores) of each tile, at most CELLS scores at once."""
    for t in sorted_groups(batches, ["x", "y", "dim"]):
        t = t.combine_chunks()
        bounds = group_starts(t, ["x", "y", "dim"])
        cols = {c: t.column(c).to_numpy(zero_copy_only=False) for c in ("id", "label", "row", "anchor", "dim")}
        flat, at = t.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(cols["dim"])])
        for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            m = flat[at[i]:at[j]].reshape(j - i, -1) if cols["dim"][i] else np.zeros((j - i, 0))
            mine = cols["anchor"][i:j]
            left, right = i + np.flatnonzero(mine), i + np.flatnonzero(~mine)
            right = right[np.lexsort([cols["row"][right], cols["id"][right]])]
            if not len(left) or not len(right):
                continue
            step = max(1, CELLS // len(right))
            for k in range(0, len(left), step):
                some = left[k:k + step]
                yield cols, some, right, exact_products(m[some - i], m[right - i]), t


def _first_rows(s: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k largest of each row, ties to the smaller column."""
    return np.argsort(-s, axis=1, kind="stable")[:, :k]


def _best_positives(k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    none = np.iinfo(np.int64).min + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c, left, right, s, _ in _strips(batches):
            other = (c["label"][left][:, None] == c["label"][right][None, :]) & (c["row"][left][:, None] != c["row"][right][None, :])
            s = np.where(other, s, none)
            top = _first_rows(s, k)
            score = np.take_along_axis(s, top, 1)
            a, j = np.nonzero(score != none)
            who = right[top[a, j]]
            yield pa.RecordBatch.from_arrays([pa.array(c["row"][left[a]]), pa.array(c["id"][who]), pa.array(c["row"][who]), pa.array(score[a, j])], ["row", "positive_id", "positive_row", "positive_score"])

    return run


def _window_negatives(k: int, low: int, high: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    none = -(1 << 56)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c, left, right, s, t in _strips(batches):
            s = np.where(c["label"][left][:, None] != c["label"][right][None, :], s, none)
            order = np.argsort(-s, axis=1, kind="stable")
            s = np.take_along_axis(s, order, 1)
            lists = t.column("scores").combine_chunks()
            size = np.asarray(lists.value_lengths().to_numpy(zero_copy_only=False), np.int64)
            flat, at = lists.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(size)])
            for nth in range(int(size[left].max(initial=0))):
                has = np.flatnonzero(size[left] > nth)
                p = flat[at[left[has]] + nth]
                first = (100 * s[has] > high * p[:, None]).sum(1)
                col = first[:, None] + np.arange(k)
                inside = col < s.shape[1]
                col = np.minimum(col, s.shape[1] - 1)
                got = s[has[:, None], col]
                inside &= (got != none) & (100 * got >= low * p[:, None])
                a, j = np.nonzero(inside)
                who = right[order[has[a], col[a, j]]]
                yield pa.RecordBatch.from_arrays([pa.array(c["row"][left[has[a]]]), pa.array(np.full(len(a), nth, np.int32)), pa.array(c["id"][who]), pa.array(c["row"][who]), pa.array(got[a, j])],
                                                 ["row", "nth", "negative_id", "negative_row", "negative_score"])

    return run


def _tiles(anchors: DataFrame, rows: DataFrame, keys: list[str], run, schema: str, anchor_block: int, candidate_block: int) -> DataFrame:
    """``run`` over all tiles: a block of anchors against a block of candidates equal in ``keys``.

    Blocks are dealt by a hash of the row, their number by the size of a key's rows, so a hot label is
    many tiles of one size.
    """
    n_a = anchors.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / anchor_block).cast("int").alias("na"))
    n_c = rows.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / candidate_block).cast("int").alias("nc"))
    blocks = settle(n_a.join(n_c, keys), "blocks")
    deal = lambda n: F.pmod(F.xxhash64("row", F.lit(n)), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    cols = ["id", "label", "row", "dim", "v"]
    tag = F.lit(0) if keys == ["dim"] else F.col("label").cast("bigint")
    a = anchors.join(blocks, keys).withColumn("bx", deal("na")).select(*cols, "scores", F.lit(True).alias("anchor"), "bx", every("nc").alias("y"), tag.alias("k"))
    c = rows.join(blocks, keys).withColumn("y", deal("nc")).select(*cols, F.expr("cast(array() as array<bigint>)").alias("scores"), F.lit(False).alias("anchor"), every("na").alias("bx"), "y", tag.alias("k"))
    # one number for key and anchor block
    both = a.unionByName(c).withColumn("x", F.xxhash64("k", "bx")).drop("k", "bx")
    return together(both, "x", "y", "dim").mapInArrow(run, schema)


def _ranked(found: DataFrame, keys: list[str], score: str, ident: str, row: str, k: int) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(F.desc(score), ident, row)
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, key: str = "vec_id", vec: str = "embedding", label: str = "label", scale: float = 256.0, anchor_every: int = 100, n_positives: int = 5, n_negatives: int = 10,
                   window: tuple[int, int] = (30, 90), anchor_block: int = ANCHORS, candidate_block: int = CANDIDATES) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Components become floor(``scale`` * x). Anchors are the rows whose id ``anchor_every`` divides; their
    positives are the first ``n_positives`` other rows of the same label by score, ties to the smaller id;
    for each, the first ``n_negatives`` rows of other labels whose score lies between ``window`` percent of
    the positive's. Rows without id, label or vector or with a null or non-finite component take no part,
    nor do rows whose integers have a squared length of 2**55 or more, as 100 times their scores would not
    fit a long. Vectors of different lengths are not compared; empty ones score 0. Rows equal in id, label
    and vector count once; rows that share an id only are rows of their own, and one may be the other's
    positive. Other columns are ignored; an empty table gives an empty result.
    """
    v = F.col(f"`{vec}`")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    scaled = F.transform(v, lambda x: F.lit(scale) * x.cast("double"))
    # floor() gives a long; a larger double is whole already
    whole = F.transform(scaled, lambda x: F.when(F.abs(x) < 2.0 ** 53, F.floor(x).cast("double")).otherwise(x))
    rows = vectors.where(F.col(f"`{key}`").isNotNull() & F.col(f"`{label}`").isNotNull() & F.coalesce(finite, F.lit(False)))
    rows = rows.select(F.col(f"`{key}`").cast("bigint").alias("id"), F.col(f"`{label}`").cast("bigint").alias("label"), whole.alias("v"))
    rows = rows.withColumns({"dim": F.size("v").cast("bigint"), "row": F.xxhash64("id", "label", "v")})
    rows = settle(rows.where(F.aggregate("v", F.lit(0.0), lambda acc, x: acc + x * x) < LARGEST).dropDuplicates(["id", "label", "row"]), "vectors")
    anchors = rows.where(F.col("id") % anchor_every == 0).withColumn("scores", F.expr("cast(array() as array<bigint>)"))
    near = _tiles(anchors, rows, ["dim", "label"], _best_positives(n_positives), "row bigint, positive_id bigint, positive_row bigint, positive_score bigint", anchor_block, candidate_block)
    positives = _ranked(near, ["row"], "positive_score", "positive_id", "positive_row", n_positives)
    per = positives.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("rank", "positive_id", "positive_score"))).alias("p"))
    asked = settle(anchors.drop("scores").join(per, "row").withColumn("scores", F.col("p.positive_score")), "anchors")
    schema = "row bigint, nth int, negative_id bigint, negative_row bigint, negative_score bigint"
    found = _tiles(asked.drop("p"), rows, ["dim"], _window_negatives(n_negatives, *window), schema, anchor_block, candidate_block)
    best = _ranked(found, ["row", "nth"], "negative_score", "negative_id", "negative_row", n_negatives)
    out = best.join(asked.select("row", F.col("id").alias("anchor_id"), "p"), "row").withColumn("p", F.get("p", F.col("nth")))
    return out.select("anchor_id", "p.positive_id", "rank", "negative_id", "p.positive_score", "negative_score")
