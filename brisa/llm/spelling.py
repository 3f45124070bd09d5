"""Spelling variants: words one inserted, deleted or replaced code point apart, by dense prefix-suffix tiles.

Two words at most one edit apart agree in their first half or in their second. Words meet in the group
of such a half; a group is cut into blocks, and every pair of blocks is a tile in which the code-point
matrices of both are compared column by column. Common prefix plus common suffix of at least the longer
length minus one is a single edit. Tiles give out counts and best neighbours, never pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from brisa.llm.common import lower_ascii, partitions, sorted_groups, together
from brisa.session import settle

BLOCK = 512            # words of a group that a tile compares with as many others
TILE_BYTES = 1 << 21   # bytes of a block's code points, and cells of the tiles compared at once
TILE = ["g", "x", "y", "short", "head"]


def word_counts(words: DataFrame, least_count: int = 2) -> DataFrame:
    """(word, n) of the words that occur ``least_count`` times or more; nulls are left out."""
    return words.where(F.col("word").isNotNull()).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)


def _posts(vocab: DataFrame, least: int) -> DataFrame:
    """Each word under the halves of its own length and, as the longer of a pair, of one less.

    ``short`` is the shorter length of the pairs a group holds, ``head`` tells first halves from second ones.
    """
    size = F.length("word")
    roles = [F.struct((size - more).alias("short"), F.lit(head).alias("head"), F.lit(bool(more)).alias("longer")) for more in (0, 1) for head in (True, False)]
    d = vocab.select("word", "n", F.explode(F.array(*roles)).alias("r")).select("word", "n", "r.*").where(F.col("short") >= least)
    half = F.floor(F.col("short") / 2).cast("int")
    key = F.when(F.col("head"), F.substring("word", F.lit(1), half)).otherwise(F.substring("word", size - (F.col("short") - half) + 1, F.col("short") - half))
    return d.withColumn("g", F.xxhash64("short", "head", key))


def _compared(flat: np.ndarray, left: np.ndarray, right: np.ndarray, first: np.ndarray, end: np.ndarray, longer: np.ndarray, short: int, head: bool, diagonal: bool) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the near pairs of a stack of tiles of one shape; ``left`` and ``right`` hold rows, -1 is padding.

    A group's common half is known (the caller still verifies it), so only the other half's columns are
    compared, from both of its ends: those that go on from the common half, and those at the far end.
    """
    half = short // 2
    open_ = (left >= 0)[:, :, None] & (right >= 0)[:, None, :]
    if diagonal:
        open_ &= left[:, :, None] < right[:, None, :]
    left, right = np.where(left >= 0, left, left[:, :1]), np.where(right >= 0, right, right[:, :1])
    open_ &= ~(longer[left][:, :, None] & longer[right][:, None, :])
    need = (short - 1 + (longer[left][:, :, None] | longer[right][:, None, :])).astype(np.int32)
    both = np.full(open_.shape, half if head else short - half, np.int32)
    forward, backward = (range(half, short), range(short - half)) if head else (range(half), range(short - half, short))
    for columns, at, sign in ((forward, first, 1), (backward, end, -1)):
        alive = open_.copy()
        for k in columns:
            alive &= flat[at[left] + sign * k][:, :, None] == flat[at[right] + sign * k][:, None, :]
            if not alive.any():
                break
            both += alive
        else:
            if not head and sign == 1:
                open_ &= ~alive          # the first halves agree too: their own group has the pair
    t, i, j = np.nonzero(open_ & (both >= need))
    return left[t, i], right[t, j]


def _stacks(t: pa.Table) -> Iterator[tuple[int, bool, bool, np.ndarray, np.ndarray]]:
    """Tiles of a table of whole groups, stacked by shape: (short, head, diagonal, left rows, right rows)."""
    cols = {c: t.column(c).to_numpy() for c in [*TILE, "side", "longer"]}
    change = np.ones(t.num_rows, bool)
    change[1:] = np.logical_or.reduce([cols[c][1:] != cols[c][:-1] for c in TILE])
    start = np.flatnonzero(change)
    count = np.diff(np.append(start, t.num_rows))
    tile = np.repeat(np.arange(len(start)), count)
    of_left = cols["side"] == cols["x"]
    n_left = np.bincount(tile, of_left, len(start)).astype(np.int64)
    diagonal = cols["x"][start] == cols["y"][start]
    n_right = np.where(diagonal, n_left, count - n_left)
    useful = np.where(diagonal, n_left > 1, (n_left > 0) & (n_right > 0)) & (np.bincount(tile, ~cols["longer"], len(start)) > 0)
    # rows of a tile: left ones first
    rows = np.lexsort([~of_left, tile])
    width = lambda n: 1 << np.maximum(np.ceil(np.log2(np.maximum(n, 1))), 1).astype(np.int64)
    shape = np.stack([cols["short"][start], cols["head"][start], diagonal, width(n_left), width(n_right)], 1)[useful]
    if not len(shape):
        return
    kinds, which = np.unique(shape, axis=0, return_inverse=True)
    useful = np.flatnonzero(useful)
    for q, (short, head, diag, wl, wr) in enumerate(kinds.tolist()):
        mine = useful[which.ravel() == q]
        at_once = max(1, TILE_BYTES // (wl * wr))
        for a in range(0, len(mine), at_once):
            m = mine[a:a + at_once]
            pick = lambda first, n, w: np.where(np.arange(w) < n[:, None], rows[np.minimum(first[:, None] + np.arange(w), t.num_rows - 1)], -1)
            left = pick(start[m], n_left[m], wl)
            yield short, bool(head), bool(diag), left, left if diag else pick(start[m] + n_left[m], n_right[m], wr)


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for t in sorted_groups(batches, TILE):
        t = t.combine_chunks()
        words = t.column("word").to_pylist()
        n = t.column("n").to_numpy()
        flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        flat = flat.astype(np.uint8) if flat.max(initial=0) < 256 else flat
        end = np.cumsum([len(w) for w in words])
        first = np.append(0, end[:-1])
        longer = t.column("longer").to_numpy(zero_copy_only=False)
        found = []
        for short, head, diagonal, left, right in _stacks(t):
            a, b = _compared(flat, left, right, first, end - 1, longer, short, head, diagonal)
            half = short // 2
            # the group is known by a hash of the common half only
            same = [words[i][:half] == words[j][:half] if head else words[i][len(words[i]) - short + half:] == words[j][len(words[j]) - short + half:] for i, j in zip(a.tolist(), b.tolist())]
            found.append(np.stack([a, b], 1)[np.array(same, bool)])
        pairs = np.concatenate(found) if found else np.zeros((0, 2), np.int64)
        if not len(pairs):
            continue
        who, other = np.concatenate([pairs[:, 0], pairs[:, 1]]), np.concatenate([pairs[:, 1], pairs[:, 0]])
        met = np.unique(other)
        rank = np.zeros(t.num_rows, np.int64)
        rank[sorted(met.tolist(), key=lambda i: (-n[i], words[i]))] = np.arange(len(met))
        order = np.lexsort([rank[other], who])
        who, other = who[order], other[order]
        at = np.flatnonzero(np.append(True, who[1:] != who[:-1]))
        n_near = np.diff(np.append(at, len(who)))
        yield pa.RecordBatch.from_arrays([pa.array([words[i] for i in who[at].tolist()], pa.string()), pa.array(n_near), pa.array([words[i] for i in other[at].tolist()], pa.string()), pa.array(n[other[at]])],
                                         ["word", "n_near", "best", "best_n"])


def near_words(vocab: DataFrame, least: int = 7, block: int = BLOCK) -> DataFrame:
    """(word, n_near, best, best_n) of the words with a neighbour; ``vocab`` is a settled table of distinct (word, n).

    The best neighbour has the largest n, then the smallest word. Groups over ``block`` words are dealt in
    blocks by a hash of the word, each pair of blocks in a task of its own; blocks of very long words are
    smaller, so that one holds TILE_BYTES of code points at most.
    """
    posts = _posts(vocab, least)
    rows = F.greatest(F.lit(1), F.least(F.lit(block), F.floor(F.lit(TILE_BYTES) / F.col("short")).cast("int")))
    large = posts.groupBy("g").agg(F.count(F.lit(1)).alias("m"), F.max("short").alias("short")).where(F.col("m") > rows).select("g", F.ceil(F.col("m") / rows).cast("int").alias("nb"))
    posts = posts.join(settle(large, "large-groups"), "g", "left").withColumn("side", F.pmod(F.xxhash64("word"), F.coalesce("nb", F.lit(1))).cast("int"))
    pairs = F.expr("transform(sequence(0, coalesce(nb, 1) - 1), o -> struct(least(o, side) as x, greatest(o, side) as y))")
    tiles = posts.select("*", F.explode(pairs).alias("xy")).select("g", "xy.x", "xy.y", "short", "head", "side", "longer", "word", "n")
    found = together(tiles, *TILE).mapInArrow(_tiles, "word string, n_near bigint, best string, best_n bigint")
    best = F.min(F.struct((-F.col("best_n")).alias("down"), "best"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select("word", "n_near", F.col("b.best").alias("best"), (-F.col("b.down")).alias("best_n"))


def _roots(steps: DataFrame) -> DataFrame:
    """(word, root) where ``steps`` (word, form) are followed to the last; each round doubles the steps gone.

    A form is at least ten times as frequent as its word, so paths are no longer than the digits of the
    largest count and two or three rounds do.
    """
    gone = settle(steps.select("word", F.col("form").alias("root"), F.lit(False).alias("moved")), "forms")
    while True:
        ahead = gone.select(F.col("word").alias("root"), F.col("root").alias("next"))
        gone = settle(gone.select("word", "root").join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if gone.where("moved").isEmpty():
            return gone.select("word", "root")


def group_variants(words: DataFrame, least: int = 7, least_count: int = 2, factor: int = 10, block: int = BLOCK) -> DataFrame:
    """(word, n, n_near, form, form_n, root), one row per distinct word of ``least`` code points and ``least_count`` occurrences.

    ``words`` has one row per occurrence in ``word``; other columns are ignored. A word's form is its
    near word of largest n (ties: smallest in code-point order) if that n is at least ``factor`` times its
    own, else null; its root is the last form on the way, the word itself if it has none. Null and short
    words are left out; an empty table gives an empty result. Words may be of any length.
    """
    vocab = settle(word_counts(words.where(F.length("word") >= least), least_count).repartition(partitions(words.sparkSession), "word"), "vocabulary")
    near = near_words(vocab, least, block)
    good = F.col("best_n") >= factor * F.col("n")
    d = settle(vocab.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), F.when(good, F.col("best")).alias("form"),
                                                       F.when(good, F.col("best_n")).alias("form_n")), "near-words")
    roots = _roots(d.where("form is not null").select("word", "form"))
    return d.join(roots, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))


def damaged_words(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = 7, every: int = 31) -> DataFrame:
    """(word): maximal runs of letters, A-Z lower-cased, with a code point deleted where the crc32 of ``<key>:<run>`` is divisible by ``every``.

    Runs of fewer than ``least`` letters are left out, as no deletion makes them longer. A null key counts as empty.
    """
    runs = docs.select(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).alias("k"), F.explode(F.regexp_extract_all(F.col(f"`{text}`"), F.lit("[A-Za-zÀ-ÿ]{%d,}" % least), F.lit(0))).alias("run"))
    low = runs.select("k", lower_ascii("run").alias("run"))
    hashed = low.select("run", F.crc32(F.concat("k", F.lit(":"), "run")).alias("h"))
    at = F.pmod(F.col("h"), F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return hashed.select(F.when(F.col("h") % every == 0, cut).otherwise(F.col("run")).alias("word"))
