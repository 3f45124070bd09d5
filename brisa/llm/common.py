"""Shared helpers: byte buffers of Arrow text, rolling hashes, rows of sorted groups, settled tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

CHUNK = 1 << 20
HASH_CHUNK = 1 << 18        # bytes whose windows are hashed at once: some 30 arrays of eight bytes each
BATCH = 4 << 20             # bytes of an Arrow batch; Spark's own bound lets 10,000 whole texts into one
_MUL = 0x9E3779B97F4A7C15


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bounds Arrow batches by bytes, unless the session does so itself.

    A batch lies in the JVM, in the Python worker and again in what the worker makes of it, for every
    task of an executor; rows alone do not bound it. A longer row is a batch of its own.
    """
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) is None:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH))


def row_hash(df: DataFrame) -> Column:
    """64-bit hash of a row; null flags are hashed too, because the hash leaves nulls out."""
    return F.xxhash64(*[x for c in df.columns for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())])


def fresh(name: str, df: DataFrame) -> str:
    """``name``, made longer until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def lower_ascii(c: Column | str) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and the row offsets into them; null counts as empty."""
    a = pc.fill_null(col.cast(pa.large_binary()), b"")
    off = np.frombuffer(a.buffers()[1], np.int64)[a.offset:a.offset + len(a) + 1]
    data = np.frombuffer(a.buffers()[2], np.uint8) if a.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def chunks(off: np.ndarray, size: int = HASH_CHUNK) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``size`` bytes; a longer row stands alone."""
    i, n = 0, len(off) - 1
    while i < n:
        j = int(np.searchsorted(off, off[i] + size, "right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(_MUL)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


_P = np.uint64((1 << 31) - 1)                     # a prime: a product of two residues fits 62 bits
_BASES = (0x2545F491, 0x5BD1E995)                 # two hashes modulo it, chosen once at random


def _fold(x: np.ndarray) -> np.ndarray:
    """Congruent to ``x`` modulo _P and smaller: 2**31 counts as 1."""
    return (x & _P) + (x >> np.uint64(31))


def _residue(x: np.ndarray) -> np.ndarray:
    """``x`` modulo _P for x below 2**63."""
    x = _fold(_fold(x))
    np.subtract(x, _P, out=x, where=x >= _P)
    return x


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 … base**(n-1) modulo _P, doubling what is there."""
    out = np.ones(1, np.uint64)
    while len(out) < n:
        out = np.concatenate([out, _residue(out * np.uint64(pow(base, len(out), int(_P))))])
    return out[:n]


class Rolling:
    """Polynomial prefix hashes over one byte buffer: ``of(i, j)`` hashes bytes i..j-1.

    Two hashes modulo the prime 2**31 - 1 with different bases make one of 62 bits. A prime modulus has
    no strings that collide whatever the base, as those modulo a power of two have.
    """

    _tables: list[tuple[np.ndarray, np.ndarray]] = []

    def __init__(self, data: np.ndarray):
        n = len(data) + 1
        if not Rolling._tables or len(Rolling._tables[0][0]) < n:
            m = max(n, HASH_CHUNK + 1)
            Rolling._tables = [(_powers(b, m), _powers(pow(b, -1, int(_P)), m)) for b in _BASES]
        self.sums = []
        for powers, _ in Rolling._tables:
            terms = (data.astype(np.uint64) + np.uint64(1)) * powers[:n - 1]          # below 2**40
            s = np.zeros(n, np.uint64)
            np.cumsum(terms if n < 1 << 22 else _residue(terms), out=s[1:])
            self.sums.append(s)

    def _hash(self, i, j) -> np.ndarray:
        a, b = (_residue(_fold(s[j] - s[i]) * inv[i]) for s, (_, inv) in zip(self.sums, Rolling._tables))
        return mix(a << np.uint64(31) | b)

    def of(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        return self._hash(i, j)

    def every(self, k: int) -> np.ndarray:
        """Hashes of all windows of k bytes."""
        n = len(self.sums[0])
        return self._hash(slice(0, n - k), slice(k, n))


def ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[0], start[0]+1, … (count[0] of them), start[1], …"""
    total = int(count.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.concatenate([[0], np.cumsum(count)[:-1]])
    return np.repeat(start - before, count) + np.arange(total)


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of whole groups out of a stream sorted by ``keys``: every table holds one or more complete groups.

    Only the last group of a batch is carried on, so memory is one batch and one group.
    """
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        change = np.zeros(b.num_rows, bool)
        for k in keys:
            v = b.column(b.schema.get_field_index(k)).to_numpy(zero_copy_only=False)
            change[1:] |= v[1:] != v[:-1]
        if held:
            last = held[-1]
            change[0] = any(last.column(last.schema.get_field_index(k))[last.num_rows - 1].as_py() != b.column(b.schema.get_field_index(k))[0].as_py() for k in keys)
        else:
            change[0] = True
        at = np.flatnonzero(change)
        if not len(at):
            held.append(b)
            continue
        cut = int(at[-1])
        if held or cut:
            yield pa.Table.from_batches([*held, b.slice(0, cut)])
        held = [b.slice(cut)]
    if held:
        yield pa.Table.from_batches(held)


def group_starts(t: pa.Table, keys: list[str]) -> np.ndarray:
    """Bounds of the groups in a table sorted by ``keys``: start of each group, then the number of rows."""
    change = np.zeros(t.num_rows, bool)
    change[0] = True
    for k in keys:
        v = t.column(k).to_numpy()
        change[1:] |= v[1:] != v[:-1]
    return np.append(np.flatnonzero(change), t.num_rows)


def together(df: DataFrame, *keys: str, last: str | None = None) -> DataFrame:
    """Rows with equal keys in one partition, in order of the keys and of ``last``, for ``mapInArrow`` over ``sorted_groups``.

    The rows are dealt by a hash of the keys and not by the keys themselves: Spark leaves out a
    repartition that an input seems to have already, and may then read that input another way.
    """
    return df.repartition(partitions(df.sparkSession), F.xxhash64(*keys)).sortWithinPartitions(*keys, *([last] if last else []))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
