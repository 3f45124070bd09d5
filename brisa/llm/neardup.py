"""Near-duplicate documents: an inverted join over MinHash signature coordinates, confirmed on full shingle sets."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from brisa.llm.common import Rolling, chunks, group_starts, mix, ranges, small_batches, sorted_groups, text_bytes, together
from brisa.llm.graph import components
from brisa.session import settle

COORDINATES, MATCHES = 32, 14     # a pair at similarity 0.8 has 25.6 equal coordinates on average; fewer than 14 come once in about a million
WORDS = 5                         # words of a shingle
BLOCK = 1024                      # rows of a list or group that one task compares with each other
BITS = 2048                       # a multiple of 64 and a power of two


def shingle_hashes(data: np.ndarray, off: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every shingle of a chunk and the bounds of the rows in them; a row of fewer words is one shingle."""
    low = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    word = ~((low == 32) | ((low >= 9) & (low <= 13)))
    brk = np.zeros(len(low) + 1, bool)
    brk[off] = True
    start = np.flatnonzero(word & (~np.roll(word, 1) | brk[:-1])) if len(low) else np.zeros(0, np.int64)
    end = np.flatnonzero(word & (~np.roll(word, -1) | brk[1:])) + 1 if len(low) else np.zeros(0, np.int64)
    h = Rolling(low).of(start, end)
    per = np.diff(np.searchsorted(start, off))
    first = np.concatenate([[0], np.cumsum(per)[:-1]])
    count = np.where(per >= words, per - words + 1, np.minimum(per, 1))
    at = ranges(first, count)
    row = np.repeat(np.arange(len(per)), count)
    s = np.zeros(len(at), np.uint64)
    for j in range(words):
        ok = j < np.minimum(per, words)[row]
        s = np.where(ok, mix(s * np.uint64(0xD6E8FEB86659FD93) + h[np.minimum(at + j, max(len(h) - 1, 0))] + np.uint64(j + 1)), s)
    return s, np.concatenate([[0], np.cumsum(count)])


def shingle_sets(data: np.ndarray, off: np.ndarray, words: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every row of a chunk."""
    h, at = shingle_hashes(data, off, words)
    out = []
    for i in range(len(at) - 1):
        x = np.sort(h[at[i]:at[i + 1]])
        out.append(x[np.append(True, x[1:] != x[:-1])] if len(x) else x)
    return out


def _identity(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = np.array([len(x) for x in sets], np.int64)
    a = np.array([x.sum(dtype=np.uint64) for x in sets], np.uint64).view(np.int64)
    b = np.array([np.bitwise_xor.reduce(mix(x)) if len(x) else 0 for x in sets], np.uint64).view(np.int64)
    return n, a, b


def sketch(docs: DataFrame, key: str = "doc_id", words: int = WORDS, coordinates: int = COORDINATES) -> DataFrame:
    """(key, n_shingles, s1, s2, sig): size, 128-bit identity and signature of each document's distinct shingles."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        odd = mix(np.arange(1, coordinates + 1, dtype=np.uint64)) | np.uint64(1)
        for b in batches:
            data, off = text_bytes(b.column(1))
            for i, j in chunks(off):
                sets = shingle_sets(data[off[i]:off[j]], off[i:j + 1] - off[i], words)
                n, s1, s2 = _identity(sets)
                sig = np.zeros((j - i, coordinates), np.int32)
                some = np.flatnonzero(n)
                if len(some):
                    allh, at = np.concatenate(sets), np.concatenate([[0], np.cumsum(n[some])[:-1]])
                    for c in range(coordinates):
                        sig[some, c] = np.minimum.reduceat((allh * odd[c]) >> np.uint64(32), at).astype(np.uint32).view(np.int32)
                flat = pa.ListArray.from_arrays(pa.array(np.arange(0, (j - i + 1) * coordinates, coordinates, dtype=np.int32)), pa.array(sig.ravel()))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), pa.array(n), pa.array(s1), pa.array(s2), flat], [key, "n_shingles", "s1", "s2", "sig"])

    return docs.select(key, "text").mapInArrow(run, f"`{key}` {kind}, n_shingles bigint, s1 bigint, s2 bigint, sig array<int>")


class Signatures:
    """Equal coordinates between one row and all rows of a group."""

    def __init__(self, col: pa.Array, matches: int):
        flat = col.flatten().to_numpy(zero_copy_only=False)
        self.rows, self.matches = flat.reshape(len(col), -1), matches

    def hits(self, i: int) -> np.ndarray:
        return (self.rows == self.rows[i]).sum(1) >= self.matches


class Sets:
    """Jaccard similarity of at least ``percent`` / 100 between one row and rows of a group, on full sets.

    Most rows are told apart by their bits: a set's hashes flip one of BITS bits each, so two sets differ in
    no fewer hashes than bits. Only rows that this leaves are compared hash by hash.
    """

    def __init__(self, col: pa.Array, percent: int):
        self.size = np.asarray(col.value_lengths().to_numpy(zero_copy_only=False), np.int64)
        self.at = np.concatenate([[0], np.cumsum(self.size)])
        self.values, self.percent = col.flatten().to_numpy(zero_copy_only=False).view(np.uint64), percent
        self.bits = np.zeros((len(col), BITS // 64), np.uint64)
        for i in range(0, len(col), BLOCK):
            n = min(BLOCK, len(col) - i)
            bit = np.repeat(np.arange(n) * BITS, self.size[i:i + n]) + (self.values[self.at[i]:self.at[i + n]] & np.uint64(BITS - 1)).astype(np.int64)
            odd = (np.bincount(bit, minlength=n * BITS) & 1).astype(np.uint8)
            self.bits[i:i + n] = np.packbits(odd).view(np.uint64).reshape(n, -1)

    def hits(self, i: int, n: int | None = None, known: np.ndarray | None = None) -> np.ndarray:
        """Rows like row i, of the first ``n`` rows and of those that ``known`` has under another value than i."""
        size = self.size[:n]
        differ = np.maximum(np.bitwise_count(self.bits[:n] ^ self.bits[i]).sum(1, dtype=np.int64), np.abs(size - self.size[i]))
        out = (100 + self.percent) * differ <= (100 - self.percent) * (size + self.size[i])
        if known is not None:
            out &= known[:n] != known[i]
        left = np.flatnonzero(out)
        if len(left):
            mine, many = self.values[self.at[i]:self.at[i + 1]], size[left]
            x = self.values[ranges(self.at[left], many)]
            same = np.concatenate([[0], np.cumsum(mine[np.minimum(np.searchsorted(mine, x), len(mine) - 1)] == x)])
            end = np.cumsum(many)
            inter = same[end] - same[end - many]
            out[left] = 100 * inter >= self.percent * (many + self.size[i] - inter)
        return out


def _forest(rows: DataFrame, payload: str, make: Callable, spare: bool) -> DataFrame:
    """Links (a, b) that join what belongs together in every group (k, block) of ``rows``.

    ``rows``: k, block, nb (blocks of the group), id, top (the group's center), payload. All rows are compared
    with the center, only those not like it with all others. One link per other component found is given,
    never all pairs.
    ``spare`` also ties rows of split groups that are not like their center to it, untested.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in sorted_groups(batches, ["k", "block"]):
            t = t.combine_chunks()
            at = group_starts(t, ["k", "block"])
            ids = t.column("id").to_numpy()
            top, split = t.column("top").to_numpy(), t.column("nb").to_numpy() > 1
            col = t.column(payload).combine_chunks()
            a: list[np.ndarray] = []
            b: list[np.ndarray] = []
            for i, j in zip(at[:-1].tolist(), at[1:].tolist()):
                if j - i < 2:
                    continue
                g = make(col.slice(i, j - i))
                who, c = ids[i:j], int(top[i:j].argmax())
                like = g.hits(c)
                like[c] = True
                known = np.where(like, who[c], who)
                a.append(who[like]), b.append(np.full(int(like.sum()), who[c]))
                todo = np.flatnonzero(~like)
                if spare and split[i]:
                    a.append(who[todo]), b.append(np.full(len(todo), who[c]))
                for s in todo.tolist():
                    other = g.hits(s) & (known != known[s])
                    if other.any():
                        comps, first = np.unique(known[other], return_index=True)
                        a.append(np.full(len(comps), who[s])), b.append(who[np.flatnonzero(other)[first]])
                        known[np.isin(known, comps)] = known[s]
            if a:
                x, y = np.concatenate(a), np.concatenate(b)
                x, y = x[x != y], y[x != y]
                yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], ["a", "b"])

    return together(rows.select("k", "block", "nb", "id", "top", payload), "k", "block").mapInArrow(run, "a bigint, b bigint").distinct()


def _across(large: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) of the probes of split groups with other components.

    ``large``: k, id, comp (what is known to hang together), probe, hashes. Rows live in blocks of their
    group and of their class of sizes; similar sets are of the same class or of neighbours. Probes visit
    the blocks of these three classes, some thousand at a time, and are compared with who lives there.
    """
    keys = ["k", "cls", "block", "part"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in sorted_groups(batches, keys):
            t = t.combine_chunks()
            at = group_starts(t, keys)
            ids, comp, visits = t.column("id").to_numpy(), t.column("comp").to_numpy(), t.column("visits").to_numpy()
            col = t.column("hashes").combine_chunks()
            a: list[np.ndarray] = []
            b: list[np.ndarray] = []
            for i, j in zip(at[:-1].tolist(), at[1:].tolist()):
                n = int((~visits[i:j]).sum())            # those who live here come first
                if not n or n == j - i:
                    continue
                g = Sets(col.slice(i, j - i), percent)
                who, known = ids[i:j], comp[i:j].copy()
                for s in range(n, j - i):
                    other = g.hits(s, n, known)
                    if other.any():
                        comps, first = np.unique(known[:n][other], return_index=True)
                        a.append(np.full(len(comps), who[s])), b.append(who[np.flatnonzero(other)[first]])
                        known[np.isin(known, comps)] = known[s]
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])

    # a little wider than the least ratio of two similar sizes, so that rounding does not matter
    large = large.withColumn("cls", F.floor(F.log(F.size("hashes").cast("double")) / math.log(101 / percent)).cast("int"))
    sizes = large.groupBy("k", "cls").agg(F.count("*").alias("n"), F.sum(F.col("probe").cast("int")).alias("p"))
    near = F.explode(F.array(*[F.col("cls") + d for d in (-1, 0, 1)]))
    come = sizes.select("k", near.alias("cls"), "p").groupBy("k", "cls").agg(F.sum("p").alias("p")).where("p > 0")
    rooms = sizes.select("k", "cls", F.ceil(F.col("n") / BLOCK).cast("int").alias("nb")).join(come, ["k", "cls"])
    rooms = settle(rooms.select("k", "cls", "nb", F.ceil(F.col("p") / (4 * BLOCK)).cast("int").alias("parts")), "rooms")
    cols = ["id", "comp", "hashes", "k", "cls", "block", "part"]
    lives = large.join(rooms, ["k", "cls"]).withColumn("block", F.pmod(F.xxhash64("id"), F.col("nb")).cast("int"))
    lives = lives.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(*cols, F.lit(False).alias("visits"))
    comes = large.where("probe").withColumn("cls", near).join(rooms, ["k", "cls"]).withColumn("part", F.pmod(F.xxhash64("id", F.lit(1)), F.col("parts")).cast("int"))
    comes = comes.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("nb") - 1))).select(*cols, F.lit(True).alias("visits"))
    return together(lives.unionByName(comes), *keys, last="visits").mapInArrow(run, "a bigint, b bigint").distinct()


def _blocks(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """``rows`` (k, id, …) with the block and the center flag; a split group's center goes to every block.

    ``groups``: k, n (rows), center. A hot group is dealt over n / BLOCK blocks.
    """
    r = rows.join(groups, "k").withColumn("nb", F.ceil(F.col("n") / BLOCK).cast("int")).withColumn("top", F.col("id") == F.col("center"))
    every = F.when(F.col("top"), F.sequence(F.lit(0), F.col("nb") - 1)).otherwise(F.array(F.pmod(F.xxhash64("id"), F.col("nb")).cast("int")))
    return r.withColumn("block", F.explode(every)).drop("n", "center")


def candidate_groups(sigs: DataFrame, coordinates: int = COORDINATES, matches: int = MATCHES) -> DataFrame:
    """(id, k): groups that hold every two documents with at least ``matches`` equal coordinates.

    Documents are posted under their (coordinate, value) pairs. Values seen once are dropped. Two
    documents with enough collisions meet in at least one of their rarest values even if each is
    posted only under the first ``shared - matches + 1`` of its shared values, rarest first (prefix);
    a value of over BLOCK documents is posted only by documents with at least ``matches`` such values,
    because a pair that meets in no rarer value has all its collisions there (skip). Inside a list
    collisions are counted on the whole signatures. Groups may join more than needed, never less.
    """
    tokens = sigs.select("id", F.posexplode("sig").alias("c", "v")).select("id", F.expr("shiftleft(cast(c as bigint), 32) | (cast(v as bigint) & 4294967295)").alias("k"))
    freq = tokens.groupBy("k").agg(F.count("*").alias("f")).where("f > 1")
    by = W.partitionBy("id")
    posts = tokens.join(freq, "k").select("id", "k", "f", F.count("*").over(by).alias("r"), F.row_number().over(by.orderBy("f", "k")).alias("nth"),
                                          F.sum("f").over(by).alias("pop"), F.sum(F.when(F.col("f") > BLOCK, 1).otherwise(0)).over(by).alias("hot"))
    posts = posts.where((F.col("nth") <= F.col("r") - matches + 1) & ((F.col("f") <= BLOCK) | (F.col("hot") >= matches)))
    posts = settle(posts.select("id", "k", "pop"), "postings")
    lists = posts.groupBy("k").agg(F.count("*").alias("n"), F.max_by("id", F.struct("pop", -F.col("id"))).alias("center")).where("n > 1")
    rows = _blocks(posts.select("k", "id"), lists).join(sigs, "id")
    return components(_forest(rows, "sig", lambda col: Signatures(col, matches), True)).withColumnRenamed("component", "k")


def sets_of(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """``docs`` (text and other columns) with the shingle set in ``hashes`` instead of the text and its identity in ``t1``, ``t2``."""
    keep = [c for c in docs.columns if c != "text"]
    schema = ", ".join([f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep] + ["t1 bigint, t2 bigint, hashes array<bigint>"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, off = text_bytes(b.column(b.schema.get_field_index("text")))
            for i, j in chunks(off):
                sets = shingle_sets(data[off[i]:off[j]], off[i:j + 1] - off[i], words)
                n, t1, t2 = _identity(sets)
                flat = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
                hashes = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), pa.array(flat))
                part = b.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([*[part.column(part.schema.get_field_index(c)) for c in keep], pa.array(t1), pa.array(t2), hashes], [*keep, "t1", "t2", "hashes"])

    return docs.mapInArrow(run, schema)


def confirmed_links(docs: DataFrame, members: DataFrame, percent: int = 80, words: int = WORDS, key: str = "doc_id") -> DataFrame:
    """(a, b): links that hold together what is similar in each candidate group, every one confirmed on full sets.

    ``members``: id, k, s1, s2. Rows are first compared with their group's center and inside their block;
    for split groups, members that do not hang together with the center are then compared with the rows of
    all blocks that are of about their size.
    """
    groups = members.groupBy("k").agg(F.count("*").alias("n"), F.max_by("id", F.struct("pop", -F.col("id"))).alias("center")).where("n > 1")
    groups = settle(groups, "groups")     # written, so that a hot group's join is one that Spark can split
    who = members.join(groups, "k").select("id", "k", "s1", "s2", "n", "center")
    rows = docs.select(F.col(key).alias("id"), "text").join(who, "id")
    rows = sets_of(rows, words).where("s1 = t1 and s2 = t2").drop("s1", "s2", "t1", "t2")
    rows = settle(rows, "sets")
    dealt = _blocks(rows.drop("n", "center"), groups)
    first = settle(_forest(dealt, "hashes", lambda col: Sets(col, percent), False), "links")
    large = rows.where(F.col("n") > BLOCK)
    if large.isEmpty():
        return first
    comp = components(first).withColumnRenamed("component", "c")
    large = large.join(comp, "id", "left").withColumn("comp", F.coalesce("c", "id")).drop("c")
    mid = comp.select(F.col("id").alias("center"), F.col("c").alias("main"))
    large = large.join(mid, "center", "left").withColumn("probe", F.col("comp") != F.coalesce("main", "center"))
    return first.unionByName(_across(large.select("k", "id", "comp", "probe", "hashes"), percent))


def near_duplicates(docs: DataFrame, key: str = "doc_id", words: int = WORDS, percent: int = 80) -> DataFrame:
    """(key, n_shingles, component_id, kept), one row per document, by links of similarity ``percent`` / 100 or more.

    Words are runs without ASCII white space, A-Z lower-cased; a document of fewer words than a shingle
    is one shingle. Null and empty texts have no shingle and no link. Documents with equal sets are one
    node with their smallest id; rows with equal ids count as one node. A row without id has component
    null and is kept. ``key`` is an integer. Only this table's key and text are read.
    """
    small_batches(docs.sparkSession)
    small = settle(sketch(docs, key, words), "sketch")
    full = small.where(F.col("n_shingles") > 0)
    sets = full.groupBy("s1", "s2", "n_shingles").agg(F.min(key).cast("bigint").alias("id"), F.first("sig").alias("sig")).where("id is not null")
    sets = settle(sets, "distinct-sets")
    groups = candidate_groups(sets.select("id", "sig"))
    # the document whose coordinates are shared most is likely to be the one the others were made from
    tokens = sets.select("id", F.posexplode("sig").alias("c", "v"))
    inside = tokens.join(groups, "id")
    shared = inside.groupBy("k", "c", "v").agg(F.count("*").alias("f"))
    pop = inside.join(shared, ["k", "c", "v"]).groupBy("id").agg(F.sum("f").alias("pop"))
    members = groups.join(pop, "id").join(sets.select("id", "s1", "s2"), "id")
    links = confirmed_links(docs, members, percent, words, key)
    comp = components(links)
    named = sets.select("s1", "s2", F.col("n_shingles").alias("n"), "id").join(comp, "id", "left").select("s1", "s2", "n", F.coalesce("component", "id").alias("component_id"))
    out = small.join(named, (small.s1 == named.s1) & (small.s2 == named.s2) & (small.n_shingles == named.n), "left")
    cid = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col(key)).cast("bigint")
    return out.select(small[key], "n_shingles", cid.alias("component_id"), (small[key].isNull() | (small[key] == cid)).alias("kept"))
