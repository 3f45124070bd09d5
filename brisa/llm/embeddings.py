"""Near-duplicate embeddings: Euclidean p-stable hashing of normalised vectors, then exact cosines."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from brisa.llm.common import group_starts, ranges, sorted_groups, together
from brisa.llm.graph import components
from brisa.session import settle

TABLES, PROJECTIONS, WIDTH = 12, 4, 1.5   # at cosine 0.93 a pair shares one table with probability 0.41, so one of 12 with 0.998
BLOCK = 1024                              # vectors of a bucket that a task compares with as many others


def usable(vec: str | Column) -> Column:
    """Not null, no null or non-finite component, not all zero."""
    v = F.col(vec) if isinstance(vec, str) else vec
    ok = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(ok & F.exists(v, lambda x: x != 0), F.lit(False))


def _hash_rows(vecs: DataFrame, tables: int, projections: int, width: float, seed: int) -> DataFrame:
    """``vecs`` (id, label, n, v) with ``keys``: the bucket in each table of the normalised vector."""
    kind = vecs.schema["v"].dataType.simpleString()
    label = vecs.schema["label"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            col = b.column(3)
            size = np.asarray(col.value_lengths().to_numpy(zero_copy_only=False), np.int64)
            flat, at = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64), np.concatenate([[0], np.cumsum(size)])
            keys = np.zeros((b.num_rows, tables), np.int64)
            for dim in np.unique(size):
                rows = np.flatnonzero(size == dim)
                x = flat[ranges(at[rows], size[rows])].reshape(len(rows), dim)
                x = x / np.abs(x).max(1, keepdims=True)            # so that squares neither vanish nor overflow
                x /= np.sqrt((x * x).sum(1, keepdims=True))
                rng = np.random.default_rng([seed, int(dim)])
                a, shift = rng.standard_normal((dim, tables * projections)), rng.uniform(0, width, tables * projections)
                cell = np.floor((x @ a + shift) / width).astype(np.int64).reshape(len(rows), tables, projections)
                k = np.full((len(rows), tables), int(dim), np.int64)
                for p in range(projections):
                    k = (k * 1_000_003) ^ cell[:, :, p]
                keys[rows] = k
            flat_keys = pa.ListArray.from_arrays(pa.array(np.arange(0, (b.num_rows + 1) * tables, tables, dtype=np.int32)), pa.array(keys.ravel()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), col, flat_keys], ["id", "label", "n", "v", "keys"])

    return vecs.select("id", "label", "n", "v").mapInArrow(run, f"id bigint, label {label}, n bigint, v {kind}, keys array<bigint>")


def _count_links(rows: DataFrame, threshold: float) -> DataFrame:
    """(id, links, b): each vector's links in each block of a bucket and one vector it hangs together with.

    ``rows``: (g, x, y) name a pair of blocks of one bucket, ``side`` the block of the row. A link is
    counted in the first table in which both vectors share a bucket. Pairs are never given out.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in sorted_groups(batches, ["g", "x", "y"]):
            t = t.combine_chunks()
            bounds = group_starts(t, ["g", "x", "y"])
            ids, n, side, table, x, y, g0 = (t.column(c).to_numpy() for c in ("id", "n", "side", "tab", "x", "y", "bucket"))
            vec, key = t.column("v").combine_chunks(), t.column("keys").combine_chunks()
            size = np.asarray(vec.value_lengths().to_numpy(zero_copy_only=False), np.int64)
            flat, at = vec.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(size)])
            keys = key.flatten().to_numpy(zero_copy_only=False).reshape(t.num_rows, -1)
            out_id, out_n, out_b = [], [], []
            for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                if j - i < 2:
                    continue
                # rows of one hash group may still differ in bucket, table or length
                tag = np.unique(np.stack([g0[i:j], table[i:j], size[i:j]], 1), axis=0, return_inverse=True)[1].ravel()
                for q in range(tag.max() + 1):
                    r = i + np.flatnonzero(tag == q)
                    left, right = (r[side[r] == x[i]], r[side[r] == y[i]])
                    if x[i] == y[i]:
                        right = left
                    if not len(left) or not len(right):
                        continue
                    tab = int(table[r[0]])
                    unit = {}
                    for name, w in (("l", left), ("r", right)):
                        m = flat[ranges(at[w], size[w])].reshape(len(w), -1).astype(np.float64)
                        m = m / np.abs(m).max(1, keepdims=True)
                        unit[name] = m / np.sqrt((m * m).sum(1, keepdims=True))
                    near = unit["l"] @ unit["r"].T >= threshold - 1e-9
                    a, b = np.nonzero(near)
                    ok = (ids[left[a]] < ids[right[b]]) if x[i] == y[i] else (left[a] != right[b])
                    a, b = a[ok], b[ok]
                    exact = np.einsum("ij,ij->i", unit["l"][a], unit["r"][b]) >= threshold
                    a, b = left[a[exact]], right[b[exact]]
                    if tab and len(a):
                        fresh = ~(keys[a, :tab] == keys[b, :tab]).any(1)
                        a, b = a[fresh], b[fresh]
                    if not len(a):
                        continue
                    for p, o in ((a, b), (b, a)):
                        who, first = np.unique(p, return_index=True)
                        out_id.append(ids[who])
                        out_n.append(np.bincount(np.searchsorted(who, p), n[o], len(who)).astype(np.int64))
                        out_b.append(_tied(ids, p, o, who, first))
            if out_id:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(v)) for v in (out_id, out_n, out_b)], ["id", "links", "b"])

    return together(rows, "g", "x", "y").mapInArrow(run, "id bigint, links bigint, b bigint")


def _tied(ids: np.ndarray, p: np.ndarray, o: np.ndarray, who: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each vector the smallest id among itself and all that hang together with it in this block."""
    nodes, at = np.unique(np.concatenate([p, o]), return_inverse=True)
    a, b = at[:len(p)], at[len(p):]
    low = ids[nodes].copy()
    while True:
        new = low.copy()
        np.minimum.at(new, a, low[b])
        np.minimum.at(new, b, low[a])
        if (new == low).all():
            break
        low = new
    return low[np.searchsorted(nodes, who)]


def near_duplicate_vectors(vectors: DataFrame, key: str = "vec_id", vec: str = "embedding", label: str = "label", threshold: float = 0.93,
                           tables: int = TABLES, projections: int = PROJECTIONS, width: float = WIDTH, seed: int = 7) -> DataFrame:
    """(key, n_links, component_id, kept), one row per vector: links are cosines of at least ``threshold`` inside a label.

    Equal vectors of a label are one node that counts as many times as it occurs, so a hot vector costs
    one row. Buckets are (label, table, quantised projections); larger ones are dealt in blocks and every
    pair of blocks is compared in a task of its own. Vectors that are null, zero, or hold null or
    non-finite components, and rows without label, have no link. Vectors of different lengths never
    link. Rows with equal ids count as separate vectors but name one component; a row without id links
    with nothing. ``projections`` is the parameter to raise when labels hold far more vectors.
    """
    rows = vectors.select(F.col(key).alias("id0"), F.col(vec).alias("v"), F.col(label).alias("label"))
    ok = usable("v") & F.col("label").isNotNull() & F.col("id0").isNotNull()
    # -0.0 and 0.0 are one value
    good = rows.where(ok).withColumn("v", F.transform("v", lambda x: F.when(x == 0, x * 0 + F.lit(0).cast("float")).otherwise(x)))
    good = settle(good.select("id0", "label", "v", F.xxhash64("v").alias("h1"), F.hash("v").alias("h2")), "vectors")
    nodes = good.groupBy("label", "h1", "h2").agg(F.min("id0").cast("bigint").alias("id"), F.count("*").alias("n"), F.first("v").alias("v"))
    nodes = settle(_hash_rows(nodes, tables, projections, width, seed), "hashed")
    post = nodes.select("id", "label", "n", "v", "keys", F.posexplode("keys").alias("tab", "bucket")).withColumn("g", F.xxhash64("label", "tab", "bucket"))
    sizes = post.groupBy("g").agg(F.count("*").alias("m")).where("m > 1").withColumn("nb", F.ceil(F.col("m") / BLOCK).cast("int"))
    post = post.join(sizes, "g").withColumn("side", F.pmod(F.xxhash64("id"), F.col("nb")).cast("int"))
    pairs = F.expr("transform(sequence(0, nb - 1), o -> struct(least(o, side) as x, greatest(o, side) as y))")
    post = post.select("*", F.explode(pairs).alias("xy")).select("g", "xy.x", "xy.y", "side", "tab", "bucket", "id", "n", "v", "keys")
    found = settle(_count_links(post, threshold), "link-counts")
    comp = components(found.select(F.col("id").alias("a"), "b"))
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    per = nodes.select("id", "n").join(links, "id", "left").join(comp, "id", "left").select("id", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    node_of = good.groupBy("label", "h1", "h2").agg(F.min("id0").cast("bigint").alias("id"))
    linked = good.select("id0", "label", "h1", "h2").join(node_of, ["label", "h1", "h2"]).join(per, "id").select("id0", "n_links", "component_id")
    alone = rows.where(~F.coalesce(ok, F.lit(False))).select("id0", F.lit(0).cast("bigint").alias("n_links"), F.col("id0").cast("bigint").alias("component_id"))
    out = linked.unionByName(alone)
    return out.select(F.col("id0").alias(key), "n_links", "component_id", F.col("id0").eqNullSafe(F.col("component_id")).alias("kept"))
