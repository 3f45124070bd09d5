"""Quality classifier by positive-unlabelled learning with the non-negative unbiased risk."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from brisa.llm.common import Rolling, chunks, partitions, text_bytes
from brisa.session import settle

FEATURES = ["bytes", "words", "word_bytes", "distinct_words", "distinct_pairs", "top_word", "repeats_next", "short_words", "long_words", "capital_words",
            "digits", "upper", "commas", "stops", "symbols", "bars", "spaces", "wide", "lines", "line_bytes", "distinct_lines", "lines_without_stop", "entropy", "longest_word"]
BINS = 10
_SYMBOLS = np.frombuffer(b"#%&*+/<=>@[\\]^_`{}~$", np.uint8)


def _distinct(values: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different values and the count of the most frequent one in each stretch of ``values``."""
    row = np.repeat(np.arange(len(at) - 1), np.diff(at))
    o = np.lexsort((values, row))
    v, r = values[o], row[o]
    first = np.flatnonzero(np.append(True, (v[1:] != v[:-1]) | (r[1:] != r[:-1]))) if len(v) else np.zeros(0, np.int64)
    run = np.diff(np.append(first, len(v)))
    top = np.zeros(len(at) - 1)
    np.maximum.at(top, r[first], run)
    return np.bincount(r[first], minlength=len(at) - 1).astype(float), top


def measure(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """FEATURES of all rows of a chunk; an empty row has zeros."""
    n = len(off) - 1
    size = np.diff(off).astype(float)
    row = np.repeat(np.arange(n), np.diff(off))
    share = lambda flag: np.bincount(row, flag, n) / np.maximum(size, 1)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.zeros(len(data) + 1, bool)
    edge[off] = True
    start = np.flatnonzero(~space & (np.roll(space, 1) | edge[:-1]))
    end = np.flatnonzero(~space & (np.roll(space, -1) | edge[1:])) + 1
    at = np.searchsorted(start, off)
    words, w_row = np.diff(at).astype(float), np.repeat(np.arange(n), np.diff(at))
    length = (end - start).astype(float)
    low = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    roll = Rolling(low)
    # commas and stops at the end of a word do not make it another word
    last = low[end - 1] if len(end) else low[:0]
    trimmed = np.maximum(end - ((last == 44) | (last == 46)), start + 1)
    h = roll.of(start, trimmed)
    distinct, top = _distinct(h, at)
    pair = h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:] if len(h) else h
    inside = w_row[:-1] == w_row[1:] if len(h) else np.zeros(0, bool)
    p_at = np.concatenate([[0], np.cumsum(np.bincount(w_row[:-1][inside], minlength=n))]).astype(np.int64) if len(h) else np.zeros(n + 1, np.int64)
    pairs, _ = _distinct(pair[inside], p_at)
    of_words = lambda flag: np.bincount(w_row, flag, n) / np.maximum(words, 1)
    again = np.bincount(w_row[:-1][inside & (h[:-1] == h[1:])], minlength=n) if len(h) else np.zeros(n)
    # a line starts at a row's start and after each break inside the row, and ends at the next break or the row's end
    brk = data == 10
    l_start = np.flatnonzero(np.roll(brk, 1) | edge[:-1])
    l_at = np.searchsorted(l_start, off)
    lines, l_row = np.diff(l_at).astype(float), np.repeat(np.arange(n), np.diff(l_at))
    breaks = np.append(np.flatnonzero(brk), len(data))
    l_end = np.minimum(breaks[np.searchsorted(breaks, l_start)], off[1:][l_row])
    d_lines, _ = _distinct(roll.of(l_start, l_end), l_at)
    open_end = np.bincount(l_row, (l_end == l_start) | (data[l_end - 1] != 46), n) / np.maximum(lines, 1)
    entropy = np.zeros(n)
    kinds = np.bincount(row * 64 + (low & 63), minlength=n * 64).reshape(n, 64) / np.maximum(size, 1)[:, None]
    entropy = -(kinds * np.log2(np.maximum(kinds, 1e-12))).sum(1)
    longest = np.zeros(n)
    np.maximum.at(longest, w_row, length)
    first = data[start] if len(start) else data[:0]
    x = [np.log1p(size), np.log1p(words), np.bincount(w_row, length, n) / np.maximum(words, 1), distinct / np.maximum(words, 1), pairs / np.maximum(words - 1, 1),
         top / np.maximum(words, 1), again / np.maximum(words - 1, 1), of_words(length <= 3), of_words(length >= 13), of_words((first >= 65) & (first <= 90)),
         share((data >= 48) & (data <= 57)), share((data >= 65) & (data <= 90)), np.bincount(row, data == 44, n) / np.maximum(words, 1), np.bincount(row, data == 46, n) / np.maximum(words, 1),
         share(np.isin(data, _SYMBOLS)), share(data == 124), share(space), share(data >= 128), np.log1p(lines), np.log1p(size / np.maximum(lines, 1)),
         d_lines / np.maximum(lines, 1), open_end, entropy, np.log1p(longest)]
    return np.where(size[:, None] > 0, np.stack(x, 1), 0).astype(np.float32)


def features(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, x) with the FEATURES of every whole text; null counts as empty."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, off = text_bytes(b.column(1))
            for i, j in chunks(off):
                x = measure(data[off[i]:off[j]], off[i:j + 1] - off[i])
                k = x.shape[1]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), pa.ListArray.from_arrays(pa.array(np.arange(0, (j - i + 1) * k, k, dtype=np.int32)), pa.array(x.ravel()))], [key, "x"])

    return docs.select(key, "text").mapInArrow(run, f"`{key}` {kind}, x array<float>")


@dataclass(frozen=True)
class Model:
    edges: np.ndarray        # [features, bins - 1]
    weights: np.ndarray      # bias, then features x bins
    prior: float


def _columns(x: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Design columns that are 1 for each row: the bias, and the bin of each feature."""
    bins = edges.shape[1] + 1
    at = [np.zeros(len(x), np.int64)] + [1 + j * bins + np.searchsorted(edges[j], x[:, j], "right") for j in range(x.shape[1])]
    return np.stack(at, 1)


def _moments(rows: DataFrame, edges: np.ndarray) -> tuple[dict, dict, dict]:
    """Counts, means and second moments of the design rows of each ``kind`` (0 unlabelled, 1 positive).

    Tasks add up matrices and send them row by row; the rows are added again where they meet, so what
    reaches the driver has the size of two matrices whatever the input.
    """
    width = 1 + edges.shape[0] * (edges.shape[1] + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {}
        for b in batches:
            kind = b.column(0).to_numpy(zero_copy_only=False)
            x = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
            for k in np.unique(kind).tolist():
                for part in np.array_split(np.flatnonzero(kind == k), max(1, b.num_rows // 2048)):
                    c = _columns(x[part], edges)
                    total[k] = total.get(k, 0) + np.bincount((c[:, :, None] * width + c[:, None, :]).ravel(), minlength=width * width).astype(float)
        for k, flat in total.items():
            m = flat.reshape(width, width)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(width, k, np.int32)), pa.array(np.arange(width, dtype=np.int32)), pa.array(m.tolist(), pa.list_(pa.float64()))], ["kind", "i", "m"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], np.ndarray] = {}
        for b in batches:
            m = b.column(2).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
            for k, i, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), m):
                total[k, i] = total.get((k, i), 0) + v
        for (k, i), v in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([i], pa.int32()), pa.array([v.tolist()], pa.list_(pa.float64()))], ["kind", "i", "m"])

    schema = "kind int, i int, m array<double>"
    got = rows.select("kind", "x").mapInArrow(run, schema).repartition(min(8, partitions(rows.sparkSession)), "kind", "i").mapInArrow(add, schema).collect()
    sums = {k: np.zeros((width, width)) for k in (0, 1)}
    for k, i, m in got:
        sums[k][i] = m
    count = {k: s[0, 0] for k, s in sums.items()}
    return count, {k: s[0] / max(count[k], 1) for k, s in sums.items()}, {k: s / max(count[k], 1) for k, s in sums.items()}


def _times(m: np.ndarray, v: np.ndarray) -> np.ndarray:
    return (m * v).sum(1)


def _solve(m: np.ndarray, v: np.ndarray, steps: int = 1000) -> np.ndarray:
    """Solution of the positive definite system m x = v by conjugate gradients."""
    x, r, scale = np.zeros(len(v)), v.copy(), 1 / m.diagonal()
    p = z = scale * r
    for _ in range(steps):
        if np.abs(r).max() < 1e-12:
            break
        mp = _times(m, p)
        a = (r * z).sum() / (p * mp).sum()
        x, rest = x + a * p, r - a * mp
        nxt = scale * rest
        p, r, z = nxt + (rest * nxt).sum() / (r * z).sum() * p, rest, nxt
    return x


def fit_moments(mean: dict, second: dict, prior: float, ridge: float = 1e-3, steps: int = 500) -> np.ndarray:
    """Weights that minimise the non-negative unbiased risk under squared loss.

    With f = w·z the risk needs the moments of positives and unlabelled rows only:
    prior * E_P[(1 - f)^2] / 4 + max(0, E_U[(1 + f)^2] / 4 - prior * E_P[(1 + f)^2] / 4). While the second
    part is not below zero the minimum solves a linear system. Where that solution has it below zero,
    the weights are led there from 0 by gradient steps, which go back along the second part's gradient
    whenever it is negative.
    """
    base = second[0] + ridge * np.eye(len(mean[0])) + 1e-9
    part = lambda w: 0.25 * ((1 + 2 * (w * mean[0]).sum() + (w * _times(second[0], w)).sum()) - prior * (1 + 2 * (w * mean[1]).sum() + (w * _times(second[1], w)).sum()))
    best = _solve(base, 2 * prior * mean[1] - mean[0])
    if part(best) >= 0:
        return best
    w, rate = np.zeros(len(best)), 0.5 / _times(np.abs(base), np.ones(len(best))).max()
    for _ in range(steps):
        if part(w) >= 0:
            grad = 0.5 * (_times(base, w) + mean[0] - 2 * prior * mean[1])
        else:
            grad = -0.5 * ((mean[0] + _times(second[0], w)) - prior * (mean[1] + _times(second[1], w)))
        w = w - rate * grad
    return w


def fit(x: DataFrame, positives: DataFrame, prior: float, key: str = "doc_id") -> Model:
    """Learns from the features ``x`` of all documents as unlabelled and of the ids in ``positives``."""
    spec = [f"percentile_approx(x[{j}], array({', '.join(str(b / BINS) for b in range(1, BINS))}), 1000) as e{j}" for j in range(len(FEATURES))]
    got = x.selectExpr(*spec).first()
    edges = np.array([got[j] if got[j] is not None else [0.0] * (BINS - 1) for j in range(len(FEATURES))], float)
    pos = x.join(positives.select(key).distinct(), key, "left_semi")
    rows = x.select(F.lit(0).alias("kind"), "x").unionByName(pos.select(F.lit(1).alias("kind"), "x"))
    count, mean, second = _moments(rows, edges)
    w = fit_moments(mean, second, prior) if count[0] and count[1] else np.zeros(1 + edges.shape[0] * BINS)
    return Model(edges, w, prior)


def class_prior(labels: DataFrame, default: float = 0.5) -> float:
    """Share of good ones among the trusted labels; it is all that labels other than good ones are used for."""
    got = labels.agg(F.avg(F.when(F.col("quality") == 1, 1.0).when(F.col("quality") == 0, 0.0))).first()[0]
    return min(max(default if got is None else got, 0.02), 0.98)


def score(x: DataFrame, model: Model, key: str = "doc_id") -> DataFrame:
    """(key, score): (f + 1) / 2 within 0 and 1, an estimate of the probability of being good."""
    kind = x.schema[key].dataType.simpleString()
    edges, weights = model.edges, model.weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            v = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
            f = weights[_columns(v, edges)].sum(1)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.clip((f + 1) / 2, 0, 1))], [key, "score"])

    return x.mapInArrow(run, f"`{key}` {kind}, score double")


def classify(docs: DataFrame, labels: DataFrame, is_train: Column, key: str = "doc_id") -> DataFrame:
    """(key, score, predicted) of every document, learned from the positives among the training labels and all texts.

    Null and empty texts are scored like any other, on zero features. Repeated label rows count once,
    labels without id or quality not at all; without positives every score is 0.5.
    """
    x = settle(features(docs, key), "features")
    train = labels.where(is_train & F.col(key).isNotNull()).select(key, "quality").distinct()
    model = fit(x, train.where("quality = 1"), class_prior(train), key)
    out = score(x, model, key)
    return out.select(key, "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).cast("int").alias("predicted"))
