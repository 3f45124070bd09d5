"""Language identification: script ranges narrow the candidates, Viterbi over per-word scores labels the spans."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from brisa.llm.common import CHUNK, chunks, mix, small_batches, text_bytes

BUCKETS = 1 << 14       # hashed byte trigrams; the model has (languages x BUCKETS) numbers
# First code point of each script range; a word belongs to the range of its first letter outside ASCII, else to Latin.
SCRIPT_FROM = [0x0, 0x370, 0x400, 0x530, 0x590, 0x600, 0x900, 0xE00, 0x10A0, 0x1100, 0x1E00, 0x1F00, 0x2000, 0x3040, 0x3400, 0xAC00, 0xD7B0]
SCRIPT_NAMES = ["Latin", "Greek", "Cyrillic", "Armenian", "Hebrew", "Arabic", "Indic", "Thai and others", "Georgian", "Hangul letters", "Latin",
                "Greek", "other", "Kana", "Han", "Hangul", "other"]
SCRIPTS = sorted(set(SCRIPT_NAMES))


@dataclass(frozen=True)
class Model:
    """Log scores of trigram buckets by language, and which languages are written in which script."""

    langs: list[str]
    score: np.ndarray       # float32 [BUCKETS, languages]
    usual: np.ndarray       # [languages] mean score of a letter in the training texts
    depth: np.ndarray       # [languages] how far below that a letter in a trigram never seen scores
    allowed: np.ndarray     # bool [scripts, languages]


def _words(data: np.ndarray, off: np.ndarray):
    """Words of a chunk: lowered bytes, flags of word bytes, start and end of words, row of each word, script of each word."""
    low = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    letter = ((low >= 97) & (low <= 122)) | (low >= 128)
    brk = np.zeros(len(low) + 1, bool)
    brk[off[:-1]] = True                                    # a word never goes over from one row to the next
    before = np.concatenate([[False], letter[:-1]]) if len(low) else np.zeros(0, bool)
    start = np.flatnonzero(letter & (~before | brk[:-1]))
    after = np.concatenate([letter[1:], [False]]) if len(low) else np.zeros(0, bool)
    end = np.flatnonzero(letter & (~after | brk[1:])) + 1
    row = np.searchsorted(off, start, "right") - 1
    code = np.zeros(len(low) + 3, np.int64)
    wide = np.concatenate([low, np.zeros(3, np.uint8)]).astype(np.int64)
    two, three, four = (wide >= 0xC0) & (wide < 0xE0), (wide >= 0xE0) & (wide < 0xF0), wide >= 0xF0
    nxt, nxt2 = np.roll(wide, -1) & 63, np.roll(wide, -2) & 63
    code[two] = ((wide & 31) << 6 | nxt)[two]
    code[three] = ((wide & 15) << 12 | nxt << 6 | nxt2)[three]
    code[four] = 0x20000
    script_of = np.array([SCRIPTS.index(s) for s in SCRIPT_NAMES])
    lead = np.flatnonzero(two | three | four)
    script = np.full(len(start), SCRIPTS.index("Latin"))
    if len(lead) and len(start):
        w = np.searchsorted(start, lead, "right") - 1
        ok = (w >= 0) & (lead < end[np.maximum(w, 0)])
        lead, w = lead[ok][::-1], w[ok][::-1]               # the first letter of a word is written last
        s = script_of[np.searchsorted(SCRIPT_FROM, code[lead], "right") - 1]
        s = np.where(code[lead] >= 0x20000, SCRIPTS.index("Han"), s)
        script[w] = s
    return low, letter, start, end, row, script


def _trigrams(low: np.ndarray, letter: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Bucket of the byte trigram around each byte; what is no letter counts as a blank, as does the edge of a row."""
    x = np.where(letter, low, 32).astype(np.uint64)
    prev, nxt = np.roll(x, 1), np.roll(x, -1)
    filled = np.flatnonzero(off[1:] > off[:-1])
    prev[off[:-1][filled]] = 32
    nxt[off[1:][filled] - 1] = 32
    return (mix(prev << np.uint64(16) | x << np.uint64(8) | nxt) & np.uint64(BUCKETS - 1)).astype(np.int64)


def fit(docs: DataFrame, is_train: Column, smooth: float = 0.5, script_share: float = 0.001) -> Model:
    """Learns from all rows with ``is_train`` and a known language: trigram and script counts by language.

    Tasks count in arrays and send one row per (language, bucket) seen; the sums are aggregated by
    Spark, and only the model reaches the driver, whose size depends on the number of languages alone.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for b in batches:
            data, off = text_bytes(b.column(0))
            langs = np.array(b.column(1).to_pylist(), object)
            for i, j in chunks(off, CHUNK):
                d, o = data[off[i]:off[j]], off[i:j + 1] - off[i]
                if not len(d):
                    continue
                low, letter, start, end, row, script = _words(d, o)
                tri = _trigrams(low, letter, o)
                who = np.repeat(np.arange(j - i), np.diff(o))
                names, idx = np.unique(langs[i:j].astype(str), return_inverse=True)
                for n, name in enumerate(names):
                    c = total.setdefault(name, np.zeros(BUCKETS + len(SCRIPTS), np.int64))
                    c[:BUCKETS] += np.bincount(tri[(idx[who] == n) & letter], minlength=BUCKETS)
                    c[BUCKETS:] += np.bincount(script[idx[row] == n], minlength=len(SCRIPTS))
        for name, c in total.items():
            k = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(k), pa.string()), pa.array(k, pa.int32()), pa.array(c[k])], ["lang", "k", "n"])

    small_batches(docs.sparkSession)
    counts = (docs.where(is_train & F.col("lang").isNotNull()).select("text", "lang").mapInArrow(run, "lang string, k int, n bigint")
              .groupBy("lang", "k").agg(F.sum("n").alias("n")).toPandas())
    langs = sorted(counts.lang.unique())
    table = np.zeros((BUCKETS + len(SCRIPTS), len(langs)))
    table[counts.k.to_numpy(), [langs.index(x) for x in counts.lang]] = counts.n
    grams, scripts = table[:BUCKETS] + smooth, table[BUCKETS:]
    score = np.log(grams / grams.sum(0)).astype(np.float32)
    usual = (table[:BUCKETS] * score).sum(0) / np.maximum(table[:BUCKETS].sum(0), 1)
    depth = np.maximum(usual - np.log(smooth / grams.sum(0)), 1e-9)
    allowed = scripts > script_share * np.maximum(scripts.sum(0), 1)
    allowed[~allowed.any(1)] = True          # a script that no training text uses narrows nothing
    return Model(langs, score, usual, depth, allowed)


def viterbi(score: np.ndarray, row: np.ndarray, penalty: float) -> np.ndarray:
    """Best language of every word: the sum of word scores less ``penalty`` for each switch inside a row.

    All rows of the chunk advance together, word by word, the longest first.
    """
    n, k = score.shape
    path = np.zeros(n, np.int64)
    if not n:
        return path
    first = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
    length = np.diff(np.append(first, n))
    order = np.argsort(-length, kind="stable")
    first, length = first[order], length[order]
    active = np.searchsorted(-length, -np.arange(length[0]), "left")        # rows with more than t words
    back = np.zeros((n, k), bool)                                            # came by a switch
    best_before = np.zeros(n, np.int64)
    best = score[first].astype(np.float64)
    final = best
    for t in range(1, int(length[0])):
        m = active[t]
        cur, at = best[:m], first[:m] + t
        top = cur.argmax(1)
        jump = cur[np.arange(m), top] - penalty
        best_before[at] = top
        back[at] = cur < jump[:, None]
        best[:m] = np.maximum(cur, jump[:, None]) + score[at]
    path_state = final.argmax(1)
    for t in range(int(length[0]) - 1, 0, -1):
        m = active[t]
        at = first[:m] + t
        path[at] = path_state[:m]
        path_state[:m] = np.where(back[at, path_state[:m]], best_before[at], path_state[:m])
    path[first] = path_state
    return path


def label_words(data: np.ndarray, off: np.ndarray, model: Model, penalty: float):
    """(start, end, row, language index, gap) of every word of a chunk; the gap is its score less what its letters usually score, in units of a letter never seen."""
    low, letter, start, end, row, script = _words(data, off)
    if not len(start):
        return start, end, row, np.zeros(0, np.int64), np.zeros(0)
    tri = _trigrams(low, letter, off)
    gain = model.score[tri]
    gain[~letter] = 0
    words = np.add.reduceat(gain, start, axis=0)
    own = words
    words = np.where(model.allowed[script], words, words.min(1, keepdims=True) - np.float32(50))
    lang = viterbi(words, row, penalty)
    return start, end, row, lang, (own[np.arange(len(lang)), lang] - (end - start) * model.usual[lang]) / model.depth[lang]


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def spans(docs: DataFrame, model: Model, key: str = "doc_id", penalty: float = 12.0) -> DataFrame:
    """(key, lang_pred, score, spans) of every whole text; spans: array of (lang, start, end) in bytes.

    ``lang_pred`` is the language with the most bytes of words, ``score`` its share of them. Null texts
    and texts without a letter are ``und`` with score 0 and no spans; ties go to the language first in
    order; a model without languages calls all ``und``. Only the text is read for a prediction. No shuffle.
    """
    kind = docs.schema[key].dataType.simpleString()
    langs, k = model.langs, len(model.langs)
    span_type = pa.list_(pa.struct([("lang", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, off = text_bytes(b.column(1))
            pred, score, found = ["und"] * b.num_rows, [0.0] * b.num_rows, [[] for _ in range(b.num_rows)]
            for i, j in chunks(off, 4 * CHUNK) if k else ():
                d, o = data[off[i]:off[j]], off[i:j + 1] - off[i]
                if not len(d):
                    continue
                start, end, row, lang, _ = label_words(d, o, model, penalty)
                if not len(start):
                    continue
                weight = np.bincount(row * k + lang, end - start, (j - i) * k).reshape(j - i, k)
                ascii_letters = np.bincount(row, np.isin(d[start] | 32, np.arange(97, 123)), j - i)
                turn = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (lang[1:] != lang[:-1])))
                last = np.append(turn[1:], len(row)) - 1
                for t, e in zip(turn.tolist(), last.tolist()):
                    r = int(row[t])
                    found[i + r].append({"lang": langs[lang[t]], "start": int(start[t] - o[r]), "end": int(end[e] - o[r])})
                for r in np.flatnonzero(weight.sum(1)).tolist():
                    if ascii_letters[r] or has_letter(b.column(1)[i + r].as_py()):
                        top = int(weight[r].argmax())
                        pred[i + r], score[i + r] = langs[top], float(weight[r, top] / weight[r].sum())
                    else:
                        found[i + r] = []
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(found, span_type)],
                                             [key, "lang_pred", "score", "spans"])

    return docs.select(key, "text").mapInArrow(run, f"`{key}` {kind}, lang_pred string, score double, spans array<struct<lang:string,start:bigint,end:bigint>>")


LEAST_FIT = -0.52    # 0: letters score as in the training texts of their word's language; -1: in trigrams never seen there


def _fit(data: np.ndarray, off: np.ndarray, model: Model, penalty: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per row of a batch: mean gap of its letters (NaN without a word), and whether an ASCII letter begins a word."""
    fit, latin = np.full(len(off) - 1, np.nan), np.zeros(len(off) - 1, bool)
    for i, j in chunks(off, CHUNK) if model.langs else ():       # a batch carries whole rows besides, so chunks are small
        d, o = data[off[i]:off[j]], off[i:j + 1] - off[i]
        if not len(d):
            continue
        start, end, row, _, gap = label_words(d, o, model, penalty)
        n = np.bincount(row, end - start, j - i)
        fit[i:j] = np.where(n > 0, np.bincount(row, gap, j - i) / np.maximum(n, 1), np.nan)
        latin[i:j] = np.bincount(row, np.isin(d[start] | 32, np.arange(97, 123)), j - i) > 0
    return fit, latin


def keep_known(docs: DataFrame, model: Model, least_fit: float = LEAST_FIT, penalty: float = 12.0, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text is written in the languages of the model, one or several.

    Every word is labelled as :func:`spans` does; a text stays if its letters on average score at least
    ``least_fit`` of the way from what they usually score in their words' languages (0) to what letters in
    trigrams never seen there score (-1). So clean texts that mix languages stay, and random strings and languages that were not learned go. Null
    texts, texts without a letter and, under a model without languages, all texts go. Rows are filtered
    where they lie: nothing is shuffled, other columns and repeated rows stay as they are.
    """
    small_batches(docs.sparkSession)
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fit, latin = _fit(*text_bytes(b.column(at)), model, penalty)
            good = fit >= least_fit
            yield b.filter(pa.array([bool(g and (x or has_letter(b.column(at)[r].as_py()))) for r, (g, x) in enumerate(zip(good, latin))], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def fits(docs: DataFrame, model: Model, key: str = "doc_id", penalty: float = 12.0) -> DataFrame:
    """(key, fit): the mean gap by which :func:`keep_known` judges each text; null for texts without a word."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fit, _ = _fit(*text_bytes(b.column(1)), model, penalty)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fit, mask=np.isnan(fit))], [key, "fit"])

    return docs.select(key, "text").mapInArrow(run, f"`{key}` {kind}, fit double")
