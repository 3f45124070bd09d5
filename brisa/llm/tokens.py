"""Token counts of whole texts, with overlap resynchronisation for huge ones."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

HUGE, OVERLAP = 1 << 15, 256
_CUT = re.compile(r"[ \t\r\n]+")


class PieceCounts(dict):
    """Tokens of each piece between white space, as the library counts it; forgets all when full."""

    def __init__(self, count: Callable[[str], int], most: int = 1 << 20):
        super().__init__()
        self.count, self.most = count, most

    def __missing__(self, piece: str) -> int:
        if len(self) >= self.most:
            self.clear()
        n = self[piece] = self.count(piece)
        return n


def splice(text: str, encode: Callable[[str], list[tuple[int, int]]], chunk: int = HUGE, overlap: int = OVERLAP) -> int:
    """Tokens of ``text`` from overlapping chunks.

    ``encode`` gives the character offsets of a text's tokens. Two neighbouring chunks are joined at a
    position in their overlap that begins a token in both encodings and follows white space: there
    the tokenizer itself always cuts, whatever stands around, so the boundary is proven to be stable.
    Where the overlap has none, it is widened to twice its length, up to the whole rest of the text.
    """
    total, begin = 0, 0                      # tokens before ``begin`` are counted
    while True:
        end, lap = min(len(text), begin + chunk), overlap
        if end == len(text):
            return total + len(encode(text[begin:]))
        while True:
            end = min(len(text), max(end, begin + 2 * lap))
            left = encode(text[begin:end])
            if end == len(text):
                return total + len(left)
            start = max(begin + 1, end - lap)
            gaps = [m.end() for m in _CUT.finditer(text, start, end) if m.end() < end]
            if gaps:
                a = gaps[0]                  # the right-hand chunk starts at white space
                right = encode(text[a:min(len(text), end + lap)])
                mine = {s + begin for s, _ in left}
                common = [g for g in gaps if g in mine and any(s + a == g for s, _ in right)]
                if common:
                    cut = common[len(common) // 2]
                    total += sum(1 for s, _ in left if s + begin < cut)
                    begin = cut
                    break
            lap *= 2
            end = min(len(text), end + lap)


def count_tokens(docs: DataFrame, tokenizer_path: str, key: str = "doc_id", limit: int = 2048, huge: int = HUGE) -> DataFrame:
    """(key, n_bytes, n_tokens, over_limit) of every text.

    Texts shorter than ``huge`` characters are counted piece by piece between plain white space, with
    a bounded memory of pieces; longer ones are encoded in overlapping chunks and spliced. Null and
    empty texts have no tokens; a repeated row is counted each time. No shuffle.
    """
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(tokenizer_path)

        def size(piece: str) -> int:
            return len(t.encode(piece, add_special_tokens=False).ids) if piece else 0

        def offsets(part: str) -> list[tuple[int, int]]:
            return t.encode(part, add_special_tokens=False).offsets

        pieces = PieceCounts(size)
        for b in batches:
            n_bytes, n_tokens = [], []
            for x in b.column(1).to_pylist():
                x = x or ""
                n_bytes.append(len(x.encode()))
                if len(x) < huge:
                    words = x.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
                    n_tokens.append(sum(map(pieces.__getitem__, words)))
                else:
                    n_tokens.append(splice(x, offsets))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64()),
                                              pa.array([n > limit for n in n_tokens], pa.bool_())], [key, "n_bytes", "n_tokens", "over_limit"])

    return docs.select(key, "text").mapInArrow(run, f"`{key}` {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")
