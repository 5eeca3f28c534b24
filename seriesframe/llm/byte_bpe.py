"""Byte-level BPE as a monoid tree: halves are encoded recursively and joined by re-encoding around the cut.

A text is halved until a leaf is short, and the library encodes the leaves. Two neighbours are joined by a window
around their cut that grows until both its ends are *stable*: a blank after a letter or digit. The pattern never
matches a non-blank followed by a blank, looks ahead by one character at most and never looks back, so no match can
reach over such a place and the matches on either side are the same with or without the other side. The tokens outside
the window are therefore final; the ones inside are replaced by those of the window. A side without a stable place is
taken whole, so that texts without blanks are right as well. Decoding joins the bytes of the halves.

Defined cases: a null text counts as empty and has no tokens; special-token strings are ordinary text; texts of any
length are encoded whole; rows are independent, so repeated ids and empty tables need no care.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesframe.llm.text import slices

#: Characters of a leaf.
LEAF = 2048
#: Characters on each side of a cut that a window begins with.
WINDOW = 24
#: Ids of a leaf when decoding.
DECODE_LEAF = 4096


def read_ranks(blob: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in blob.splitlines() if line)}


class TreeBpe:
    """Encoder and decoder over one vocabulary of ranks."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, leaf: int = LEAF):
        self.plain = tiktoken.Encoding("tree", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.leaf = leaf

    def encode(self, text: str) -> list[int]:
        return self._encode(text, 0, len(text))

    def _encode(self, text: str, low: int, high: int) -> list[int]:
        if high - low <= self.leaf:
            return self.plain(text[low:high])
        cut = (low + high) // 2
        return self._join(text, low, cut, high, self._encode(text, low, cut), self._encode(text, cut, high))

    def _join(self, text: str, low: int, cut: int, high: int, left: list[int], right: list[int]) -> list[int]:
        if text[cut] in " \n" and text[cut - 1].isalnum():
            return left + right
        begin, end = self._stable_before(text, low, cut), self._stable_after(text, cut, high)
        replaced = len(self.plain(text[begin:cut])) if begin > low else len(left)
        skipped = len(self.plain(text[cut:end])) if end < high else len(right)
        return left[: len(left) - replaced] + self.plain(text[begin:end]) + right[skipped:]

    @staticmethod
    def _stable_before(text: str, low: int, cut: int) -> int:
        width = WINDOW
        while True:
            floor = max(low, cut - width)
            for at in range(cut - 1, floor, -1):
                if text[at] in " \n" and text[at - 1].isalnum():
                    return at
            if floor == low:
                return low
            cut, width = floor + 1, 2 * width

    @staticmethod
    def _stable_after(text: str, cut: int, high: int) -> int:
        width = WINDOW
        while True:
            ceiling = min(high, cut + width)
            for at in range(cut + 1, ceiling):
                if text[at] in " \n" and text[at - 1].isalnum():
                    return at
            if ceiling == high:
                return high
            cut, width = ceiling - 1, 2 * width

    def decode(self, ids: list[int]) -> bytes:
        if len(ids) <= DECODE_LEAF:
            return b"".join(map(self.bytes_of.__getitem__, ids))
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


def encode(docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids (binary: little-endian unsigned 32-bit) of every whole text."""
    blob = _sent(docs, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = TreeBpe(read_ranks(blob.value), pattern)
        for batch in batches:
            for low, high, _, _ in slices(batch.column(1)):
                ids = [np.array(tree.encode(t), "<u4") for t in batch.column(1).slice(low, high - low).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(low, high - low),
                        pa.array([len(x) for x in ids], pa.int64()),
                        pa.array([x.tobytes() for x in ids], pa.binary()),
                    ],
                    names=["doc_id", "n_tokens", "ids"],
                )

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    return texts.mapInArrow(run, "doc_id long, n_tokens long, ids binary")


def decode(encoded: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """`encoded` with the column decoded (binary)."""
    blob = _sent(encoded, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = TreeBpe(read_ranks(blob.value), pattern)
        for batch in batches:
            for low in range(0, batch.num_rows, 500):
                part = batch.slice(low, 500)
                texts = [tree.decode(np.frombuffer(x, "<u4").tolist()) for x in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(texts, pa.binary())], names=["doc_id", "n_tokens", "ids", "decoded"]
                )

    columns = encoded.select("doc_id", "n_tokens", "ids")
    return columns.mapInArrow(run, "doc_id long, n_tokens long, ids binary, decoded binary")


def _sent(df: DataFrame, path: str):
    """The vocabulary file, read once by the driver (its size is fixed) and broadcast."""
    with open(path, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())
