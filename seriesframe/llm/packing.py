"""Packing without padding: every document is cut into pieces whose lengths are powers of two.

A document of n tokens gives n // longest pieces of the greatest length and then one piece for each binary digit of the
rest, greatest first. Every piece is a sequence of its own, so no sequence crosses documents and none is padded; the
bucket of a sequence is its length, and batches are made within buckets. Pieces come from their document alone: nothing
is shuffled. `sequence_id` holds the bucket in its upper bits, so that sorting or range-partitioning by it brings equal
lengths together, and the row's number in its task below them.

Defined cases: a null or empty text has the end id only and gives one piece of length 1; whole texts of any length are
cut; rows that repeat an id give pieces of their own; only the id and text columns are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from seriesframe.llm.text import slices

#: Words and parts of words whose ids a worker remembers; it starts anew beyond.
REMEMBERED = 800_000
#: Bits below the bucket in sequence_id; Spark's row numbers (task, row) stay below for 2**26 tasks.
BUCKET_SHIFT = 59

#: Latin letters whose lower case is one letter, then ASCII punctuation without the apostrophe.
_LATIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-įı-ňŊ-ž]+)([!-&(-/:-@\[-`{-~]*)")


class WordIds:
    """Ids of whole texts, word by word, as packed little-endian unsigned 32-bit integers.

    The tokenizer drops white space and merges only inside words, so a text's ids are those of its blank-separated words
    one after another. A worker encodes each new word once. Letters of the Latin alphabets with ASCII punctuation behind
    them, which normalisation only lower-cases and the tokenizer's pattern cuts in two, go straight to the library's
    merges; every other word goes through the whole tokenizer.
    """

    def __init__(self, tokenizer_json: str):
        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.tokenizer.encode_special_tokens = True
        self.merge = self.tokenizer.model.tokenize
        self.visible = str.maketrans(_byte_letters())
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, bytes] = {"": b""}
        self.parts: dict[str, bytes] = {"": b""}

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [t.replace("\n", " ").split(" ") for t in texts]
        if len(self.known) + len(self.parts) > REMEMBERED:
            self.forget()
        new = set().union(*split).difference(self.known)
        if new:
            self._learn(new)
        return [b"".join(map(self.known.__getitem__, words)) for words in split]

    def _learn(self, new: set[str]) -> None:
        others = []
        for word in new:
            if cut := _LATIN.fullmatch(word):
                self.known[word] = self._part(cut[1].lower()) + self._part(cut[2])
            else:
                others.append(word)
        if others:
            self._learn_others(others)

    def _part(self, letters: str) -> bytes:
        ids = self.parts.get(letters)
        if ids is None:
            seen = letters if letters.isascii() else letters.encode().decode("latin-1").translate(self.visible)
            ids = self.parts[letters] = np.array([t.id for t in self.merge(seen)], "<u4").tobytes()
        return ids

    def _learn_others(self, new: list[str]) -> None:
        found = self.tokenizer.encode(" ".join(new), add_special_tokens=False)
        ids = np.array(found.ids, "<u4")
        begins = np.array([begin for begin, _ in found.offsets], np.int64)
        lengths = np.array([len(w) + 1 for w in new], np.int64)
        edges = np.searchsorted(begins, np.append(0, np.cumsum(lengths)))
        packed = ids.tobytes()
        for word, a, b in zip(new, (4 * edges[:-1]).tolist(), (4 * edges[1:]).tolist(), strict=True):
            self.known[word] = packed[a:b]


def _byte_letters() -> dict[str, str]:
    """The letters that stand for bytes before merges: printable Latin-1 for themselves, the others from U+0100 on."""
    shown = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): chr(b) for b in shown} | {chr(b): chr(256 + n) for n, b in enumerate(hidden)}


def lengths_of(n: int, longest: int) -> list[int]:
    """Piece lengths of a document of n tokens."""
    rest = n % longest
    return [longest] * (n // longest) + [1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1]


def pack(
    docs: DataFrame,
    tokenizer_file: str,
    longest: int = 4096,
    end_id: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """A row per piece: doc_id, start, length, ids (binary), doc_tokens, bucket (log2 of length), sequence_id, offset."""
    if longest & (longest - 1):
        raise ValueError("the greatest length must be a power of two")
    with open(tokenizer_file, encoding="utf-8") as f:
        sent = docs.sparkSession.sparkContext.broadcast(f.read())
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordIds(sent.value)
        for batch in batches:
            for low, high, _, _ in slices(batch.column(1)):
                coded = known.encode(batch.column(1).slice(low, high - low).to_pylist())
                ids = batch.column(0).slice(low, high - low).to_pylist()
                doc, start, length, piece, total = [], [], [], [], []
                for doc_id, body in zip(ids, coded, strict=True):
                    body += end
                    at, n = 0, len(body) // 4
                    for size in lengths_of(n, longest):
                        doc.append(doc_id)
                        start.append(at)
                        length.append(size)
                        piece.append(body[4 * at : 4 * (at + size)])
                        total.append(n)
                        at += size
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, pa.int64()) for x in (doc, start, length)]
                    + [pa.array(piece, pa.binary()), pa.array(total, pa.int64())],
                    names=["doc_id", "start", "length", "ids", "doc_tokens"],
                )

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    pieces = texts.mapInArrow(run, "doc_id long, start long, length long, ids binary, doc_tokens long")
    bucket = F.round(F.log2("length")).cast("int")
    return (
        pieces.withColumn("bucket", bucket)
        .withColumn("sequence_id", F.shiftleft(F.col("bucket").cast("long"), BUCKET_SHIFT) + F.monotonically_increasing_id())
        .withColumn("offset", F.lit(0).cast("long"))
    )
