"""Removal of long repeated word spans through a compacted de Bruijn graph.

Every window of consecutive words is an edge of the de Bruijn graph over the corpus. Edges are not shuffled one by one:
each window has an anchor, the smallest hash among its shorter k-mers, and the consecutive windows of a document that
share an anchor form one path. Paths are compacted and compared by Spark joins on the anchor:

* an anchor that occurs once cannot be part of a repeated window, and its path ends there;
* the occurrences of an anchor that all have the same path (the same words around it) are one nonbranching node of the
  graph: with two occurrences or more all its windows are repeated, and none of them is looked at singly;
* where an anchor branches, one occurrence of each distinct path is unfolded into its windows, each with the number of
  its occurrences, and windows are counted by the hash of their words.

Equal windows have the same anchor at the same place, so no repeat is missed whatever lies around it. The repeated spans
go back to their source coordinates (document, word position); there the words are hashed again, spans whose words have
another hash are not taken, and covered words are removed. Paths and windows are counted by 128 bits of hash. Texts are
compressed before they are joined to their spans.

Defined cases: null and empty texts have no words; texts with fewer words than a window lose nothing; rows that repeat a
text are copies of each other, also with the same id; all counts cover the whole table; only id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesframe.llm.text import SLICE_BYTES, Words, mix, odd_constants, slices, whole_windows, window_hashes, words
from seriesframe.llm.work import stage

#: Words of a window, and of the k-mers its anchor is chosen from.
WINDOW, KMER = 35, 8
#: Seeds of the two hashes of a path or window.
PATH_SEEDS = 31, 37


def anchors(w: Words, window: int, kmer: int) -> tuple[np.ndarray, np.ndarray]:
    """First words of the whole windows of each text, and the word where each window's anchor begins (rightmost least)."""
    first, _ = whole_windows(w.rows, window)
    least = window_hashes(w.hashes, kmer, seed=23)
    place = np.arange(len(least))
    span, width = window - kmer + 1, 1
    while width < span:  # least over twice the width, until the window's k-mers are covered
        step = min(width, span - width)
        a, b = least[: len(least) - step], least[step:]
        right = b <= a
        place = np.where(right, place[step:], place[: len(place) - step])
        least = np.where(right, b, a)
        width += step
    return first, place[first]


def _segments(first: np.ndarray, anchor: np.ndarray, text_of: np.ndarray) -> np.ndarray:
    """Start of each run of consecutive windows with one anchor in one text."""
    if not len(first):
        return np.zeros(0, np.int64)
    new = np.ones(len(first), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (first[1:] != first[:-1] + 1) | (text_of[1:] != text_of[:-1])
    return np.flatnonzero(new)


def _run_hashes(hashes: np.ndarray, begins: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    """A hash of each run of word hashes, which may overlap and differ in length: differences of sums over powers of an
    odd base, so that no word is repeated, however many runs it is in."""
    base = int(odd_constants(1, seed)[0])
    up, down = (np.full(len(hashes) + 1, factor, np.uint64) for factor in (base, pow(base, -1, 1 << 64)))
    for powers in (up, down):
        powers[0] = 1
        np.cumprod(powers, out=powers)
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(mix(hashes + np.uint64(seed)) * up[:-1], out=sums[1:])
    lengths = (ends - begins).astype(np.uint64)
    return mix((sums[ends] - sums[begins]) * down[begins] + lengths * np.uint64(0x9E3779B97F4A7C15))


def _paths_of(w: Words, window: int, kmer: int):
    """text number, first word, windows, anchor hash and path hashes of every path."""
    first, anchor = anchors(w, window, kmer)
    text_of = np.searchsorted(w.rows, first, "right") - 1
    begin = _segments(first, anchor, text_of)
    n = np.diff(np.append(begin, len(first)))
    starts, text_of = first[begin], text_of[begin]
    one, two = (_run_hashes(w.hashes, starts, starts + n + window - 1, seed) for seed in PATH_SEEDS)
    kmers = window_hashes(w.hashes, kmer, seed=29)
    return text_of, starts, n, kmers[anchor[begin]] if len(begin) else kmers[:0], one, two


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64), pa.int64())


def paths(texts: DataFrame, window: int, kmer: int) -> DataFrame:
    """A row per path of (key, text): key, begin (its first window's word), n (windows), anchor and path hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, _, data, offsets in slices(batch.column(1)):
                w = words(data, offsets)
                text_of, starts, n, anchor, one, two = _paths_of(w, window, kmer)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(low + text_of, pa.int64())),
                        pa.array(starts - w.rows[text_of], pa.int32()),
                        pa.array(n, pa.int32()),
                        *map(_signed, (anchor, one, two)),
                    ],
                    names=["key", "begin", "n", "anchor", "path", "path2"],
                )

    return texts.mapInArrow(run, "key long, begin int, n int, anchor long, path long, path2 long")


def _packed(docs: DataFrame) -> DataFrame:
    """key, doc_id and the text compressed: what is joined by key travels in this form."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for low, high, data, offsets in slices(batch.column(2)):
                blob = memoryview(np.ascontiguousarray(data))
                packed = [squeeze.compress(blob[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(low, high - low).columns[:2], pa.array(packed, pa.binary())], names=["key", "doc_id", "packed"]
                )

    return docs.mapInArrow(run, "key long, doc_id long, packed binary")


def _unpacked(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of consecutive texts, about SLICE_BYTES together."""
    loose = zstandard.ZstdDecompressor()
    low, texts, size = 0, [], 0
    for i, blob in enumerate(column):
        texts.append(loose.decompress(blob.as_py()))
        size += len(texts[-1])
        if size >= SLICE_BYTES or i == len(column) - 1:
            offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
            yield low, i + 1, np.frombuffer(b"".join(texts), np.uint8), offsets
            low, texts, size = i + 1, [], 0


def _spans(column: pa.Array, w: Words, window: int, fields: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Of list<struct<begin, n, path, ...>> per text: the spans whose words have the path hash they were found by.

    Returns the first word of each in the slice and the fields.
    """
    counts = np.array([0 if x is None else x for x in pc.list_value_length(column).to_pylist()], np.int64)
    flat = column.flatten()
    values = [flat.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(fields)]
    text_of = np.repeat(np.arange(len(column)), counts)
    starts = values[0] + w.rows[text_of]
    inside = starts + values[1] + window - 1 <= w.rows[text_of + 1]
    values, starts, text_of = [v[inside] for v in values], starts[inside], text_of[inside]
    same = _run_hashes(w.hashes, starts, starts + values[1] + window - 1, PATH_SEEDS[0]).view(np.int64) == values[2]
    return starts[same], [v[same] for v in values] + [text_of[same]]


_REQUEST = "array<struct<begin:int,n:int,path:long,occ:long>>"


def unfold(requests: DataFrame, window: int) -> DataFrame:
    """The windows of the requested paths of (key, doc_id, packed, requests): key, pos, hashes and occurrences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in _unpacked(batch.column(2)):
                w = words(data, offsets)
                starts, (_, n, _, occ, text_of) = _spans(batch.column(3).slice(low, high - low), w, window, 4)
                at = np.cumsum(n) - n
                first = np.arange(int(n.sum())) - np.repeat(at, n) + np.repeat(starts, n)
                text_of = np.repeat(text_of, n)
                one, two = (_run_hashes(w.hashes, first, first + window, seed) for seed in PATH_SEEDS)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(low + text_of, pa.int64())),
                        pa.array(first - w.rows[text_of], pa.int32()),
                        *map(_signed, (one, two)),
                        pa.array(np.repeat(occ, n), pa.int64()),
                    ],
                    names=["key", "pos", "path", "path2", "occ"],
                )

    return requests.mapInArrow(run, "key long, pos int, path long, path2 long, occ long")


def cut(found: DataFrame, window: int) -> DataFrame:
    """doc_id, n_words, n_removed and kept of (key, doc_id, packed, spans)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in _unpacked(batch.column(2)):
                w = words(data, offsets)
                starts, (_, n, _, _) = _spans(batch.column(3).slice(low, high - low), w, window, 3)
                covered = np.zeros(len(w.starts) + 1, np.int64)
                np.add.at(covered, starts, 1)
                np.add.at(covered, starts + n + window - 1, -1)
                stays = np.cumsum(covered[:-1]) == 0
                total = np.concatenate([[0], np.cumsum(stays)])
                kept = total[w.rows[1:]] - total[w.rows[:-1]]
                # the kept words' bytes with one blank after each, but for the last of a text
                begin, end = w.starts[stays], w.ends[stays]
                size = end - begin + 1
                place = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size) + np.repeat(begin, size)
                letters = np.append(data, 0x20)[place].astype(np.uint8)
                edges = np.concatenate([[0], np.cumsum(size)])
                letters[edges[1:] - 1] = 0x20
                blob = letters.tobytes()
                edge = edges[np.concatenate([[0], np.cumsum(kept)])].tolist()
                texts = [blob[a : max(a, b - 1)] for a, b in zip(edge[:-1], edge[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(1).slice(low, high - low),
                        pa.array(np.diff(w.rows), pa.int64()),
                        pa.array(np.diff(w.rows) - kept, pa.int64()),
                        pa.array(texts, pa.binary()).cast(pa.string()),
                    ],
                    names=["doc_id", "n_words", "n_removed", "kept"],
                )

    return found.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept string")


def remove_repeats(
    docs: DataFrame, window: int = WINDOW, kmer: int = KMER, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_words, n_removed and kept (the words left, joined by blanks) of every document."""
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    ).select(F.xxhash64("doc_id", "text").alias("key"), "doc_id", "text")
    every = paths(rows.select("key", "text"), window, kmer)
    # keys are written before they are joined: only a join of two plain shuffles is split where a key is hot
    often = stage(every.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("anchor"), "anchors")
    repeated = stage(every.join(often, "anchor", "left_semi"), "paths")

    distinct = stage(
        repeated.groupBy("anchor", "path", "path2").agg(
            F.count(F.lit(1)).alias("occ"), F.min(F.struct("key", "begin", "n")).alias("one")
        ),
        "distinct-paths",
    )
    branching = stage(
        distinct.groupBy("anchor")
        .agg(F.count(F.lit(1)).alias("branches"), F.min("occ").alias("least"))
        .filter("branches > 1 and least = 1")
        .select("anchor"),
        "branching",
    )
    requests = (
        distinct.join(branching, "anchor", "left_semi")
        .groupBy("one.key")
        .agg(F.collect_list(F.struct("one.begin", "one.n", "path", "occ")).cast(_REQUEST).alias("requests"))
    )
    packed = _packed(rows)
    windows = stage(unfold(packed.join(requests, "key"), window), "windows")
    shared = stage(
        windows.groupBy("path", "path2").agg(F.sum("occ").alias("all")).filter("all > 1").select("path", "path2"), "shared"
    )
    single = windows.filter("occ = 1").join(shared, ["path", "path2"], "left_semi")
    whole = repeated.join(distinct.filter("occ > 1").select("path", "path2"), ["path", "path2"], "left_semi")
    spans = (
        whole.select("key", "begin", "n", "path")
        .unionByName(single.select("key", F.col("pos").alias("begin"), F.lit(1).alias("n"), "path"))
        .groupBy("key")
        .agg(F.collect_list(F.struct("begin", "n", "path")).alias("spans"))
    )
    return cut(packed.join(spans, "key", "left"), window)
