"""Quality rules and a target likelihood ratio over hashed n-grams.

Rules per document come from its words alone. The verdict compares two multinomials over hashed word n-grams (one and
two words): the trusted target, fitted on the documents labelled good, and the raw corpus, fitted on all documents. A
document's score is the sum of log(target / raw) over its n-grams divided by their number and a constant, and it is kept when the
score reaches a threshold. Half of the labelled documents fit the target, the others the threshold: the cut between two
score bins that drops the most bad and the fewest good ones, as shares of their class, a good one counting ten times;
without bad or good labels nothing is dropped. Every count covers the whole table; each task sends one row per bucket at most, and the driver
receives one row per bucket and per score bin, however large the corpus is.

Defined cases: a null text has no words; a document without n-grams has score 0; labels of unknown ids and null labels
are ignored, and an id with both labels counts as bad; only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesframe.llm.text import Words, mix, slices, span_hashes, whole_windows, window_hashes, words

#: log2 of the hash buckets, for one-word and two-word grams together.
BUCKET_BITS = 17
#: Neutral n-grams that every text is taken to have besides its own, so that a few rare words decide little.
NEUTRAL = 32
#: Most labelled documents of each quality that the target and the threshold are fitted on.
SAMPLE = 20_000
#: Dropped bad documents that one dropped good document outweighs, as shares of their classes.
GOOD_WEIGHT = 10
#: Width of the bins in which labelled scores are counted.
BIN = 0.01
#: Fewest words, window of the repetition rule, and its percentage of repeated words.
LEAST_WORDS, REPEAT_WINDOW, REPEAT_PERCENT = 10, 5, 20

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def gram_buckets(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of every one-word and two-word gram, in the order of texts, and offsets per text."""
    single = w.hashes
    text_of = w.text_of
    pairs = window_hashes(single, 2, seed=11)
    inside = text_of[1:] == text_of[:-1] if len(text_of) > 1 else np.zeros(0, bool)
    grams = np.concatenate([single, pairs[inside]])
    owner = np.concatenate([text_of, text_of[1:][inside]]) if len(text_of) > 1 else text_of
    order = np.argsort(owner, kind="stable")
    return (grams[order] >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), np.searchsorted(
        owner[order], np.arange(len(w.rows))
    )


@dataclass
class Rules:
    """Counts of each text of a slice."""

    n_words: np.ndarray
    word_chars: np.ndarray
    n_symbols: np.ndarray
    n_dup_lines: np.ndarray
    n_repeat_words: np.ndarray


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _repeated(keys: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether a key occurs twice or more in its owner, and whether it did so earlier."""
    order = np.lexsort((np.arange(len(keys)), keys, owner))
    k, o = keys[order], owner[order]
    same = (k[1:] == k[:-1]) & (o[1:] == o[:-1])
    again, before = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    before[order[1:][same]] = True
    return again, before


def rules(data: np.ndarray, offsets: np.ndarray, w: Words) -> Rules:
    """The base counts of the texts laid end to end in `data`."""
    n = len(offsets) - 1
    starts_char = (data & 0xC0) != 0x80
    in_word = np.zeros(len(data) + 1, np.int8)
    in_word[w.starts] += 1
    in_word[w.ends] -= 1
    word_chars = _per_text(starts_char & (np.cumsum(in_word[:-1], dtype=np.int64) > 0), offsets)

    first, counts = whole_windows(w.rows, REPEAT_WINDOW)
    owner = np.repeat(np.arange(n), counts)
    covered = np.zeros(len(w.starts) + 1, np.int32)
    if len(first):
        twice, _ = _repeated(window_hashes(w.hashes, REPEAT_WINDOW)[first], owner)
        covered[first[twice]] += 1
        covered[first[twice] + REPEAT_WINDOW] -= 1
    repeat_words = _per_text(np.cumsum(covered[:-1]) > 0, w.rows)

    return Rules(
        np.diff(w.rows), word_chars, _per_text(_SYMBOL[data], offsets), _dup_lines(data, offsets, w), repeat_words
    )


def _dup_lines(data: np.ndarray, offsets: np.ndarray, w: Words) -> np.ndarray:
    n = len(offsets) - 1
    breaks = np.flatnonzero(data == 0x0A)
    begins = np.concatenate([offsets[:-1], breaks + 1])
    finishes = np.concatenate([offsets[1:], breaks])
    begins.sort(kind="stable")
    finishes.sort(kind="stable")
    with_word = np.searchsorted(w.starts, finishes) > np.searchsorted(w.starts, begins)
    begins, finishes = begins[with_word], finishes[with_word]
    owner = np.searchsorted(offsets, begins, "right") - 1
    _, before = _repeated(span_hashes(data, begins, finishes, seed=5), owner)
    return np.bincount(owner[before], minlength=n)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def marked(labels: DataFrame, most: int = SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    """Ids and quality of at most `most` labelled documents of each quality, the first in hash order."""
    marks = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
        .filter("doc_id is not null and quality in (0, 1)")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
    )
    picked = [marks.filter(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most) for q in (0, 1)]
    rows = picked[0].unionByName(picked[1]).toArrow()
    ids = rows["doc_id"].to_numpy()
    order = np.argsort(ids)
    return ids[order], rows["quality"].to_numpy()[order]


def quality_of(ids: pa.Array, marks: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """1, 0, or -1 where an id is not among the marks."""
    known, quality = marks
    found = np.full(len(ids), -1)
    if len(known):
        mine = ids.fill_null(known[0]).to_numpy(zero_copy_only=False)
        at = np.minimum(np.searchsorted(known, mine), len(known) - 1)
        hit = (known[at] == mine) & ids.is_valid().to_numpy(zero_copy_only=False)
        found[hit] = quality[at[hit]]
    return found


def gram_counts(texts: DataFrame, marks: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Counts per bucket in the good marked texts and in all texts; each task adds up its own texts first."""
    sent = texts.sparkSession.sparkContext.broadcast(marks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 1 << BUCKET_BITS), np.int64)
        for batch in batches:
            good = quality_of(batch.column(0), sent.value) == 1
            for low, high, data, offsets in slices(batch.column(1)):
                buckets, rows = gram_buckets(words(data, offsets))
                total[1] += np.bincount(buckets, minlength=total.shape[1])
                chosen = np.repeat(good[low:high], np.diff(rows))
                total[0] += np.bincount(buckets[chosen], minlength=total.shape[1])
        used = np.flatnonzero(total[1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int64()), *(pa.array(t[used], pa.int64()) for t in total)], names=["bucket", "good", "n"]
        )

    counts = texts.mapInArrow(run, "bucket long, good long, n long").groupBy("bucket").agg(F.sum("good"), F.sum("n"))
    rows = counts.toArrow()  # one row per bucket: a result of fixed size
    total = np.zeros((2, 1 << BUCKET_BITS), np.float64)
    for k in (0, 1):
        total[k, rows[0].to_numpy()] = rows[k + 1].to_numpy()
    return total[0], total[1]


def log_ratio(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """log(target / raw) per bucket, both smoothed by one count in all times the raw share."""
    if not raw.sum() or not target.sum():
        return np.zeros(len(raw), np.float32)
    share = (raw + 1) / (raw.sum() + len(raw))
    smooth = min(1.0, target.sum() / raw.sum()) * len(raw) / 16 + 1
    return np.log((target + smooth * share) / (target.sum() + smooth) / share).astype(np.float32)


def text_sums(values: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The sum of each text's values, added up by itself, so that it does not depend on its neighbours in the batch."""
    filled = np.diff(rows) > 0
    sums = np.zeros(len(rows) - 1)
    if filled.any():
        sums[filled] = np.add.reduceat(values, rows[:-1][filled], dtype=np.float64)
    return sums


def score(docs: DataFrame, ratio: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, the base counts and the length-normalised score of every document."""
    sent = docs.sparkSession.sparkContext.broadcast(ratio)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = sent.value
        for batch in batches:
            for low, high, data, offsets in slices(batch.column(1)):
                w = words(data, offsets)
                counts = rules(data, offsets, w)
                buckets, rows = gram_buckets(w)
                mean = text_sums(table[buckets], rows) / (np.diff(rows) + NEUTRAL)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, high - low)]
                    + [pa.array(getattr(counts, c), pa.int64()) for c in names]
                    + [pa.array(np.round(mean, 9), pa.float64())],
                    names=["doc_id", *names, "score"],
                )

    schema = "doc_id long, " + ", ".join(f"{c} long" for c in names) + ", score double"
    return _texts(docs, id_col, text_col).mapInArrow(run, schema)


def threshold_of(bins: list[tuple[int, int, int]]) -> float:
    """The cut from (bin, good, bad) counts: lower bins are dropped; of equal cuts the middle of the first gap."""
    goods, bads = sum(b[1] for b in bins), sum(b[2] for b in bins)
    if not goods or not bads:
        return float("-inf")
    best, cut, good, bad = 0.0, float("-inf"), 0, 0
    ordered = sorted(bins)
    for (this, g, b), after in zip(ordered, ordered[1:] + [None]):
        good, bad = good + g, bad + b
        gain = bad / bads - GOOD_WEIGHT * good / goods
        if gain > best + 1e-12 and after is not None:
            best, cut = gain, (this + 1 + after[0]) / 2 * BIN
    return cut


def quality_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts, score, base_failed and kept of every document. `labels` has doc_id and quality (1 good, 0 bad)."""
    ids, quality = marked(labels)
    fit = (mix(ids.astype(np.uint64)) & np.uint64(1)).astype(bool)
    ratio = log_ratio(*gram_counts(_texts(docs, id_col, text_col), (ids[fit], quality[fit])))
    cut = fitted_cut(docs, (ids[~fit], quality[~fit]), ratio, id_col, text_col)
    failed = _base_failed()
    return (
        score(docs, ratio, id_col, text_col)
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & (F.col("score") >= F.lit(cut)))
    )


def fitted_cut(
    docs: DataFrame, marks: tuple[np.ndarray, np.ndarray], ratio: np.ndarray, id_col: str = "doc_id", text_col: str = "text"
) -> float:
    """The threshold from the scores of the marked documents that pass the base rules."""
    spark = docs.sparkSession
    known = spark.createDataFrame(pa.table({"mark_id": pa.array(marks[0], pa.int64()), "good": pa.array(marks[1], pa.int64())}))
    mine = docs.join(F.broadcast(known), F.col(id_col) == F.col("mark_id"), "left_semi")
    bins = (
        score(mine, ratio, id_col, text_col)
        .filter(~_base_failed())
        .join(F.broadcast(known), F.col("doc_id") == F.col("mark_id"))
        .groupBy(F.floor(F.col("score") / BIN).alias("bin"))
        .agg(F.sum("good").alias("good"), F.sum(1 - F.col("good")).alias("bad"))
    )
    return threshold_of([tuple(r) for r in bins.collect()])


def _base_failed():
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
