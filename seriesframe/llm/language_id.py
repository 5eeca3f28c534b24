"""Language identification by error-correcting output codes.

Every language gets a binary codeword. For each bit a linear classifier over hashed character n-grams says how likely
the text's languages have a one there: its weight for an n-gram is the log ratio of the n-gram's share in the training
texts of the one-languages to that of the zero-languages. Counts come from all training texts, added up per task first;
the driver receives one row per bucket and language. A text's margin for a bit is the sum of the weights over its
n-grams, divided by their number. Decoding picks the codeword with the least loss, a bit counting the more the better
it separates the training languages, and flags a text as ambiguous when the second best is nearly as close.

`accepted` keeps the texts that the decoding gives a language: not those too far from every codeword, nor ambiguous ones.
How far is too far is fitted by `calibrated` on texts in known languages that the model has not seen, by length, as short
texts tell less: a text stays when its loss is at most that of known texts as long or longer (all but 1 - KNOWN of them)
and SLACK more. Ambiguity rejects where hardly any known text is ambiguous.

Up to seven languages get the exhaustive code, which separates every two codewords in half of its bits; more get random
codewords of 24 bits and more, drawn until every two differ in a quarter of the bits.

Defined cases: a null text, or one without a letter, is `und` with score 0; training rows without a language are left
out; without training rows every text is `und`; texts shorter than every known one, all texts where fewer than LEAST_KNOWN
known ones are at hand, and all with a model that is not calibrated stay if they have a letter; ties go to the first language by name; only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesframe.llm.text import mix, slices

#: Lengths of the n-grams in bytes of lower-case text, and log2 of the hash buckets of each length.
ORDERS, BUCKET_BITS = (2, 3, 4), 15
#: Margins are taken over this many neutral n-grams besides the text's own.
NEUTRAL = 8
#: How sharply a loss difference turns into a score, and the score distance of an ambiguous text.
SHARPNESS, AMBIGUOUS = 6.0, 0.2
#: Share of the known texts that stay for sure, loss allowed beyond theirs, and how many a cut needs.
KNOWN, SLACK, LEAST_KNOWN = 0.9999, 0.05, 20
#: Lengths are told apart by powers of two, losses (clipped at 1) by this many steps.
BANDS, STEPS = 64, 500
#: Bytes of text whose n-grams are in memory at once.
SLICE = 1 << 16
#: N-grams whose weights are in memory at once; one text may have any number.
PIECE = 1 << 16
#: Unknown language.
UND = "und"

_LETTER = regex.compile(r"\p{L}")
_KEPT = np.arange(256, dtype=np.uint8)
_KEPT[[b for b in range(128) if not chr(b).isalpha()]] = 0x20


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray  # language x bit, 0 or 1
    weights: np.ndarray  # (order, bucket) x bit
    trust: np.ndarray  # per bit
    cut: np.ndarray | None = None  # greatest loss by band of length
    sure: np.ndarray | None = None  # whether ambiguity rejects, by band


def codewords(n: int, seed: int = 17) -> np.ndarray:
    """n distinct codewords, one row each; no column is constant."""
    if n <= 1:
        return np.ones((n, 1), np.int8)
    if n <= 7:
        columns = np.arange(1 << (n - 1), (1 << n) - 1)
        return (columns[None, :] >> np.arange(n)[::-1, None] & 1).astype(np.int8)
    bits = max(24, 4 * int(np.ceil(np.log2(n))) + 8)
    draw = np.random.default_rng(seed)
    while True:
        code = draw.integers(0, 2, (n, bits), dtype=np.int8)
        apart = (code[:, None, :] != code[None, :, :]).sum(2) + bits * np.eye(n, dtype=int)
        if apart.min() >= bits // 4 and 0 < code.mean(0).min() and code.mean(0).max() < 1:
            return code


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket numbers of the n-grams of each text, all orders together, and offsets per text.

    Everything but letters becomes a blank, runs of blanks count once, and a text begins and ends with one.
    """
    joined = np.frombuffer("\n".join(["", *(t.lower().replace("\n", " ") for t in texts), ""]).encode(), np.uint8)
    breaks = joined == 0x0A
    plain = _KEPT[joined]
    single = np.ones(len(plain), bool)
    single[1:] = (plain[1:] != 0x20) | (plain[:-1] != 0x20) | breaks[1:]
    single[:-1] &= (plain[:-1] != 0x20) | breaks[:-1] | ~breaks[1:]
    plain, breaks = plain[single], np.flatnonzero(breaks[single])
    begins, ends = breaks[:-1], breaks[1:] + 1  # the break at either end serves as the blank
    found, owner = [], []
    for k, order in enumerate(ORDERS):
        x = np.zeros(max(0, len(plain) - order + 1), np.uint64)
        for j in range(order):
            x = (x << np.uint64(8)) | plain[j : j + len(x)]
        bucket = (mix(x + np.uint64(k << 40)) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64) + (k << BUCKET_BITS)
        counts = np.maximum(ends - begins - order + 1, 0)
        first = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(begins, counts)
        found.append(bucket[first])
        owner.append(counts)
    total = np.sum(owner, axis=0)
    rows = np.concatenate([[0], np.cumsum(total)])
    merged = np.empty(int(rows[-1]), np.int64)
    at = rows[:-1].copy()
    for bucket, counts in zip(found, owner, strict=True):
        place = np.arange(len(bucket)) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(at, counts)
        merged[place] = bucket
        at += counts
    return merged, rows


def language_counts(train: DataFrame, languages: list[str]) -> np.ndarray:
    """language x bucket counts over all training rows (lang, text)."""
    size = len(ORDERS) << BUCKET_BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(languages), size), np.int64)
        for batch in batches:
            langs = np.array([languages.index(x) for x in batch.column(0).to_pylist()], np.int64)
            for low, high, _, _ in slices(batch.column(1), SLICE):
                buckets, rows = grams(batch.column(1).slice(low, high - low).to_pylist())
                cells = buckets + np.repeat(langs[low:high], np.diff(rows)) * size
                total += np.bincount(cells, minlength=total.size).reshape(total.shape)
        lang, bucket = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(lang, pa.int64()), pa.array(bucket, pa.int64()), pa.array(total[lang, bucket], pa.int64())],
            names=["lang", "bucket", "n"],
        )

    counts = train.mapInArrow(run, "lang long, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n"))
    rows = counts.toArrow()  # languages times buckets: a result of fixed size
    total = np.zeros((len(languages), size))
    total[rows[0].to_numpy(), rows[1].to_numpy()] = rows[2].to_numpy()
    return total


def fit(train: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """A model from all rows with a language."""
    rows = train.filter(F.col(lang_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    )
    languages = [r.lang for r in rows.select("lang").distinct().orderBy("lang").collect()]
    code = codewords(len(languages))
    if not languages:
        return Model([], code, np.zeros((len(ORDERS) << BUCKET_BITS, 1), np.float32), np.ones(1))
    counts = language_counts(rows, languages)
    per_order = counts.reshape(len(languages), len(ORDERS), -1)
    share = (per_order + 0.5) / (per_order.sum(2, keepdims=True) + 0.5 * per_order.shape[2])
    share = share.reshape(len(languages), -1)
    if len(languages) == 1:
        return Model(languages, code, np.ones((share.shape[1], 1), np.float32), np.ones(1))
    ones = code.astype(float)
    weights = np.log((ones.T @ share) / ones.sum(0)[:, None]) - np.log(((1 - ones).T @ share) / (1 - ones).sum(0)[:, None])
    # a bit is trusted by the distance between the mean margins of its one- and zero-languages, on its weakest language
    margins = (share / share.sum(1, keepdims=True)) @ weights.T * (2 * code - 1)
    trust = np.maximum(margins.min(0), 0.05)
    return Model(languages, code, np.clip(weights, -4, 4).T.astype(np.float32), trust / trust.sum())


def decode(model: Model, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Best language number, its score from 0 to 1, whether the runner-up is nearly as close, and the least loss."""
    signs = 2.0 * model.code - 1
    loss = np.log1p(np.exp(-np.clip(margins[:, None, :] * signs[None, :, :] * SHARPNESS, -30, 30))) @ model.trust
    likely = np.exp(-SHARPNESS * (loss - loss.min(1, keepdims=True)))
    likely /= likely.sum(1, keepdims=True)
    best = likely.argmax(1)
    ranked = np.sort(likely, axis=1)
    second = ranked[:, -2] if ranked.shape[1] > 1 else np.zeros(len(ranked))
    return best, ranked[:, -1], ranked[:, -1] - second < AMBIGUOUS, loss.min(1)


def weight_sums(weights: np.ndarray, buckets: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The weights of each text's n-grams, added up per bit, a bounded number of n-grams at a time."""
    sums = np.zeros((len(rows) - 1, weights.shape[1]))
    for low in range(0, len(buckets), PIECE):
        high = min(low + PIECE, len(buckets))
        first = int(np.searchsorted(rows, low, "right")) - 1
        last = int(np.searchsorted(rows, high, "left"))
        cuts = np.maximum(rows[first:last], low) - low
        filled = np.diff(np.append(cuts, high - low)) > 0
        sums[first:last][filled] += np.add.reduceat(weights[buckets[low:high]], cuts[filled], axis=0, dtype=np.float64)
    return sums


def judge(model: Model, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Language, score, ambiguity, loss and band of length of each text."""
    if not model.languages:
        none = np.zeros(len(texts))
        return [UND] * len(texts), none, np.ones(len(texts), bool), none, none.astype(np.int64)
    buckets, rows = grams(texts)
    sums = weight_sums(model.weights, buckets, rows)
    best, score, unsure, _ = decode(model, sums / (np.diff(rows) + NEUTRAL)[:, None])
    # for the cuts all bytes count, so that a few letters among digits and signs are no language
    whole = np.maximum(np.diff(rows), len(ORDERS) * np.array([len(t.encode()) for t in texts]))
    loss = decode(model, sums / (whole + NEUTRAL)[:, None])[3]
    lettered = np.array([bool(_LETTER.search(t)) for t in texts], bool)
    names = [model.languages[b] if ok else UND for b, ok in zip(best, lettered, strict=True)]
    band = np.log2(np.maximum(whole, 1)).astype(np.int64)
    return names, np.where(lettered, np.round(score, 9), 0.0), unsure | ~lettered, loss, band


def label(model: Model, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, score and ambiguity of each text."""
    return judge(model, texts)[:3]


def calibrated(model: Model, known: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """The model with cuts fitted on texts that it has not seen, those whose language it tells rightly."""
    sent = known.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BANDS, STEPS + 1, 2), np.int64)
        for batch in batches:
            for part, texts in _parts(batch, 1):
                names, _, unsure, loss, band = judge(sent.value, texts)
                right = np.array([a == b for a, b in zip(names, part.column(0).to_pylist(), strict=True)], bool)
                step = np.ceil(np.minimum(loss, 1) * STEPS).astype(np.int64)
                np.add.at(total, (band[right], step[right], unsure[right].astype(np.int64)), 1)
        found = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, pa.int64()) for x in (*found, total[found])], names=["band", "step", "unsure", "n"]
        )

    rows = known.filter(F.col(lang_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    )
    counts = rows.mapInArrow(run, "band long, step long, unsure long, n long").groupBy("band", "step", "unsure").agg(F.sum("n"))
    told = counts.toArrow()  # bands times steps: a result of fixed size
    total = np.zeros((BANDS, STEPS + 1, 2))
    total[tuple(told[k].to_numpy() for k in range(3))] = told[3].to_numpy()
    longer = total[::-1].cumsum(0)[::-1]  # texts of a band and all longer ones
    size = longer.sum((1, 2))
    cut, sure = np.full(BANDS, np.inf), np.zeros(BANDS, bool)
    fitted = np.flatnonzero(size >= LEAST_KNOWN)
    if len(fitted):
        shortest = int(np.flatnonzero(total.sum((1, 2)))[0])
        for band in range(shortest, BANDS):
            from_here = min(band, int(fitted[-1]))
            below = longer[from_here].sum(1).cumsum()
            cut[band] = int(np.searchsorted(below, KNOWN * size[from_here])) / STEPS + SLACK
            sure[band] = longer[from_here, :, 1].sum() <= (1 - KNOWN) * size[from_here]
    return replace(model, cut=cut, sure=sure)


def _parts(batch: pa.RecordBatch, column: int) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    for low, high, _, _ in slices(batch.column(column), SLICE):
        part = batch.slice(low, high - low)
        yield part, part.column(column).to_pylist()


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score (0 to 1) and ambiguous of every whole text."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in _parts(batch, 1):
                names, score, unsure = label(sent.value, texts)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(names, pa.string()), pa.array(score, pa.float64()), pa.array(unsure, pa.bool_())],
                    names=["doc_id", "lang_pred", "score", "ambiguous"],
                )

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    return texts.mapInArrow(run, "doc_id long, lang_pred string, score double, ambiguous boolean")


def accepted(docs: DataFrame, model: Model, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows, with all their columns, whose text has a language; a missing `lang_col` gets the predicted one."""
    columns = docs.columns
    fills = lang_col in columns and docs.schema[lang_col].dataType.simpleString() == "string"
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in _parts(batch, 0):
                names, _, unsure, loss, band = judge(sent.value, texts)
                stays = np.array([name != UND for name in names], bool)
                if sent.value.cut is not None:
                    stays &= (loss <= sent.value.cut[band]) & ~(unsure & sent.value.sure[band])
                kept = part.columns[1:]
                if fills:
                    at = columns.index(lang_col)
                    kept[at] = pc.coalesce(kept[at], pa.array(names, kept[at].type))
                yield pa.RecordBatch.from_arrays(kept, names=columns).filter(pa.array(stays, pa.bool_()))

    source = docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_whole"), *(F.col(f"`{c}`") for c in docs.columns))
    return source.mapInArrow(run, docs.schema)


def held_out(id_col: str | Column = "doc_id") -> Column:
    """Rows that no model learns from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))
