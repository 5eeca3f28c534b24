"""Near-duplicate documents by an n-gram Jaccard join with Bayesian candidate pruning.

A document is the set of its runs of five words (a shorter one is its words as one run). Equal sets are collapsed to one
representative first. Representatives get a MinHash signature of 200 one-byte values; the bytes of each of 40 bands of
five name a bucket, so that a pair at similarity 0.8 misses all buckets with a chance of 1.3e-7. In the buckets, and then
in the connected groups of survivors, pairs are compared value by value in rounds: after each round the posterior
probability that the similarity reaches the threshold, given the matches so far and a uniform prior, is looked up, and
pairs below the tolerance are dropped. Pairs that outlast the buckets connect their documents to groups; in a group every
pair is compared again, and the survivors are verified exactly on their n-grams. So links are counted once without lists
of pairs, and what is returned grows with the documents, not with the square of a group. Large buckets and groups are
split into blocks that meet pairwise in tasks of their own.

Defined cases: texts without words link to nothing but are one class with texts equal to them; null counts as empty;
rows that repeat are copies; a null id is never the id of a class unless all ids in it are null; only id and text are
read. Runs of words are compared by 64-bit hashes of their words.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesframe.llm.components import components
from seriesframe.llm.groups import Forest, block_pairs, gathered, runs
from seriesframe.llm.text import mix, odd_constants, slices, span_hashes, whole_windows, window_hashes, words
from seriesframe.llm.work import stage

#: Words of a run, least similarity, and the posterior chance of reaching it below which a pair is dropped.
NGRAM, SIMILARITY, TOLERANCE = 5, 0.8, 1e-6
#: Bands and values per band of a signature; values compared in a round.
BANDS, ROWS, ROUND = 40, 5, 25
#: Bytes of text whose runs are in memory at once.
SLICE = 1 << 18
#: Members of a block of a bucket, and members and characters of a block of a group.
BUCKET_BLOCK, GROUP_BLOCK, GROUP_CHARS = 1024, 256, 2 << 20


def shingles(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct run hashes of each text, and offsets per text."""
    w = words(data, offsets)
    first, counts = whole_windows(w.rows, n)
    found = window_hashes(w.hashes, n)[first] if len(first) else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(counts)), counts)
    size = np.diff(w.rows)
    short = np.flatnonzero((size > 0) & (size < n))
    if len(short):
        whole = [mix(np.array([len(x)], np.uint64) + np.sum(x * odd_constants(len(x), 3), dtype=np.uint64))[0]
                 for x in (w.hashes[w.rows[k] : w.rows[k + 1]] for k in short)]
        found, owner = np.append(found, np.array(whole, np.uint64)), np.append(owner, short)
    order = np.lexsort((found, owner))
    found, owner = found[order], owner[order]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])
    found, owner = found[new], owner[new]
    return found, np.searchsorted(owner, np.arange(len(counts) + 1))


_FACTORS, _MASKS = odd_constants(BANDS * ROWS, 101), mix(odd_constants(BANDS * ROWS, 103))


def signature(runs_of: np.ndarray) -> np.ndarray:
    """The low byte of the least hash of a set, for each of the hash functions."""
    least = np.full(len(_FACTORS), np.uint64(0xFFFFFFFFFFFFFFFF))
    for at in range(0, len(runs_of), 1024):
        part = (runs_of[None, at : at + 1024] ^ _MASKS[:, None]) * _FACTORS[:, None]
        least = np.minimum(least, part.min(axis=1))
    return (mix(least) & np.uint64(0xFF)).astype(np.uint8)


@cache
def least_matches(n: int, similarity: float, tolerance: float) -> int:
    """Fewest matches among n values whose posterior chance of a similarity at the threshold is not below the tolerance.

    A value matches with chance s + (1 - s) / 256 at similarity s; the prior of s is uniform.
    """
    s = (np.arange(4000) + 0.5) / 4000
    p = s + (1 - s) / 256
    for m in range(n + 1):
        log = m * np.log(p) + (n - m) * np.log1p(-p)
        weight = np.exp(log - log.max())
        if weight[s >= similarity].sum() >= tolerance * weight.sum():
            return m
    return n


def survivors(a: np.ndarray, b: np.ndarray, signs: np.ndarray, similarity: float, tolerance: float) -> np.ndarray:
    """Which pairs outlast all rounds."""
    alive = np.arange(len(a))
    matches = np.zeros(len(a), np.int64)
    for done in range(0, signs.shape[1], ROUND):
        matches = matches + (signs[a[alive], done : done + ROUND] == signs[b[alive], done : done + ROUND]).sum(1)
        stays = matches >= least_matches(min(done + ROUND, signs.shape[1]), similarity, tolerance)
        alive, matches = alive[stays], matches[stays]
    return alive


def _pairs(edges, blk, same, lot: int = 1 << 14) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The pairs of rows that meet in each group, in lots."""
    left, right, waiting = [], [], 0
    for begin, end in zip(edges[:-1].tolist(), edges[1:].tolist()):
        for x in range(begin, end - 1):
            y = np.arange(x + 1, end)
            if not same[x]:
                y = y[blk[y] != blk[x]]
            if len(y):
                left.append(np.full(len(y), x))
                right.append(y)
                waiting += len(y)
            if waiting >= lot:
                yield np.concatenate(left), np.concatenate(right)
                left, right, waiting = [], [], 0
    if waiting:
        yield np.concatenate(left), np.concatenate(right)


def signed(texts: DataFrame, n: int) -> DataFrame:
    """doc_id, rep (hash of the set of runs), size (runs), chars and signature of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in slices(batch.column(1), SLICE):
                found, rows = shingles(data, offsets, n)
                size = np.diff(rows)
                rep, signs = np.zeros(len(size), np.uint64), []
                whole = np.flatnonzero((size == 0) & (np.diff(offsets) > 0))
                rep[whole] = span_hashes(data, offsets[whole], offsets[whole + 1], seed=9)
                for k, (x, y) in enumerate(zip(rows[:-1].tolist(), rows[1:].tolist())):
                    mine = found[x:y]
                    if y > x:
                        rep[k] = mix(np.array([np.sum(mix(mine + np.uint64(77)), dtype=np.uint64) + np.uint64(y - x)]))[0]
                    signs.append(signature(mine).tobytes() if y > x else b"")
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(low, high - low),
                        pa.array(rep.view(np.int64), pa.int64()),
                        pa.array(size, pa.int32()),
                        pa.array(np.diff(offsets), pa.int64()),
                        pa.array(signs, pa.binary()),
                    ],
                    names=["doc_id", "rep", "size", "chars", "signs"],
                )

    return texts.mapInArrow(run, "doc_id long, rep long, size int, chars long, signs binary")


def _signs(table: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(table.column("signs").to_pylist()), np.uint8).reshape(table.num_rows, -1)


def bucket_edges(met: DataFrame, similarity: float, tolerance: float) -> DataFrame:
    """a, b: a spanning forest of the surviving pairs of each block pair of a bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, edges in runs(batches, 3):
            reps, signs, blk = table.column("rep").to_numpy(), _signs(table), table.column("blk").to_numpy()
            same = table.column("i").to_numpy() == table.column("j").to_numpy()
            forest, out = Forest(len(reps)), []
            for a, b in _pairs(edges, blk, same):
                alive = survivors(a, b, signs, similarity, tolerance)
                out += [(x, y) for x, y in zip(a[alive].tolist(), b[alive].tolist()) if forest.join(x, y)]
            a, b = (np.array(side, np.int64) for side in zip(*out)) if out else (np.zeros(0, np.int64),) * 2
            yield pa.RecordBatch.from_arrays([pa.array(reps[a], pa.int64()), pa.array(reps[b], pa.int64())], names=["a", "b"])

    return met.mapInArrow(run, "a long, b long")


def verified(met: DataFrame, n: int, similarity: float, tolerance: float) -> DataFrame:
    """rep, links (documents), rep_links (representatives) and root (of a spanning forest) in each block pair of a group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, edges in runs(batches, 3):
            reps, signs, blk = table.column("rep").to_numpy(), _signs(table), table.column("blk").to_numpy()
            same, copies = table.column("i").to_numpy() == table.column("j").to_numpy(), table.column("copies").to_numpy()
            text = table.column("text").to_pylist()
            data = np.frombuffer("".join(text).encode(), np.uint8)
            offsets = np.append(0, np.cumsum([len(t.encode()) for t in text])).astype(np.int64)
            found, rows = shingles(data, offsets, n)
            sets = [found[x:y] for x, y in zip(rows[:-1].tolist(), rows[1:].tolist())]
            forest = Forest(len(reps))
            links, rep_links = np.zeros(len(reps), np.int64), np.zeros(len(reps), np.int64)
            for a, b in _pairs(edges, blk, same):
                alive = survivors(a, b, signs, similarity, tolerance)
                for x, y in zip(a[alive].tolist(), b[alive].tolist()):
                    both = _common(sets[x], sets[y])
                    if both >= similarity * (len(sets[x]) + len(sets[y]) - both):
                        forest.join(x, y)
                        links[x] += copies[y]
                        links[y] += copies[x]
                        rep_links[[x, y]] += 1
            root = reps[[forest.find(x) for x in range(len(reps))]]
            told = (rep_links > 0) | (root != reps)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x[told], pa.int64()) for x in (reps, links, rep_links, root)],
                names=["rep", "links", "rep_links", "root"],
            )

    return met.mapInArrow(run, "rep long, links long, rep_links long, root long")


def _common(x: np.ndarray, y: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(x) > len(y):
        x, y = y, x
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    return int((y[at] == x).sum())


def ngram_join(
    docs: DataFrame,
    n: int = NGRAM,
    similarity: float = SIMILARITY,
    tolerance: float = TOLERANCE,
    id_col: str = "doc_id",
    text_col: str = "text",
    bucket_block: int = BUCKET_BLOCK,
    group_block: int = GROUP_BLOCK,
) -> DataFrame:
    """A row per document: doc_id, rep_id (least id with the same runs), n_copies (documents with them, itself too),
    n_links (other documents at the similarity, copies included), n_rep_links (representatives among them), class_id
    (least id of its class of linked documents)."""
    texts = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    )
    rows = stage(signed(texts, n), "signed")
    heads = stage(
        rows.groupBy("rep").agg(
            F.min("doc_id").alias("rep_id"),
            F.count(F.lit(1)).alias("copies"),
            F.min(F.struct("doc_id", "size", "chars", "signs")).alias("one"),
        ).select("rep", "rep_id", "copies", "one.size", "one.chars", "one.signs"),
        "heads",
    )
    banded = heads.filter("size > 0").select("rep", "signs").withColumn(
        "band", F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1)))
    )
    bucket = F.xxhash64("band", F.substring("signs", F.col("band") * ROWS + 1, F.lit(ROWS)))
    banded = banded.select(bucket.alias("bucket"), "rep")
    full = stage(banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("m")).filter("m > 1").select("bucket"), "buckets")
    members = stage(banded.join(full, "bucket", "left_semi"), "bucket-members")
    met = block_pairs(members, "bucket", "rep", bucket_block).join(heads.select("rep", "signs"), "rep")
    met = met.select("bucket", "i", "j", "rep", "blk", "signs")
    grouped = components(bucket_edges(gathered(met, ["bucket", "i", "j"]), similarity, tolerance))
    grouped = stage(
        grouped.withColumnRenamed("node", "rep").withColumnRenamed("root", "grp").join(heads, "rep"), "groups"
    )
    texts_of = (
        rows.select("doc_id", "rep")
        .join(grouped.select("rep", "rep_id"), "rep")
        .filter(F.col("doc_id").eqNullSafe(F.col("rep_id")))
        .select("doc_id", "rep")
        .distinct()
    )
    whole = stage(
        texts.join(texts_of, texts["doc_id"].eqNullSafe(texts_of["doc_id"])).select("rep", "text"), "group-texts"
    )
    whole = _of_rep(whole, n)
    met = block_pairs(grouped, "grp", "rep", group_block, F.col("chars"), GROUP_CHARS).join(whole, "rep")
    met = met.select("grp", "i", "j", "rep", "blk", "copies", "signs", "text")
    found = stage(verified(gathered(met, ["grp", "i", "j"]), n, similarity, tolerance), "links")
    roots = components(found.filter("root <> rep").select(F.col("rep").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("rep").agg(F.sum("links").alias("links"), F.sum("rep_links").alias("rep_links"))
    linked = heads.select("rep", "rep_id", "copies").join(
        links.join(roots.withColumnRenamed("node", "rep"), "rep"), "rep", "left"
    )
    linked = stage(linked.withColumn("root", F.coalesce("root", "rep")), "linked")
    classes = linked.groupBy("root").agg(F.min("rep_id").alias("class_id"))
    per_rep = stage(linked.join(stage(classes, "classes"), "root"), "per-rep")
    return rows.select("doc_id", "rep").join(per_rep, "rep").select(
        "doc_id",
        "rep_id",
        F.col("copies").alias("n_copies"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links"),
        F.coalesce("rep_links", F.lit(0)).cast("long").alias("n_rep_links"),
        "class_id",
    )


def _of_rep(whole: DataFrame, n: int) -> DataFrame:
    """One text per representative: rows whose own runs are the representative's (an id may have several texts)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in slices(batch.column(1), SLICE):
                found, rows = shingles(data, offsets, n)
                own = [
                    mix(np.array([np.sum(mix(found[x:y] + np.uint64(77)), dtype=np.uint64) + np.uint64(y - x)]))[0]
                    for x, y in zip(rows[:-1].tolist(), rows[1:].tolist())
                ]
                mine = np.array(own, np.uint64).view(np.int64) == batch.column(0).slice(low, high - low).to_numpy()
                yield batch.slice(low, high - low).filter(pa.array(mine, pa.bool_()))

    return whole.mapInArrow(run, "rep long, text string").groupBy("rep").agg(F.min("text").alias("text"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, with all their columns, that are the least id of their class."""
    kept = stage(
        ngram_join(docs, id_col=id_col, text_col=text_col)
        .filter(F.col("doc_id").eqNullSafe(F.col("class_id")))
        .select(F.col("doc_id").alias("_kept"))
        .distinct(),
        "kept",
    )
    return docs.join(kept, F.col(id_col).eqNullSafe(F.col("_kept")), "left_semi")
