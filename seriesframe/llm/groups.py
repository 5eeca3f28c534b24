"""Comparing the members of groups of any size: bounded blocks of a group meet pairwise in tasks of their own."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def block_pairs(members: DataFrame, key: str, member: str, block: int, weight: Column | None = None, most: int = 0) -> DataFrame:
    """`members` once for every pair of blocks (i <= j) its block is part of, with columns i, j and blk.

    A group of n members has about n / block blocks, or more if the weights of its members add up to over `most` each;
    a member goes to a block by the hash of its id. Two members meet in the one task (i, j) of their blocks.
    """
    sizes = members.groupBy(key).agg(
        F.count(F.lit(1)).alias("_n"), *([F.sum(weight).alias("_w")] if weight is not None else [])
    )
    blocks = F.ceil(F.col("_n") / block)
    if weight is not None:
        blocks = F.greatest(blocks, F.ceil(F.col("_w") / most))
    placed = members.join(sizes.select(key, blocks.cast("int").alias("_blocks")), key).withColumn(
        "blk", F.pmod(F.xxhash64(member), F.col("_blocks")).cast("int")
    )
    return (
        placed.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
        .withColumn("i", F.least("blk", "_other"))
        .withColumn("j", F.greatest("blk", "_other"))
        .drop("_blocks", "_other")
    )


def gathered(frame: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of a key next to each other in one task; the keys are those of bounded blocks."""
    return frame.repartition(*keys).sortWithinPartitions(*keys)


def runs(batches: Iterator[pa.RecordBatch], keys: int, weight: int = 1 << 20) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Whole groups of rows with equal values in the first `keys` columns: (table, offsets of the groups in it).

    Groups are handed on in lots of several, as soon as `weight` bytes are there.
    """
    waiting: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if batch.num_rows:
            waiting.append(batch)
            size += batch.nbytes
        if size < weight:
            continue
        table = pa.Table.from_batches(waiting)
        edges = _edges(table, keys)
        if len(edges) > 1:
            last = int(edges[-1])
            yield table.slice(0, last).combine_chunks(), edges
            rest = table.slice(last)
            waiting = pa.Table.from_arrays([c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in rest.columns], schema=rest.schema).to_batches()
            size = 0
    if waiting:
        table = pa.Table.from_batches(waiting).combine_chunks()
        yield table, np.append(_edges(table, keys), table.num_rows)


def _edges(table: pa.Table, keys: int) -> np.ndarray:
    """First rows of the groups."""
    new = np.zeros(table.num_rows, bool)
    new[0] = True
    for k in range(keys):
        x = table.column(k).to_numpy()
        new[1:] |= x[1:] != x[:-1]
    return np.flatnonzero(new)


class Forest:
    """Union-find over the numbers 0 to n - 1."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> bool:
        """Whether they were apart."""
        x, y = self.find(x), self.find(y)
        self.up[max(x, y)] = min(x, y)
        return x != y
