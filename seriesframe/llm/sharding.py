"""Sharding by jump consistent hashing.

The shard of a row follows from its key and the number of shards alone: a generator seeded with the key draws the next
shard number the key jumps to, until it would jump past the last shard. No table of shards or ring is kept anywhere. One
more shard changes the last jump of one key in (shards + 1), and such a key can only land in the new shard.

Slots number the rows of a shard from 0 in the order of id, checksum and size. Rows are sorted by ranges over all tasks,
so neither a shard nor a repeated id has to fit into one task.

Defined cases: a null text has no bytes; a null id counts as key 0 and its rows come first in their shard; rows that
repeat an id share a shard, each with a slot of its own; empty tables give empty results; texts of any length are only
measured and checksummed; only id and text are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesframe.llm.places import with_place

#: Shards of the production query.
SHARDS = 16
#: Fixed value: the multiplier of the published generator.
STEP = np.uint64(2862933555777941757)


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each 64-bit key, by the published jump consistent hash."""
    if shards < 1:
        raise ValueError("there must be a shard at least")
    state = keys.astype(np.int64).view(np.uint64).copy()
    shard = np.zeros(len(state), np.int64)
    live = np.arange(len(state))
    while len(live):
        state[live] = state[live] * STEP + np.uint64(1)
        drawn = (state[live] >> np.uint64(33)).astype(np.float64) + 1
        target = ((shard[live] + 1) * (float(1 << 31) / drawn)).astype(np.int64)
        inside = target < shards
        live = live[inside]
        shard[live] = target[inside]
    return shard


def shard_of(key: Column, shards: int) -> Column:
    """The shard of an integer key; a null counts as 0."""

    @F.pandas_udf("int")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for keys in batches:
            yield pd.Series(jump(keys.to_numpy(np.int64), shards).astype(np.int32))

    return of(F.coalesce(key.cast("long"), F.lit(0).cast("long")))


def sharded(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, shard, grown_shard (with one shard more) of every row."""
    text = F.encode(F.coalesce(F.col(text_col).cast("string"), F.lit("")), "utf-8")
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    return rows.withColumns({"shard": shard_of(F.col("doc_id"), shards), "grown_shard": shard_of(F.col("doc_id"), shards + 1)})


def with_slots(rows: DataFrame) -> DataFrame:
    """`sharded` rows with their slot: gapless numbers from 0 in each shard."""
    order = [F.col("doc_id").asc_nulls_first(), F.col("text_crc32"), F.col("size")]
    return with_place(rows, ["shard"], order, "slot")


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, key: str = "doc_id") -> None:
    """Whole rows in one folder for each shard. Large shards are written by several tasks."""
    placed = docs.withColumn("shard", shard_of(F.col(key), shards))
    placed.hint("rebalance", "shard").write.partitionBy("shard").parquet(path)


def moving(docs: DataFrame, shards: int = SHARDS, key: str = "doc_id") -> DataFrame:
    """The rows that one more shard takes from the others; all other rows stay where they are."""
    return docs.filter(shard_of(F.col(key), shards + 1) == shards)
