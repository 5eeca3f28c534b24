"""Places of rows in an order, and digests of strings joined in an order, for groups of any size.

Rows are dealt out by ranges of the order, so one group may lie in many tasks. A row's place is its place in its task
plus the rows that its group has in the tasks before.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesframe.llm.work import stage

#: Characters of a run of joined strings.
RUN_CHARS = 1 << 16


def in_ranges(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The rows sorted by keys and order over all tasks; rows that are equal in both may go to several tasks."""
    drawn = df.withColumn("_lot", F.monotonically_increasing_id())
    by = [*(F.col(k).asc_nulls_first() for k in keys), *order, F.col("_lot")]
    return drawn.repartitionByRange(*by).sortWithinPartitions(*by).drop("_lot")


def with_place(df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str) -> DataFrame:
    """`name`: the number of rows of the same keys that come before. Null keys make a group; equal rows get one place each."""
    rows = stage(in_ranges(df, keys, order).withColumn("_at", F.monotonically_increasing_id()), "in-ranges")
    rows = rows.withColumn("_part", F.shiftright("_at", 33))
    spans = rows.groupBy(*keys, "_part").agg(F.min("_at").alias("_from"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = spans.select(
        *(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)),
        F.col("_part").alias("_p"),
        (F.col("_from") - F.coalesce(F.sum("_n").over(before), F.lit(0))).alias("_zero"),
    )
    match = F.col("_part") == F.col("_p")
    for i, k in enumerate(keys):
        match &= F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return rows.join(offsets, match).select(*df.columns, (F.col("_at") - F.col("_zero")).alias(name))


def joined_runs(df: DataFrame, keys: Sequence[str], order: str, item: str, separator: str, most: int = RUN_CHARS) -> DataFrame:
    """keys, order (of its first row), run: the items of up to `most` characters joined, where the rows lie in the order."""
    types = {f.name: f.dataType.simpleString() for f in df.schema}
    schema = ", ".join([*(f"{k} {types[k]}" for k in [*keys, order]), "run string"])
    names = [*keys, order, "run"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, first, waiting, size, done = None, None, [], 0, []

        def closed():
            return (*key, first, separator.join(waiting))

        for batch in batches:
            columns = batch.to_pydict()
            for *now, place, text in zip(*(columns[k] for k in [*keys, order, item])):
                if key is None or now != key or size >= most:
                    if key is not None:
                        done.append(closed())
                    key, first, waiting, size = now, place, [], 0
                waiting.append(text)
                size += len(text) + 1
            if done:
                yield pa.RecordBatch.from_pylist([dict(zip(names, d)) for d in done], batch_schema(batch))
                done = []
        if key is not None:
            yield pa.RecordBatch.from_pylist([dict(zip(names, closed()))], batch_schema(batch))

    def batch_schema(batch: pa.RecordBatch) -> pa.Schema:
        return pa.schema([*(batch.schema.field(k) for k in [*keys, order]), pa.field("run", pa.string())])

    return in_ranges(df.select(*keys, order, item), keys, [F.col(order)]).mapInArrow(run, schema)


def digests(df: DataFrame, keys: Sequence[str], order: Sequence[str], item: str, separator: str) -> DataFrame:
    """keys, sha256: of each group's items joined in order, fed to the hash one after the other."""
    types = {f.name: f.dataType.simpleString() for f in df.schema}
    schema = ", ".join([*(f"{k} {types[k]}" for k in keys), "sha256 string"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest, done, fields = None, None, [], None

        def out():
            return pa.RecordBatch.from_pylist([dict(zip([*keys, "sha256"], d)) for d in done], pa.schema(fields))

        for batch in batches:
            fields = [*(batch.schema.field(k) for k in keys), pa.field("sha256", pa.string())]
            columns = batch.to_pydict()
            for *now, text in zip(*(columns[k] for k in [*keys, item])):
                if key is None or now != key:
                    if key is not None:
                        done.append((*key, digest.hexdigest()))
                    key, digest = now, hashlib.sha256()
                else:
                    digest.update(separator.encode())
                digest.update(text.encode())
            if done:
                yield out()
                done = []
        if key is not None:
            done.append((*key, digest.hexdigest()))
            yield out()

    rows = df.select(*keys, *order, item).repartition(*keys).sortWithinPartitions(*keys, *order)
    return rows.mapInArrow(run, schema)
