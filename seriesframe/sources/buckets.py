"""Catalog tables bucketed by entity and chunk, whose ordered windows need no shuffle of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seriesframe.functions.ordered import CHUNK, Keys, as_keys, chunk_of
from seriesframe.sources.workspace import written

#: Rows from which on a chunk is complete; an entity with fewer has one chunk.
CHUNK_ROWS = 4096


def _chunked(df: DataFrame, keys: Sequence[str], dt: str, rows: int) -> DataFrame:
    """The frame with its chunks: that of the date, but as many together as are needed for `rows` rows.

    Only the chunks of entities with more rows are listed; all rows of the others have the chunk 0. Rows without a date
    have a chunk of their own, before the others, and rows without an entity keep their calendar chunks.
    """
    cut = df.withColumn(CHUNK, chunk_of(df, dt))
    known = F.col(dt).isNotNull()
    for k in keys:
        known = known & F.col(k).isNotNull()
    every = Window.partitionBy(*(keys or [F.lit(0)]))
    counts = cut.filter(known).groupBy(*keys, CHUNK).agg(F.count(F.lit(1)).alias("_n")).withColumn("_all", F.sum("_n").over(every))
    before = F.sum("_n").over(every.orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")
    large = counts.filter(F.col("_all") > rows).withColumn("_lot", F.floor(before / rows))
    first = F.min(CHUNK).over(Window.partitionBy(*keys, "_lot"))
    listed = large.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col(CHUNK).alias("_c"), first.alias("_to"))
    match = F.col(CHUNK) == F.col("_c")
    for k in keys:
        match = match & (F.col(k) == F.col(f"_k_{k}"))
    joined = cut.join(written(listed, "chunks"), match, "left")
    chunk = F.when(known, F.coalesce("_to", F.lit(0))).otherwise(F.col(CHUNK))
    return joined.withColumn(CHUNK, chunk).select(*df.columns, CHUNK)


def write_bucketed(df: DataFrame, table: str, by: Keys, dt: str, buckets: int, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Rebuild a catalog table with the rows of an (entity, chunk) in one bucket, and return it as read back.

    The chunk is stored as a column that is marked with the layout. Ordered windows of the same entity and date read a bucket
    in one task, one after the other, as long as the column is kept; without it they shuffle as ever. A chunk has whole
    calendar chunks with `chunk_rows` rows or more together: a hot entity is spread over the buckets, and one with few rows
    a year is not cut into chunks that mostly repeat the rows before them. `buckets` is for the table's size: one is
    to fit a task's memory when it is sorted.
    """
    keys = as_keys(by)
    mark = {"chunk_of": dt, "by": keys, "buckets": buckets}
    laid_out = _chunked(df, keys, dt, chunk_rows).withMetadata(CHUNK, mark)
    (
        laid_out.repartition(buckets, *keys, CHUNK)
        .write.mode("overwrite")
        .format("parquet")
        .bucketBy(buckets, *keys, CHUNK)
        .sortBy(*keys, CHUNK, dt)
        .saveAsTable(table)
    )
    return df.sparkSession.table(table)
