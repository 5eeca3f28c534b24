"""Ordered per-entity windows that do not put one entity into one task.

`lag` or a running total over `partition by entity order by date` sends the whole
history of an entity to a single task. Here the history is cut into chunks (calendar
years for dates, days for timestamps) and the window runs per (entity, chunk):

1. one row per (entity, chunk) is aggregated, map-side combine first;
2. a window over these few rows works out what every chunk has to know about the
   chunks before it (last value, rows so far, product so far);
3. that knowledge goes into the chunk as one *edge row* which sorts first; the
   ordinary window reads it as if it were the preceding history, then it is dropped.

The rows themselves are shuffled once, on (entity, chunk). The frame of step 2 has at most
one row per entity and calendar chunk. Results equal the plain window's.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHUNK = "_chunk"
EDGE = "_edge"

Keys = str | Sequence[str] | None


def as_keys(by: Keys) -> list[str]:
    if by is None:
        return []
    return [by] if isinstance(by, str) else list(by)


def chunk_of(df: DataFrame, dt: str, col: Column | None = None) -> Column:
    """Chunk number of a date (its year) or timestamp (its day); NULL sorts first as in a window."""
    c = F.col(dt) if col is None else col
    daily = isinstance(df.schema[dt].dataType, T.DateType)
    number = F.year(c) if daily else F.unix_date(F.to_date(c))
    return F.coalesce(number, F.lit(-(2**31)))


def bucketed(df: DataFrame, keys: Sequence[str], order: str | None = None) -> int | None:
    """The buckets of a frame that lies by (keys, chunk) and has kept its chunk column; None for any other."""
    mark = df.schema[CHUNK].metadata if CHUNK in df.columns else {}
    fits = mark.get("by") == list(keys) and order in (None, mark.get("chunk_of"))
    return mark.get("buckets") if fits else None


def split_window(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    summarise: Mapping[str, Column],
    across: Callable[[WindowSpec, WindowSpec], Mapping[str, Column]],
    within: Callable[[WindowSpec], Mapping[str, Column]],
    chunk: Column | None = None,
) -> DataFrame:
    """Run `within` per (keys, chunk) with an edge row made from `summarise` and `across`.

    `across` gets two windows over the per-chunk summary rows: the chunks in order, and
    the chunks strictly before. Its columns are put on the edge row; a name that is also a
    column of `df` makes the edge row carry a value in that column. The rows of a bucketed
    frame stay where they are, only the edge rows are sent to them.
    """
    buckets = bucketed(df, keys, order) if chunk is None else None
    cut = df if buckets else df.withColumn(CHUNK, chunk_of(df, order) if chunk is None else chunk)
    summary = cut.groupBy(*keys, CHUNK).agg(*[c.alias(n) for n, c in summarise.items()])
    in_order = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(CHUNK)
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    carried = across(in_order, before)
    edges = summary.select(*keys, CHUNK, F.lit(True).alias(EDGE), *[c.alias(n) for n, c in carried.items()])
    edges = edges.repartition(buckets, *keys, CHUNK) if buckets else edges
    rows = cut.withColumn(EDGE, F.lit(False)).unionByName(edges, allowMissingColumns=True)
    w = Window.partitionBy(*keys, CHUNK).orderBy(F.col(EDGE).desc(), F.col(order))
    helper = [n for n in carried if n not in df.columns]
    return rows.withColumns(dict(within(w))).filter(~F.col(EDGE)).drop(*([] if buckets else [CHUNK]), EDGE, *helper)


def with_prev(df: DataFrame, by: Keys, dt: str, prev: Mapping[str, str]) -> DataFrame:
    """Columns of the previous row in date order: `prev` maps new name -> source column."""
    keys = as_keys(by)
    sources = sorted(set(prev.values()))
    return split_window(
        df,
        keys,
        dt,
        summarise={f"_last_{s}": F.max(dt) if s == dt else F.max_by(s, dt) for s in sources},
        across=lambda ordered, _: {s: F.lag(f"_last_{s}").over(ordered) for s in sources},
        within=lambda w: {new: F.lag(src).over(w) for new, src in prev.items()},
    )


def with_position(df: DataFrame, by: Keys, order: str, name: str, chunk: Column | None = None) -> DataFrame:
    """Zero-based row index in order, per key or over the whole frame."""
    return split_window(
        df,
        as_keys(by),
        order,
        summarise={"_rows": F.count(F.lit(1))},
        across=lambda _, before: {"_offset": F.coalesce(F.sum("_rows").over(before), F.lit(0))},
        within=lambda w: {
            name: (F.first("_offset").over(w.rowsBetween(Window.unboundedPreceding, 0)) + F.row_number().over(w) - 2)
        },
        chunk=chunk,
    )


def with_running(
    df: DataFrame,
    by: Keys,
    order: str,
    running: Mapping[str, tuple[str, Column]],
    chunk: Column | None = None,
) -> DataFrame:
    """Running totals from the first row to the current one.

    `running` maps new name -> ("sum" | "product", column); NULL inputs are skipped.
    """
    aggregate = {"sum": F.sum, "product": F.product}
    fed = df.withColumns({f"_in_{n}": c for n, (_, c) in running.items()})
    out = split_window(
        fed,
        as_keys(by),
        order,
        summarise={f"_all_{n}": aggregate[kind](f"_in_{n}") for n, (kind, _) in running.items()},
        across=lambda _, before: {
            f"_in_{n}": aggregate[kind](f"_all_{n}").over(before) for n, (kind, _) in running.items()
        },
        within=lambda w: {
            n: aggregate[kind](f"_in_{n}").over(w.rowsBetween(Window.unboundedPreceding, 0))
            for n, (kind, _) in running.items()
        },
        chunk=chunk,
    )
    return out.drop(*[f"_in_{n}" for n in running])


def rolling(
    df: DataFrame,
    by: Keys,
    position: str,
    n: int,
    frames: Callable[[WindowSpec], Mapping[str, Column]],
    block_rows: int = 4096,
) -> DataFrame:
    """Window over the current and the n-1 preceding rows, in equal blocks of row positions.

    The last n-1 rows of a block are repeated at the head of the next one, so every frame
    is whole and no task gets more than block_rows + n - 1 rows of one entity at a time. The
    rows of a bucketed frame stay in their chunks, which get the n-1 rows before them.
    """
    buckets = bucketed(df, as_keys(by))
    if buckets:
        return _rolling_in_chunks(df, as_keys(by), position, n, frames, buckets)
    return around(df, by, position, n - 1, 0, lambda w: frames(w.rowsBetween(-(n - 1), 0)), block_rows)


def _rolling_in_chunks(
    df: DataFrame, keys: list[str], position: str, n: int, frames: Callable[[WindowSpec], Mapping[str, Column]], buckets: int
) -> DataFrame:
    """`rolling` of a bucketed frame. The n-1 rows before a chunk lie in the n-1 chunks before it, or fewer."""
    in_order = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(CHUNK)
    starts = df.groupBy(*keys, CHUNK).agg(F.min(position).alias("_first"))
    later = F.collect_list(F.struct(F.col(CHUNK).alias("c"), F.col("_first").alias("at")))
    later = starts.select(*keys, CHUNK, later.over(in_order.rowsBetween(1, max(1, n - 1))).alias("_later"))
    later = later.filter(F.size("_later") > 0)
    last = F.row_number().over(Window.partitionBy(*keys, CHUNK).orderBy(F.col(position).desc()))
    tails = df.withColumn("_back", last).filter(F.col("_back") < n).drop("_back").join(later, [*keys, CHUNK])
    reached = F.filter("_later", lambda x: x["at"] - F.col(position) < n)
    edges = tails.withColumn("_to", F.explode(reached)).withColumn(CHUNK, F.col("_to.c")).drop("_later", "_to")
    edges = edges.withColumn(EDGE, F.lit(True)).repartition(buckets, *keys, CHUNK)
    rows = df.withColumn(EDGE, F.lit(False)).unionByName(edges)
    w = Window.partitionBy(*keys, CHUNK).orderBy(position).rowsBetween(-(n - 1), 0)
    return rows.withColumns(dict(frames(w))).filter(~F.col(EDGE)).drop(EDGE)


def around(
    df: DataFrame,
    by: Keys,
    position: str,
    before: int,
    after: int,
    columns: Callable[[WindowSpec], Mapping[str, Column]],
    block_rows: int = 4096,
) -> DataFrame:
    """Columns that look up to `before` rows back and `after` rows ahead, in equal blocks of row positions.

    Every block also gets the rows that its own may look at, so no task gets more than
    block_rows + before + after rows of one entity at a time.
    """
    size = max(block_rows, before + 1, after + 1)
    at = F.col(position)
    own = F.floor(at / size)
    blocks = F.sequence(F.floor(F.greatest(at - after, F.lit(0)) / size), F.floor((at + before) / size))
    rows = df.withColumn("_own", own).withColumn("_block", F.explode(blocks))
    w = Window.partitionBy(*as_keys(by), "_block").orderBy(position)
    return rows.withColumns(dict(columns(w))).filter(F.col("_own") == F.col("_block")).drop("_own", "_block")
