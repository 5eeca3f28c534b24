"""Sliding counts kept in Spark's state store, with rows later than the watermark added outside of it."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import date

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from seriesframe.functions.columns import utc_date
from seriesframe.sources.tables import PERIOD, read_table
from seriesframe.sources.upsert import upsert
from seriesframe.sources.workspace import Folder, new_path
from seriesframe.streaming.jobs import window_sums

#: Pieces that a day of a category is counted in, so that one with a third of all rows has several tasks.
PIECES = 16
#: `lot` of a count that the state holds or held; a correction has the number of its batch.
HELD = -1

_COUNTED = "cat string, day date, piece int, n long, late boolean"


def _closes(day: date) -> int:
    """The end of a UTC day in milliseconds."""
    return (pd.Timestamp(day) + pd.Timedelta(days=1)).value // 10**6


def _count(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """The rows of one piece of a day so far, or, once the state has let go of it, only those of this batch."""
    closed = _closes(key[1]) <= state.getCurrentWatermarkMs()
    if state.hasTimedOut:
        if closed:
            state.remove()
        else:
            state.setTimeoutDuration(1)
        return
    late = closed and not state.exists
    n = sum(len(b) for b in batches) + (state.get[0] if state.exists else 0)
    if not closed:
        state.update((n,))
        state.setTimeoutDuration(1)
    elif state.exists:
        state.remove()
    yield pd.DataFrame({"cat": [key[0]], "day": [key[1]], "piece": [key[2]], "n": [n], "late": [late]})


def day_counts(events: DataFrame, ts: str, cat: str, delay: str, pieces: int = PIECES) -> DataFrame:
    """A stream of (cat, day, piece, n, late) from a stream of events.

    `late` is false for the whole count of a piece of a day, which replaces the one before, and true for rows of a day that
    the watermark, `delay` behind the latest event, has passed and whose count the state has let go of: these are to be added.
    An event without a time or category fails the stream.
    """
    given = lambda c: F.coalesce(F.col(c), F.raise_error(F.lit(f"event without {c}")).cast(events.schema[c].dataType))
    rows = events.select(
        given(cat).cast("string").alias("cat"),
        utc_date(ts).alias("day"),
        F.pmod(F.xxhash64(*events.columns), F.lit(pieces)).cast("int").alias("piece"),
        given(ts).cast("timestamp").alias("at"),
    )
    return (
        rows.withWatermark("at", delay)
        .groupBy("cat", "day", "piece")
        .applyInPandasWithState(_count, _COUNTED, "n long", "update", GroupStateTimeout.ProcessingTimeTimeout)
    )


def sliding_counts_kept(
    spark: SparkSession,
    events: DataFrame,
    ts: str,
    cat: str,
    target: str,
    checkpoint: str,
    delay: str = "1 day",
    days: int = 7,
    pieces: int = PIECES,
) -> DataFrame:
    """Keep a table of sliding counts up to date with what has landed, reading no event twice.

    The state holds one number per category, piece and day that the watermark has not passed; it goes when the day has
    closed. `<target>_days` has every count the state has given out, and the rows that came later as corrections with
    the number of their batch; the two add up to the exact count however late a row is, and a batch delivered again replaces
    its own rows. Only windows over days a batch touches are summed again. Days are cut in UTC, whose session it needs.
    """

    def merge(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        staged = Folder(session, new_path(session, "counts"))
        try:
            batch.write.parquet(staged.path)
            counted = session.read.schema(batch.schema).parquet(staged.path)
            if counted.isEmpty():
                return
            lots = counted.select("cat", "day", "piece", F.when(F.col("late"), number).otherwise(HELD).alias("lot"), "n")
            kept = upsert(session, f"{target}_days", lots, ["cat", "day", "piece", "lot"], "day", grain="month")
            # at most one row per calendar day
            touched = F.broadcast(counted.select(F.col("day").alias("_day")).distinct())
            starts = touched.select(F.explode(F.sequence(F.date_sub("_day", days - 1), F.col("_day"))).alias("_start")).distinct()
            reach = starts.agg(F.min("_start").alias("lo"), F.date_add(F.max("_start"), days - 1).alias("hi"))
            low, high = reach.select("lo").scalar(), reach.select("hi").scalar()
            near = kept.filter((F.col(PERIOD) >= F.trunc(low, "month")) & F.col("day").between(low, high))
            daily = near.groupBy("cat", "day").agg(F.sum("n").alias("n"))
            sums = window_sums(daily, "cat", days)
            sums = sums.join(F.broadcast(starts), F.col("window_start") == F.col("_start"), "left_semi")
            upsert(session, target, sums.withColumnRenamed("cat", cat), [cat, "window_start"], "window_start")
        finally:
            staged.delete()

    # the state's time limits would ask for another empty batch after every batch, without an end
    empty = "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(empty)
    spark.conf.set(empty, "false")
    try:
        query = (
            day_counts(events, ts, cat, delay, pieces)
            .writeStream.foreachBatch(merge)
            .outputMode("update")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    finally:
        spark.conf.set(empty, before)
    return read_table(spark, target)
