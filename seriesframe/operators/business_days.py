"""Business days with holidays, as look-ups in a calendar of one row per date.

The calendar holds, for every date, how many business days there were up to it and the latest of them, so the day
that data is due and the business days between two dates need no rule per row, only joins on a date.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seriesframe.functions.columns import utc_date, utc_hour
from seriesframe.operators.freshness import CLOSE_HOUR_UTC


def business_calendar(spark: SparkSession, first: str, last: str, holidays: DataFrame) -> DataFrame:
    """day, business, n_upto (business days up to and with it), latest_business, for every date from first to last.

    `holidays` has a column `day`; weekends are no business days either. The windows see one row per calendar date.
    """
    bounds = [F.to_date(F.lit(d)) for d in (first, last)]
    days = spark.range(1).select(F.explode(F.sequence(*bounds)).alias("day"))
    closed = holidays.select("day", F.lit(True).alias("_closed")).distinct()
    marked = days.join(F.broadcast(closed), "day", "left").withColumn(
        "business", (F.weekday("day") < 5) & F.col("_closed").isNull()
    )
    so_far = Window.partitionBy(F.lit(0)).orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    return marked.select(
        "day",
        "business",
        F.sum(F.col("business").cast("long")).over(so_far).alias("n_upto"),
        F.max(F.when(F.col("business"), F.col("day"))).over(so_far).alias("latest_business"),
    )


def with_expected(df: DataFrame, as_of: str, calendar: DataFrame, out: str = "expected") -> DataFrame:
    """The latest business day whose data can be expected at each row's moment; NULL outside the calendar."""
    ended = F.when(utc_hour(as_of) < CLOSE_HOUR_UTC, F.date_sub(utc_date(as_of), 1)).otherwise(utc_date(as_of))
    lookup = F.broadcast(calendar.select(F.col("day").alias("_day"), F.col("latest_business").alias(out)))
    return df.withColumn("_ended", ended).join(lookup, F.col("_ended") == F.col("_day"), "left").drop("_ended", "_day")


def with_business_gap(df: DataFrame, start: str, end: str, calendar: DataFrame, out: str = "gap") -> DataFrame:
    """Business days after `start` up to `end`; NULL where either is NULL or outside the calendar."""
    for side, col in (("_to", end), ("_from", start)):
        lookup = F.broadcast(calendar.select(F.col("day").alias("_day"), F.col("n_upto").alias(side)))
        df = df.join(lookup, F.col(col) == F.col("_day"), "left").drop("_day")
    return df.withColumn(out, F.col("_to") - F.col("_from")).drop("_to", "_from")


def business_status(gap: Column, allowed: int = 0) -> Column:
    """FRESH while no more than `allowed` business days are missing."""
    return F.when(gap.isNull(), "NO DATA").when(gap <= allowed, "FRESH").otherwise("STALE")
