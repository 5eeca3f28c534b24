"""Row rules between landing and typed history."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seriesframe.functions.columns import member_of, utc_date
from seriesframe.functions.ordered import Keys, as_keys


def settled(bars: DataFrame, prices: Sequence[str] = ("open", "high", "low", "close")) -> DataFrame:
    """Drop bars with any missing price; a volume alone does not make a bar."""
    return bars.na.drop(subset=list(prices))


def last_n(df: DataFrame, by: Keys, dt: str, n: int = 3) -> DataFrame:
    """The last n rows per entity.

    Spark limits each group map-side before the shuffle, so at most n rows per entity and
    task move.
    """
    newest = Window.partitionBy(*as_keys(by)).orderBy(F.col(dt).desc())
    return df.withColumn("_rank", F.row_number().over(newest)).filter(F.col("_rank") <= n).drop("_rank")


def missing_entities(expected: DataFrame, df: DataFrame, ent: str) -> DataFrame:
    """Expected entities without a single row; both sides are reduced to entities before the join."""
    return expected.select(ent).distinct().join(df.select(ent).distinct(), ent, "left_anti")


def require_some(expected: DataFrame, df: DataFrame, ent: str) -> DataFrame:
    """`missing_entities`, but the job fails when every expected entity is missing."""
    missing = missing_entities(expected, df, ent)
    absent = missing.agg(F.count(F.lit(1)).alias("n")).scalar()
    wanted = expected.agg(F.count_distinct(ent).alias("n")).scalar()
    return missing.withColumn(
        ent, F.when(absent < wanted, F.col(ent)).otherwise(F.raise_error(F.lit("no rows for any expected entity")))
    )


def classify(
    df: DataFrame,
    ent: str,
    groups: Mapping[str, Sequence[str]] | DataFrame,
    default: str | None = "basket",
    out: str = "category",
) -> DataFrame:
    """Category per entity from member lists, or from a dimension frame with `ent` and `out`."""
    if isinstance(groups, DataFrame):
        return df.join(groups.select(ent, out), ent, "left").withColumn(out, F.coalesce(out, F.lit(default)))
    return df.withColumn(out, member_of(ent, groups, default))


def latest(df: DataFrame, by: Keys, dt: str) -> DataFrame:
    """The row with the greatest date per entity; an aggregate, so one entity's rows stay spread.

    One `max_by` per column, all ordered by the date: they move in step and so pick the same
    row, and with fixed-width columns Spark hashes instead of sorting.
    """
    keys = as_keys(by)
    rest = [c for c in df.columns if c not in keys]
    newest = [(F.max(dt) if c == dt else F.max_by(c, dt)).alias(c) for c in rest]
    return df.groupBy(*keys).agg(*newest).select(*df.columns)


def trailing_count(events: DataFrame, cat: str, ts: str, days: int = 7, out: str = "count") -> DataFrame:
    """Events in the trailing `days` calendar days per category, as of every day with events.

    Daily counts come first, so the window sees one row per category and calendar day.
    """
    daily = events.groupBy(cat, utc_date(ts).alias("snapshot_date")).agg(F.count(F.lit(1)).alias("_n"))
    span = Window.partitionBy(cat).orderBy(F.unix_date("snapshot_date")).rangeBetween(-(days - 1), 0)
    return daily.select(cat, "snapshot_date", F.sum("_n").over(span).alias(out))


def running_level(events: DataFrame, ent: str, ts: str, out: str = "level") -> DataFrame:
    """Events so far per entity and day: a growing counter from an event stream."""
    daily = events.groupBy(ent, utc_date(ts).alias("snapshot_date")).agg(F.count(F.lit(1)).alias("_n"))
    span = Window.partitionBy(ent).orderBy("snapshot_date").rowsBetween(Window.unboundedPreceding, 0)
    return daily.select(ent, "snapshot_date", F.sum("_n").over(span).alias(out))
