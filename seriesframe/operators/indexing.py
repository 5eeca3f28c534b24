"""Series brought to a common base or a common date axis."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seriesframe.functions.columns import ratio
from seriesframe.functions.ordered import CHUNK, chunk_of
from seriesframe.operators.panels import trail


def index_to_first(df: DataFrame, ent: str, dt: str, val: str, out: str = "index") -> DataFrame:
    """100 x value / value at the entity's first date; NULL for a zero or NULL baseline.

    The baseline is found per (entity, chunk) and joined back on both, so an entity with
    many rows is spread over its chunks on either side of the join.
    """
    cut = df.withColumn(CHUNK, chunk_of(df, dt))
    firsts = cut.groupBy(ent, CHUNK).agg(F.min_by(val, dt).alias("_first"))
    in_order = Window.partitionBy(ent).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, 0)
    base = firsts.select(ent, CHUNK, F.first("_first").over(in_order).cast("double").alias("_base"))
    return (
        cut.join(base, [ent, CHUNK])
        .withColumn(out, ratio(F.col(val), F.col("_base")) * 100)
        .select(*df.columns, out)
    )


def rebase(df: DataFrame, ent: str, dt: str, val: str, days: int | None, out: str = "index") -> DataFrame:
    """`index_to_first` inside a trailing window that all entities share."""
    return index_to_first(trail(df, dt, days), ent, dt, val, out)


def align(df: DataFrame, ent: str, dt: str, val: str, entities: Sequence[str], days: int | None = None) -> DataFrame:
    """One row per date of the window, one column per named entity, gaps NULL."""
    cols = [F.max(F.when(F.col(ent) == e, F.col(val))).alias(e) for e in entities]
    return trail(df, dt, days).groupBy(dt).agg(*cols)


def align_long(
    df: DataFrame, ent: str, dt: str, val: str, entities: Sequence[str], days: int | None = None
) -> DataFrame:
    """`align` as (date, entity, value) rows, gaps kept as NULL values."""
    return align(df, ent, dt, val, entities, days).unpivot(dt, list(entities), ent, val)
