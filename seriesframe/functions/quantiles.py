"""Exact median per group without gathering a group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesframe.functions.ordered import Keys, as_keys, split_window


STEPS = 1024
INFINITE = 2200 * STEPS


def value_chunk(v: Column) -> Column:
    """Chunk number that never falls as the value grows, `STEPS` to every power of two of either sign.

    The scale has no unit: small and large values are split alike. Infinities lie outermost.
    """
    size = F.abs(v.cast("double"))
    power = F.floor(F.log2(size))
    step = F.floor((size / F.pow(F.lit(2.0), power) - 1) * STEPS)
    # log2 may round across a power of two; the bounds keep the numbers in order there
    step = F.greatest(F.lit(0), F.least(F.lit(STEPS - 1), step))
    at = F.when(size == F.lit(float("inf")), F.lit(INFINITE)).otherwise((power + 1076) * STEPS + step)
    return F.when(v == 0, 0).otherwise(F.signum(v) * at).cast("int")


def exact_median(df: DataFrame, by: Keys, val: str, out: str) -> DataFrame:
    """Median of the known values per key; the mean of the middle two for an even count.

    NULL and NaN are not known; infinities keep their place in the order, and the mean of
    both is NaN. Equal values are counted first, so copies of one value cost one row. The
    distinct values are then ranked in `value_chunk`s, with the ranks before a chunk
    carried into it.
    """
    keys = as_keys(by)
    v = F.col(val)
    counted = df.filter(v.isNotNull() & ~F.isnan(v.cast("double"))).groupBy(*keys, val).agg(F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy(*(keys or [F.lit(0)]))
    ranked = split_window(
        counted,
        keys,
        val,
        summarise={"_chunk_n": F.sum("_n")},
        across=lambda _, before: {
            "_n": F.coalesce(F.sum("_chunk_n").over(before), F.lit(0)),
            "_total": F.sum("_chunk_n").over(whole),
        },
        within=lambda w: {
            "_upto": F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, 0)),
            "_group_n": F.first("_total").over(w.rowsBetween(Window.unboundedPreceding, 0)),
        },
        chunk=value_chunk(v),
    )
    first = F.col("_upto") - F.col("_n")
    low, high = F.floor((F.col("_group_n") - 1) / 2), F.floor(F.col("_group_n") / 2)
    has_low = (first <= low) & (low < F.col("_upto"))
    has_high = (first <= high) & (high < F.col("_upto"))
    middle = ranked.filter(has_low | has_high)
    return middle.groupBy(*keys).agg(
        ((F.max(F.when(has_low, v)) + F.max(F.when(has_high, v))) / 2).alias(out)
    )
