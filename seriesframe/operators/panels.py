"""Operators over a trailing window of 1, 7, 30, 90 days or the whole history.

Which date a window ends on, and whether NULLs go before or after the cut, differs per
operator and is part of its meaning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesframe.functions.columns import compound
from seriesframe.functions.ordered import CHUNK, Keys, as_keys, chunk_of, with_prev
from seriesframe.operators.shaping import latest
from seriesframe.sources.tables import PERIOD, grain_of, period_of
from seriesframe.sources.workspace import written

# The window choices, in days; None is the whole history.
WINDOW_DAYS = (1, 7, 30, 90, None)


def span_days(days: int | None) -> int | None:
    """Days to reach back for returns: each row already spans the day before it."""
    return None if days is None else max(days - 1, 0)


def _since(df: DataFrame, dt: str, floor: Column, grain: str | None = None) -> DataFrame:
    """Rows from `floor` on. Of a table by periods of `dt`, marked or with its grain given, whole partitions are skipped."""
    kept, grain = df.filter(F.col(dt) >= floor), grain or grain_of(df, dt)
    return kept.filter(F.col(PERIOD) >= period_of(floor, grain)) if grain else kept


def trail(df: DataFrame, dt: str, days: int | None, by: Keys = None, grain: str | None = None) -> DataFrame:
    """Rows with dt >= latest dt - days, the latest taken over the frame or per entity.

    The shared anchor is a scalar subquery, evaluated before the scan. Per-entity cut-offs
    are joined on (entity, chunk), which spreads an entity with many rows; the lowest
    cut-off is applied first as a plain filter. A table by periods that was written or merged here is marked as
    such; `grain` tells it of others. A column that only has the period's name is a column as any other.
    """
    if days is None:
        return df
    keys = as_keys(by)
    if not keys:
        newest = df.agg(F.max(dt).alias("_anchor")).scalar()
        return _since(df, dt, F.date_sub(newest, days), grain)
    ends = df.groupBy(*keys).agg(F.max(dt).alias("_anchor")).withColumn("_cutoff", F.date_sub("_anchor", days))
    floor = ends.agg(F.min("_cutoff").alias("_floor")).scalar()
    chunks = F.sequence(chunk_of(df, dt, F.col("_cutoff")), chunk_of(df, dt, F.col("_anchor")))
    limits = ends.filter(F.col("_anchor").isNotNull()).select(
        *[F.col(k).alias(f"_k_{k}") for k in keys], "_cutoff", F.explode(chunks).alias("_c")
    )
    cut = _since(df, dt, floor, grain).withColumn(CHUNK, chunk_of(df, dt))
    match = F.col(CHUNK) == F.col("_c")
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return cut.join(limits, match).filter(F.col(dt) >= F.col("_cutoff")).select(*df.columns)


def compound_return(
    df: DataFrame,
    dt: str,
    ret: str,
    days: int | None,
    by: Keys = None,
    prev_dt: str | None = None,
    extra: Sequence[Column] = (),
    grain: str | None = None,
) -> DataFrame:
    """Compound return over the window, per entity or for one series, with the dates it covers.

    The window ends at the latest row, NULL return or not; NULLs are left out afterwards.
    `start_date` is the row before the first one used, where there is one. `prev_dt` names
    a column that already holds the previous row's date. Entities without any usable return
    keep a row of NULLs. `grain` is that of a table by periods, as for `trail`.
    """
    keys, used = as_keys(by), F.col(ret).isNotNull()
    if prev_dt is None and not keys:
        kept = trail(df, dt, span_days(days), None, grain)
        first = kept.filter(used).agg(F.min(dt).alias("_first")).scalar()
        before = df.filter(F.col(dt) < first).agg(F.max(dt).alias("_before")).scalar()
        return kept.agg(
            compound(F.col(ret)).alias("value"),
            F.min(F.when(used, F.col(dt))).alias("start_date"),
            F.max(F.when(used, F.col(dt))).alias("end_date"),
            *extra,
        ).withColumn("start_date", F.coalesce(before, F.col("start_date")))
    if prev_dt is None:
        df, prev_dt = with_prev(df, keys, dt, {"_prev_dt": dt}), "_prev_dt"
    start = F.min_by(F.coalesce(prev_dt, dt), F.when(used, F.col(dt)))
    return (
        trail(df, dt, span_days(days), keys, grain)
        .groupBy(*keys)
        .agg(
            compound(F.col(ret)).alias("value"),
            start.alias("start_date"),
            F.max(F.when(used, F.col(dt))).alias("end_date"),
            *extra,
        )
    )


def rank_returns(
    df: DataFrame, dt: str, ret: str, days: int | None, by: Keys, prev_dt: str | None = None
) -> DataFrame:
    """Compound returns per entity, best first; entities without one are left out."""
    keys = as_keys(by)
    board = compound_return(df, dt, ret, days, keys, prev_dt).filter(F.col("value").isNotNull())
    return board.orderBy(F.col("value").desc(), *keys)


def level_delta(df: DataFrame, by: Keys, dt: str, val: str, days: int | None) -> DataFrame:
    """Last minus first level in the entity's own window; NULL with fewer than two readings.

    NULL readings go first, so the window ends at the latest known level.
    """
    keys = as_keys(by)
    known = trail(df.filter(F.col(val).isNotNull()), dt, days, keys)
    ends = known.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        (F.max_by(val, dt) - F.min_by(val, dt)).alias("_delta"),
        F.min(dt).alias("_start"),
        F.max(dt).alias("_end"),
    )
    enough = F.col("_n") >= 2
    return ends.select(
        *keys,
        F.when(enough, F.col("_delta")).alias("value"),
        F.when(enough, F.col("_start")).alias("start_date"),
        F.when(enough, F.col("_end")).alias("end_date"),
    )


def growth_board(df: DataFrame, by: Keys, dt: str, val: str, days: int | None) -> DataFrame:
    """Level deltas, largest first; entities with too little history are left out."""
    board = level_delta(df, by, dt, val, days).filter(F.col("value").isNotNull())
    return board.orderBy(F.col("value").desc(), *as_keys(by))


def window_sum(df: DataFrame, by: Keys, dt: str, val: str, days: int | None) -> DataFrame:
    """Sum per entity over one window that all entities share; its dates are on every row."""
    known = df.filter(F.col(val).isNotNull())
    kept = trail(known, dt, days)
    start, end = kept.agg(F.min(dt).alias("_start")).scalar(), known.agg(F.max(dt).alias("_anchor")).scalar()
    return kept.groupBy(*as_keys(by)).agg(F.sum(val).alias("value")).withColumns({"start_date": start, "end_date": end})


def top_n_other(sums: DataFrame, key: str, val: str, n: int, other: str = "Other") -> DataFrame:
    """The n largest rows by value and one row with the sum of the rest, if there is a rest.

    `slot` is the display position, the rest being last. Only the n top rows are ranked
    and broadcast.
    """
    top = sums.select(key, val).orderBy(F.col(val).desc_nulls_last(), key).limit(n)
    place = Window.partitionBy(F.lit(0)).orderBy(F.col(val).desc_nulls_last(), key)
    named = top.select(F.col(key).cast("string").alias(key), val, F.row_number().over(place).alias("slot"))
    head = F.broadcast(top.select(F.col(key).alias("_top")))
    rest = (
        sums.join(head, F.col(key).eqNullSafe(F.col("_top")), "left_anti")
        .agg(F.sum(val).alias(val), F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > 0)
        .select(F.lit(other).alias(key), val, F.lit(n + 1).alias("slot"))
    )
    return named.unionByName(rest)


def share(df: DataFrame, val: str, out: str = "share_pct") -> DataFrame:
    """Percent of the frame's total, 0 where the total is 0. The total is a scalar subquery."""
    return _percent(df, val, out, df.agg(F.sum(val).cast("double").alias("_total")).scalar())


def _percent(df: DataFrame, val: str, out: str, total: Column) -> DataFrame:
    return df.withColumn(out, F.when(total > 0, F.col(val) / F.nullif(total, F.lit(0.0)) * 100).otherwise(F.lit(0.0)))


def volume_board(df: DataFrame, ent: str, dt: str, val: str, days: int | None, n: int = 6) -> DataFrame:
    """Share of the window's sum: top n entities and the rest."""
    # one row per entity, read three times
    sums = written(window_sum(df, ent, dt, val, days).select(ent, "value"), "window-sums")
    board = top_n_other(sums, ent, "value", n)
    # the board has n + 1 rows at most
    total = F.sum("value").over(Window.partitionBy(F.lit(0))).cast("double")
    return _percent(board.withColumn("_total", total), "value", "share_pct", F.col("_total")).drop("_total")


def ohlc_window(
    bars: DataFrame, by: Keys, dt: str, days: int | None, ret: str = "daily_return", prev_dt: str | None = None
) -> DataFrame:
    """Open of the first bar, highest high, lowest low, latest close and return of the window."""
    extra = [
        F.min_by("open", dt).alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", dt).alias("close"),
        F.max(dt).alias("as_of"),
    ]
    return compound_return(bars, dt, ret, days, by, prev_dt, extra)


def indicator_board(
    df: DataFrame, ent: str, dt: str, val: str, days: int | None, not_rates: Sequence[str] = ()
) -> DataFrame:
    """Latest reading and windowed change per series, and whether the change exists.

    Series in `not_rates` (index levels) are marked as out of the rate comparison.
    """
    now = latest(df.select(ent, dt, val), ent, dt)
    change = level_delta(df, ent, dt, val, days).withColumnRenamed("value", "change")
    return now.join(change, ent, "left").withColumns(
        {
            "enough_history": F.col("change").isNotNull(),
            "rate_series": ~F.col(ent).isin(list(not_rates)) if not_rates else F.lit(True),
        }
    )


def readiness(df: DataFrame, dt: str, val: str, needed: int = 20) -> DataFrame:
    """How much history there is: rows, usable values, distinct dates, and what they allow.

    With fewer than two dates a panel shows the latest row only.
    """
    return df.agg(
        F.count(F.lit(1)).alias("collected"),
        F.count(val).alias("usable"),
        F.count_distinct(dt).alias("dates"),
    ).select(
        "collected",
        F.lit(needed).cast("long").alias("needed"),
        "usable",
        "dates",
        (F.col("usable") > 0).alias("ready"),
        (F.col("dates") < 2).alias("latest_only"),
    )


def as_of(df: DataFrame, dt: str) -> DataFrame:
    return df.agg(F.max(dt).alias("as_of"))


def known_tail(df: DataFrame, dt: str, val: str, days: int | None) -> DataFrame:
    """Non-NULL rows of the trailing window, with the table's latest reading beside them.

    The window ends at the latest known value; `latest_date` and `latest_value` come from
    the latest row, which may hold a NULL.
    """
    last = df.agg(F.max(dt).alias("d"), F.max_by(val, dt).alias("v"))
    return trail(df.filter(F.col(val).isNotNull()), dt, days).withColumns(
        {"latest_date": last.select("d").scalar(), "latest_value": last.select("v").scalar()}
    )
