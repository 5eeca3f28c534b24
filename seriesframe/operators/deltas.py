"""What late rows change in tables that are derived from them, each operator with its own reach.

A bar changes its own return and the next one; a return changes the deviations of the rows whose frame holds it; a
date's mean changes with any return of that date; an indexed entity changes as a whole only with its first date; a
trailing count changes for the days whose window holds the event; a cumulative curve changes from the first changed
date on. Every function gives the rows to merge into the derived table, computed from the base table as it is after
the late rows have been merged. Rows that come out although they did not change are equal to the old ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesframe.functions.columns import ratio, utc_date
from seriesframe.functions.ordered import rolling, with_running
from seriesframe.operators.findings import cohort_days
from seriesframe.operators.returns import basket_vs_benchmark
from seriesframe.operators.shaping import trailing_count


def changed_returns(daily: DataFrame, late: DataFrame, ent: str, dt: str, prev_dt: str) -> DataFrame:
    """(entity, date) of the returns that late bars change: their own and those right after them."""
    own = late.filter(F.col(ent).isNotNull() & F.col(dt).isNotNull()).select(ent, dt).distinct()
    after = daily.join(own.withColumnRenamed(dt, prev_dt), [ent, prev_dt], "left_semi").select(ent, dt)
    return own.unionByName(after).distinct()


def volatility_delta(
    daily: DataFrame, changed: DataFrame, ent: str, dt: str, ret: str = "daily_return", n: int = 20, out: str = "rolling_volatility"
) -> DataFrame:
    """Rolling deviations that changed returns are in, up to n - 1 rows ahead, of the touched entities only.

    Rows at which an entity has seen few usable returns come out too, as an added one may open the gate later on.
    """
    touched = changed.groupBy(ent).agg(F.count(F.lit(1)).alias("_changes"))
    rows = daily.select(ent, dt, ret).join(touched, ent).join(changed.withColumn("_hit", F.lit(1)), [ent, dt], "left")
    usable = F.when(F.col(ret).isNotNull(), 1).otherwise(0)
    placed = with_running(rows, ent, dt, {"_seen": ("sum", usable), "_pos": ("sum", F.lit(1))})
    framed = rolling(placed, ent, "_pos", n, lambda w: {"_dev": F.stddev_samp(ret).over(w), "_near": F.max("_hit").over(w)})
    reached = framed.filter(F.col("_near").isNotNull() | (F.col("_seen") < n + F.col("_changes")))
    return reached.select(ent, dt, F.when(F.col("_seen") >= n, F.col("_dev")).alias(out))


def spread_delta(daily: DataFrame, changed: DataFrame, dt: str, basket: str = "basket", benchmark: str = "benchmark") -> DataFrame:
    """Basket and benchmark returns of the touched dates, from all entities' returns of these dates."""
    # one row per calendar date at most
    dates = F.broadcast(changed.select(dt).distinct())
    return basket_vs_benchmark(daily.join(dates, dt, "left_semi"), dt, basket=basket, benchmark=benchmark)


def index_delta(values: DataFrame, late: DataFrame, ent: str, dt: str, val: str, out: str = "index") -> DataFrame:
    """Indexed late rows, and all rows of entities whose first date is among the late ones."""
    own = late.select(ent, dt).distinct()
    touched = values.select(ent, dt, val).join(own.select(ent).distinct(), ent, "left_semi")
    bases = touched.groupBy(ent).agg(F.min(dt).alias("_first"), F.min_by(val, dt).cast("double").alias("_base"))
    rebased = bases.join(own, (own[ent] == bases[ent]) & (own[dt] == bases["_first"]), "left_semi").select(ent, F.lit(True).alias("_whole"))
    rows = touched.join(own.withColumn("_late", F.lit(True)), [ent, dt], "left").join(rebased, ent, "left")
    rows = rows.filter(F.col("_late") | F.col("_whole")).join(bases, ent)
    return rows.select(ent, dt, val, (ratio(F.col(val), F.col("_base")) * 100).alias(out))


def trailing_delta(events: DataFrame, late: DataFrame, cat: str, ts: str, days: int = 7) -> DataFrame:
    """Trailing counts of the days whose window holds a late event, from the events near them."""
    touched = late.select(cat, utc_date(ts).alias("_d")).distinct()
    around = touched.select(cat, F.explode(F.sequence(F.date_sub("_d", days - 1), F.date_add("_d", days - 1))).alias("_near")).distinct()
    near = events.withColumn("_near", utc_date(ts)).join(around, [cat, "_near"], "left_semi")
    reach = touched.select(cat, F.explode(F.sequence(F.col("_d"), F.date_add("_d", days - 1))).alias("snapshot_date")).distinct()
    return trailing_count(near, cat, ts, days).join(reach, [cat, "snapshot_date"], "left_semi")


def curve_delta(
    curve: DataFrame, members: DataFrame, changed: DataFrame, dt: str, val: str, group: str = "cohort", out: str = "cumulative"
) -> DataFrame:
    """The cohorts' curves from their first changed date on.

    `changed` has cohort and date. Means are formed anew for these dates only; the others, and the value that a curve
    had before, come from the kept `curve`. A changed date that no member has a return on any more comes out with NULLs,
    which stand for no row in a kept curve.
    """
    since = changed.groupBy(group).agg(F.min(dt).alias("_since"))
    fresh = cohort_days(members.join(changed.distinct(), [group, dt], "left_semi"), dt, val, group)
    known = curve.filter(F.col("mean_return").isNotNull()).select(group, dt, "mean_return", out).join(since, group)
    gone = changed.select(group, dt).distinct().join(fresh, [group, dt], "left_anti")
    start = known.filter(F.col(dt) < F.col("_since")).groupBy(group).agg(F.max_by(out, dt).alias("_start"))
    rest = known.filter(F.col(dt) >= F.col("_since")).select(group, dt, "mean_return")
    rest = rest.join(changed.select(group, dt), [group, dt], "left_anti")
    tail = with_running(rest.unionByName(fresh), group, dt, {"_grown": ("product", 1 + F.col("mean_return"))})
    grown = (1 + F.coalesce("_start", F.lit(0.0))) * F.col("_grown") - 1
    moved = tail.join(start, group, "left").select(group, dt, "mean_return", grown.alias(out))
    return moved.unionByName(gone, allowMissingColumns=True)
