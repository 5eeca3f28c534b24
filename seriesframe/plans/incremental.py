"""Late rows brought through all derived tables, without a rebuild of any.

`build` makes the tables of a folder from their base tables once; `land_bars`, `land_values` and `land_events` merge
late rows into a base table and then only what they change into the tables derived from it. Every merge rewrites the
touched periods alone, and doing a step again gives the same tables.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesframe.functions.columns import utc_date
from seriesframe.operators import deltas, findings, indexing, returns, shaping
from seriesframe.sources.tables import PERIOD, read_table
from seriesframe.sources.upsert import upsert
from seriesframe.sources.workspace import written
from seriesframe.streaming.jobs import recover_late


@dataclass(frozen=True)
class Gold:
    """The folder of the tables, the cohorts whose curves are kept, and the grain of the periods."""

    folder: str
    cohorts: Mapping[str, Sequence[str]]
    grain: str = "month"

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def table(self, spark: SparkSession, name: str) -> DataFrame:
        return read_table(spark, self.path(name))

    def merge(self, rows: DataFrame, name: str, keys: Sequence[str], dt: str) -> DataFrame:
        return upsert(rows.sparkSession, self.path(name), rows.drop(PERIOD), keys, dt, None, self.grain)

    def members(self, daily: DataFrame) -> DataFrame:
        return findings.cohort(daily.select("symbol", "date", "daily_return"), "symbol", self.cohorts)


BAR, VALUE, COUNT, CURVE = ["symbol", "date"], ["entity", "date"], ["category", "snapshot_date"], ["cohort", "date"]


def build(gold: Gold, bars: DataFrame, values: DataFrame, events: DataFrame) -> None:
    """All tables from their base rows: bars, values (entity, date, value), events (event_id, category, ts)."""
    gold.merge(bars, "bars", BAR, "date")
    daily = gold.merge(returns.market_daily(gold.table(bars.sparkSession, "bars"), prev_dt="prev_date"), "market_daily", BAR, "date")
    gold.merge(returns.rolling_vol(daily, "symbol", "date"), "volatility", BAR, "date")
    gold.merge(returns.basket_vs_benchmark(daily), "spread", ["date"], "date")
    gold.merge(findings.cohort_curve(gold.members(daily), "date", "daily_return"), "curves", CURVE, "date")
    base = gold.merge(values, "values", VALUE, "date")
    gold.merge(indexing.index_to_first(base.drop(PERIOD), "entity", "date", "value"), "indexed", VALUE, "date")
    seen = gold.merge(events.withColumn("day", utc_date("ts")), "events", ["event_id", "day"], "day")
    gold.merge(shaping.trailing_count(seen, "category", "ts"), "counts", COUNT, "snapshot_date")


def land_bars(gold: Gold, late: DataFrame) -> None:
    """Merge late bars, then the returns, deviations, spreads and curves that they change."""
    spark = late.sparkSession
    daily = recover_late(spark, gold.path("bars"), gold.path("market_daily"), late, order_col=None, grain=gold.grain, prev_dt="prev_date")
    changed = written(deltas.changed_returns(daily, late, "symbol", "date", "prev_date"), "changed-returns")
    gold.merge(deltas.volatility_delta(daily, changed, "symbol", "date"), "volatility", BAR, "date")
    gold.merge(deltas.spread_delta(daily, changed, "date"), "spread", ["date"], "date")
    members = gold.members(daily)
    moved = members.join(changed, BAR, "left_semi").select("cohort", "date").distinct()
    gold.merge(deltas.curve_delta(gold.table(spark, "curves"), members, moved, "date", "daily_return"), "curves", CURVE, "date")


def land_values(gold: Gold, late: DataFrame) -> None:
    """Merge late values, then the index rows that they change."""
    base = gold.merge(late, "values", VALUE, "date")
    gold.merge(deltas.index_delta(base, late, "entity", "date", "value"), "indexed", VALUE, "date")


def land_events(gold: Gold, late: DataFrame) -> None:
    """Merge late events, then the trailing counts that they change."""
    base = gold.merge(late.withColumn("day", utc_date("ts")), "events", ["event_id", "day"], "day")
    gold.merge(deltas.trailing_delta(base, late, "category", "ts"), "counts", COUNT, "snapshot_date")
