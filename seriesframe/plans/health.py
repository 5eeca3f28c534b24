"""The daily health report over the gold tables: run log, freshness, verdict, latest readings."""

from __future__ import annotations

import sys
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesframe.operators import freshness
from seriesframe.operators.freshness import TableSpec
from seriesframe.sources.tables import read_table, write_snapshot
from seriesframe.sources.workspace import utc

# Source, date column, cadence and panel of every gold table.
SPECS = [
    TableSpec("market_daily", "market_data", "market_data", "date", "trading_day", "Market snapshot"),
    TableSpec("sector_rotation", "market_data", "market_data", "date", "trading_day", "Sector rotation"),
    TableSpec("basket_vs_benchmark", "market_data", "market_data", "date", "trading_day", "Spread"),
    TableSpec("basket_detail", "market_data", "market_data", "date", "trading_day", "Composition"),
    TableSpec("volatility", "market_data", "market_data", "date", "trading_day", "Volatility"),
    TableSpec("macro_snapshot", "macro_data", "macro_data", "date", "mixed", "Macro backdrop"),
    TableSpec("attention_index", "attention_data", "attention_data", "date", "daily_lagged", "Attention"),
    TableSpec("dev_momentum", "dev_momentum", "dev_momentum", "snapshot_date", "daily", "Dev momentum"),
    TableSpec("research_pace", "research_pace", "research_pace", "snapshot_date", "daily", "Research pace"),
]
MONTHLY_SERIES = ("cpi", "unemployment_rate", "fed_funds_rate")


def report(
    gold: Mapping[str, DataFrame],
    runs: DataFrame,
    incidents: DataFrame,
    as_of: Column,
    monthly: Sequence[str] = MONTHLY_SERIES,
    specs: Sequence[TableSpec] = SPECS,
) -> dict[str, DataFrame]:
    """The report's tables by name, each a lazy frame.

    `runs` has ts, event, status and conclusion; `incidents` has opened, title and state.
    """
    spark = runs.sparkSession
    tables = freshness.table_freshness(gold, specs, as_of)
    series = freshness.series_freshness(gold["macro_snapshot"], "series", "date", monthly, as_of)
    stale = freshness.stale_sources(tables, series, "series", "macro:")
    state = freshness.run_state(runs, as_of, "ts")
    opened = freshness.open_incidents(incidents, "opened", "title")
    known_vol = gold["volatility"].filter(F.col("rolling_20d_volatility").isNotNull())
    return {
        "recent_runs": freshness.last_run_per_day(runs, as_of, "ts", ["event", "status"]),
        "run_state": state,
        "open_incidents": opened,
        "tables": freshness.lineage(tables, freshness.registry(spark, specs)),
        "series": series,
        "stale": stale,
        "verdict": freshness.verdict(state, opened, stale),
        "digest": freshness.digest(
            {
                "market": (gold["market_daily"].filter(F.col("category") == "benchmark"), "symbol", "date", "close"),
                "spread": (gold["basket_vs_benchmark"], None, "date", "spread"),
                "volatility": (known_vol, "symbol", "date", "rolling_20d_volatility"),
                "macro": (gold["macro_snapshot"], "series", "date", "value"),
                "attention": (gold["attention_index"], "article", "date", "views"),
                "levels": (
                    freshness.at_latest_date(gold["dev_momentum"], "snapshot_date"),
                    "repo",
                    "snapshot_date",
                    "stars",
                ),
                "counts": (gold["research_pace"], "category", "snapshot_date", "count"),
            }
        ),
    }


def run(spark: SparkSession, lake: str, runs: str, incidents: str, as_of: Column, out: str) -> dict[str, DataFrame]:
    """Write every table of the report under a folder."""
    gold = {s.name: read_table(spark, f"{lake}/gold/{s.name}") for s in SPECS}
    tables = report(gold, read_table(spark, runs), read_table(spark, incidents), as_of)
    for name, df in tables.items():
        write_snapshot(df, f"{out}/{name}")
    return tables


def main() -> None:
    """LAKE RUNS INCIDENTS AS_OF OUT, AS_OF being a UTC time such as 2024-03-06T21:30:00Z."""
    lake, runs, incidents, as_of, out = sys.argv[1:6]
    spark = utc(SparkSession.builder.appName("health").getOrCreate())
    run(spark, lake, runs, incidents, F.lit(as_of).cast("timestamp"), out)


if __name__ == "__main__":
    main()
