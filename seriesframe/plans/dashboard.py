"""What the dashboard panels show for a chosen window, computed from the gold tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesframe.functions.columns import short_label, spaced_label
from seriesframe.operators import indexing, panels

# Fixed value: series that are index levels, not rates.
NOT_RATES = ("cpi",)


def spread_returns(spread: DataFrame, days: int | None) -> DataFrame:
    """Compound return of the basket and of the benchmark, one row per side."""
    sides = [
        panels.compound_return(spread.select("date", side), "date", side, days).withColumn("side", F.lit(side))
        for side in ("basket_return", "benchmark_return")
    ]
    return reduce(DataFrame.unionByName, sides)


def panel_tables(
    gold: Mapping[str, DataFrame], days: int | None = 30, not_rates: Sequence[str] = NOT_RATES
) -> dict[str, DataFrame]:
    """The panels' data by name, each a lazy frame, for a window of `days` (None: everything)."""
    bench = gold["market_daily"].filter(F.col("category") == "benchmark")
    attention = gold["attention_index"].select("article", "date", "views")
    growth = panels.growth_board(gold["dev_momentum"], "repo", "snapshot_date", "stars", days)
    return {
        "market": panels.ohlc_window(bench, "symbol", "date", days),
        "sector_returns": panels.rank_returns(gold["sector_rotation"], "date", "daily_return", days, "symbol"),
        "sector_volume": panels.volume_board(gold["sector_rotation"], "symbol", "date", "volume", days),
        "volatility": panels.known_tail(gold["volatility"], "date", "rolling_20d_volatility", days),
        "indicators": panels.indicator_board(gold["macro_snapshot"], "series", "date", "value", days, not_rates),
        "spread": spread_returns(gold["basket_vs_benchmark"], days),
        "basket_volume": panels.volume_board(gold["basket_detail"], "symbol", "date", "volume", days),
        "attention": indexing.rebase(attention, "article", "date", "views", days).withColumn(
            "label", spaced_label("article")
        ),
        "growth": growth.withColumn("label", short_label("repo")),
        "research": panels.trail(gold["research_pace"], "snapshot_date", days),
        "as_of": panels.as_of(gold["market_daily"], "date"),
    }
