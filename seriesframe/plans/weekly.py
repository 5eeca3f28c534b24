"""The weekly job: headline metrics of all findings, kept as history, compared with the last run."""

from __future__ import annotations

import sys
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesframe.operators import findings
from seriesframe.operators.panels import as_of
from seriesframe.operators.snapshots import append_snapshot, last_two, metric_change, snapshot_rows
from seriesframe.sources.tables import read_table, write_snapshot
from seriesframe.sources.workspace import utc, written

YIELD_SERIES = "10y_yield"

# Places at which a step counts as flat, per section and metric; one place elsewhere.
CHANGE_DECIMALS = {
    ("lag", "best_corr"): 2,
    ("rates", "typical"): 0,
    ("rates", "total"): 0,
    ("volatility", "latest_pct"): 2,
    ("volatility", "max_pct"): 2,
}


def headline_metrics(
    market: DataFrame,
    spread: DataFrame,
    attention: DataFrame,
    volatility: DataFrame,
    yields: DataFrame,
    run_date: Column,
    cohorts: Mapping[str, Sequence[str]],
    vol_col: str = "rolling_volatility",
    basket: str = "basket",
    sector: str = "sector",
) -> DataFrame:
    """Long rows (snapshot_date, section, metric, value, label) of one run.

    `market` has symbol, category, date, volume and daily_return; `attention` has date and
    views; `yields` is one series of date and value. `cohorts` names two member lists, the
    first compared with the second. Volatility is kept in percent. Every sector that did better
    on rising days has a row `exception:<sector>` of its own.
    """
    holdings = market.filter(F.col("category") == basket)
    # series of one row per date and sums of one row per entity are written, so that no table is read for every metric
    daily = written(findings.total_change(attention, "date", "views"), "daily-totals")
    lags = findings.lag_corr(daily, spread, "date", "pct_change", "basket_return")
    spikes = findings.top_spikes(daily, "date", "pct_change")
    study = findings.event_study(spikes, daily, spread, "date", "pct_change", "basket_return")
    labels = findings.direction(yields, "date", "value")
    sectors = market.filter(F.col("category") == sector)
    sensitivity = findings.conditional_return(sectors, labels, "symbol", "date", "daily_return")
    sensitivity = written(sensitivity, "sensitivity")
    members = findings.cohort(holdings, "symbol", cohorts)
    summary = findings.cohort_summary(members, "symbol", "date", "daily_return")
    left, right = list(cohorts)
    sections = {
        "spread": (
            findings.spread_totals(spread, "date", "basket_return", "benchmark_return"),
            {"basket_pct": "left_total_pct", "benchmark_pct": "right_total_pct", "spread_pts": "spread_pts"},
        ),
        "lag": (findings.best_lag(lags), {"best_lag": "best_lag", "best_corr": "best_corr"}),
        "events": (
            findings.event_summary(study),
            {
                "return_before_pct": "return_before_pct",
                "return_after_pct": "return_after_pct",
                "gap_pts": "gap_pts",
            },
        ),
        "concentration": (
            findings.concentration(holdings, "symbol", "volume"),
            {"top_entity": "top_entity", "top_share_pct": "top_share_pct", "hhi": "hhi", "effective_n": "effective_n"},
        ),
        "rates": (findings.exception_counts(sensitivity), {"typical": "typical", "total": "total"}),
        "volatility": (
            findings.extremes(volatility.withColumn("_pct", F.col(vol_col) * 100), "date", "_pct"),
            {"latest_pct": "latest_value", "max_pct": "max_value", "max_date": "max_date"},
        ),
        "cohorts": (
            findings.cohort_gap(summary, left, right),
            {
                "left_final_pct": "left_final_pct",
                "right_final_pct": "right_final_pct",
                "gap_pts": "gap_pts",
                "negative_members": "negative_members",
            },
        ),
    }
    against = findings.exceptions(sensitivity).select(
        run_date.alias("snapshot_date"),
        F.lit("rates").alias("section"),
        F.concat(F.lit("exception:"), "symbol").alias("metric"),
        F.lit(None).cast("double").alias("value"),
        F.col("symbol").alias("label"),
    )
    return snapshot_rows(sections, run_date).unionByName(against)


def from_gold(spark: SparkSession, lake: str, cohorts: Mapping[str, Sequence[str]]) -> DataFrame:
    """`headline_metrics` of the gold tables that the daily job keeps."""

    def gold(name: str) -> DataFrame:
        return read_table(spark, f"{lake}/gold/{name}")

    market = gold("market_daily")
    return headline_metrics(
        market,
        gold("basket_vs_benchmark"),
        gold("attention_index"),
        gold("volatility"),
        gold("macro_snapshot").filter((F.col("series") == YIELD_SERIES) & F.col("value").isNotNull()),
        as_of(market, "date").scalar(),
        cohorts,
        vol_col="rolling_20d_volatility",
        basket="ai_basket",
    )


def run(spark: SparkSession, history: str, metrics: DataFrame) -> DataFrame:
    """Append the run to the history and return how its metrics moved since the run before."""
    recent = last_two(append_snapshot(spark, history, metrics))
    numbers = recent.filter(F.col("value").isNotNull())
    places = F.lit(1)
    for (section, metric), n in CHANGE_DECIMALS.items():
        places = F.when((F.col("section") == section) & (F.col("metric") == metric), n).otherwise(places)
    return metric_change(numbers, places).filter(F.col("age") == 1).drop("age", "period")


def main() -> None:
    """LAKE HISTORY CHANGES INFRA=A,B CORE=C,D: add a run to the history and write how its metrics moved."""
    lake, history, changes, *lists = sys.argv[1:]
    cohorts = {name: members.split(",") for name, members in (x.split("=", 1) for x in lists)}
    spark = utc(SparkSession.builder.appName("weekly").getOrCreate())
    write_snapshot(run(spark, history, from_gold(spark, lake, cohorts)), changes)


if __name__ == "__main__":
    main()
