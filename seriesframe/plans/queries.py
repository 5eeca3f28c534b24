"""The registered queries: every operator over the sample tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesframe.functions import columns as C
from seriesframe.operators import business_days, findings, freshness, indexing, panels, returns, rollups, shaping, snapshots
from seriesframe.plans.lake import (
    CORE,
    INFRA,
    LEGACY,
    MONTHLY_SERIES,
    TOPICS,
    YIELD_SERIES,
    Lake,
)
from seriesframe.plans import incremental
from seriesframe.plans.weekly import headline_metrics
from seriesframe.sources import landing
from seriesframe.sources.buckets import write_bucketed
from seriesframe.sources.export import export_json, export_json_array
from seriesframe.sources.tables import PERIOD, read_table, row_counts, write_snapshot, write_table
from seriesframe.sources.upsert import upsert
from seriesframe.sources.workspace import new_path
from seriesframe.streaming import jobs, state

# The moments the freshness queries are asked for.
EVENTS_AS_OF = "2024-01-31 13:00:00"
MARKET_AS_OF = "2001-11-05 13:00:00"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[Lake], DataFrame]) -> Callable[[Lake], DataFrame]:
    QUERIES[fn.__name__] = lambda spark, sf_dir: fn(Lake(spark, sf_dir))
    return fn


def register(name: str, fn: Callable[[Lake], DataFrame]) -> None:
    QUERIES[name] = lambda spark, sf_dir: fn(Lake(spark, sf_dir))


def r6(df: DataFrame, *cols: str) -> DataFrame:
    """Six places for results whose last bits depend on the order of summation."""
    return C.round_cols(df, cols, 6)


def no_period(df: DataFrame) -> DataFrame:
    return df.drop(PERIOD)


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def moment(text: str):
    return F.to_timestamp_ntz(F.lit(text))


# --- gold tables ------------------------------------------------------------------------------


@query
def market_daily(lake: Lake) -> DataFrame:
    return returns.market_daily(lake.bars())


@query
def market_daily_by_part(lake: Lake) -> DataFrame:
    """The same over one entity per part: many entities, one plan."""
    return returns.market_daily(lake.part_bars())


@query
def sector_returns(lake: Lake) -> DataFrame:
    return returns.category_returns(lake.bars(), "sector")


@query
def basket_detail(lake: Lake) -> DataFrame:
    return returns.category_returns(lake.bars(), "basket")


@query
def rolling_volatility(lake: Lake) -> DataFrame:
    return r6(returns.rolling_vol(lake.market_daily(), "symbol", "date"), "rolling_volatility")


@query
def rolling_volatility_by_part(lake: Lake) -> DataFrame:
    return r6(returns.rolling_vol(lake.part_daily(), "symbol", "date"), "rolling_volatility")


@query
def basket_vs_benchmark(lake: Lake) -> DataFrame:
    rets = returns.returns(lake.bars().select("symbol", "category", "date", "close"), "symbol", "date", "close")
    return r6(returns.basket_vs_benchmark(rets), "basket_return", "benchmark_return", "spread")


@query
def indicator_trend(lake: Lake) -> DataFrame:
    return returns.trend(no_period(lake.indicators()), "series", "date", "value")


@query
def attention_index(lake: Lake) -> DataFrame:
    return r6(indexing.index_to_first(no_period(lake.attention()), "topic", "date", "views"), "index")


@query
def level_history(lake: Lake) -> DataFrame:
    return lake.levels().select("entity", "snapshot_date", "level")


@query
def trailing_count(lake: Lake) -> DataFrame:
    events = lake.raw("events").withColumnRenamed("event_type", "category")
    return shaping.trailing_count(events, "category", "ts")


@query
def count_history(lake: Lake) -> DataFrame:
    return lake.trailing_counts().select("category", "snapshot_date", "count")


# --- panels -----------------------------------------------------------------------------------


def _bucketed_volatility_of(bars: Callable[[Lake], DataFrame]) -> Callable[[Lake], DataFrame]:
    """Returns and their deviations from a bucketed table, whose rows are not shuffled for either."""

    def volatility(lake: Lake) -> DataFrame:
        buckets = int(lake.spark.conf.get("spark.sql.shuffle.partitions"))
        rows = bars(lake).select("symbol", "date", "close")
        table = write_bucketed(rows, f"bucketed_{uuid.uuid4().hex}", "symbol", "date", buckets)
        daily = returns.returns(table, "symbol", "date", "close")
        return r6(returns.rolling_vol(daily, "symbol", "date"), "rolling_volatility")

    return volatility


register("bucketed_volatility", _bucketed_volatility_of(Lake.bars))
register("bucketed_volatility_by_part", _bucketed_volatility_of(Lake.part_bars))


def _compound_return(days: int | None, table: Callable[[Lake], DataFrame] = Lake.market_daily):
    def run(lake: Lake) -> DataFrame:
        rets = table(lake).select("symbol", "date", "daily_return", "prev_date", PERIOD)
        return r6(panels.compound_return(rets, "date", "daily_return", days, "symbol", "prev_date"), "value")

    return run


for _days in panels.WINDOW_DAYS:
    register(f"compound_return_{_days or 'all'}", _compound_return(_days))
register("compound_return_90_by_part", _compound_return(90, Lake.part_daily))


@query
def trailing_rows_7d(lake: Lake) -> DataFrame:
    """Rows of each symbol's own last seven days."""
    return panels.trail(lake.bars(), "date", 7, "symbol").select("symbol", "date", "close", "volume")


@query
def spread_return_30d(lake: Lake) -> DataFrame:
    """Both sides of the spread chart: one series each, without an entity."""

    def one(side: str) -> DataFrame:
        got = panels.compound_return(lake.spread().select("date", side, PERIOD), "date", side, 30)
        return got.withColumn("side", F.lit(side))

    return r6(union([one("basket_return"), one("benchmark_return")]), "value")


@query
def ohlc_window_30d(lake: Lake) -> DataFrame:
    return r6(panels.ohlc_window(lake.market_daily(), "symbol", "date", 30, prev_dt="prev_date"), "value")


@query
def sector_board(lake: Lake) -> DataFrame:
    return r6(panels.rank_returns(lake.sector(), "date", "daily_return", 30, "symbol", "prev_date"), "value")


def _level_delta(days: int | None):
    return lambda lake: panels.level_delta(lake.levels(), "entity", "snapshot_date", "level", days)


register("level_delta_1", _level_delta(1))
register("level_delta_7", _level_delta(7))
register("level_delta_all", _level_delta(None))


@query
def growth_board(lake: Lake) -> DataFrame:
    return panels.growth_board(lake.levels(), "entity", "snapshot_date", "level", 30)


@query
def indicator_board(lake: Lake) -> DataFrame:
    return r6(panels.indicator_board(lake.indicators(), "series", "date", "value", 30, ["5-LOW"]), "change")


@query
def window_volume_30d(lake: Lake) -> DataFrame:
    return panels.window_sum(lake.bars(), "symbol", "date", "volume", 30)


@query
def top_n_other(lake: Lake) -> DataFrame:
    sums = panels.window_sum(lake.bars(), "symbol", "date", "volume", None)
    return panels.top_n_other(sums, "symbol", "value", 6)


@query
def volume_board_by_part(lake: Lake) -> DataFrame:
    """Top parts of all time and the share of all others together."""
    return r6(panels.volume_board(lake.part_bars(), "symbol", "date", "volume", None, 10), "share_pct")


@query
def volume_share_30d(lake: Lake) -> DataFrame:
    return r6(panels.volume_board(lake.basket(), "symbol", "date", "volume", 30), "share_pct")


@query
def rebased_index_90d(lake: Lake) -> DataFrame:
    return r6(no_period(indexing.rebase(lake.attention(), "topic", "date", "views", 90)), "index")


@query
def aligned_series(lake: Lake) -> DataFrame:
    return indexing.align_long(lake.attention(), "topic", "date", "views", TOPICS, 90)


BAR_MEASURES = {
    "growth": rollups.Measure("growth", "daily_return"),
    "since": rollups.Measure("first", "_since"),
    "upto": rollups.Measure("last", "_upto"),
    "open": rollups.Measure("first", "open"),
    "high": rollups.Measure("max", "high"),
    "low": rollups.Measure("min", "low"),
    "close": rollups.Measure("last", "close"),
}
VOLUME_MEASURES = {"value": rollups.Measure("sum", "volume"), "bars": rollups.Measure("count", "volume")}


def _return_rows(daily: DataFrame) -> DataFrame:
    """Bars with the dates that a compound return over them begins and ends at."""
    used = F.col("daily_return").isNotNull()
    return daily.withColumns(
        {"_since": F.when(used, F.coalesce("prev_date", "date")), "_upto": F.when(used, F.col("date"))}
    )


def _return_windows(kept: DataFrame) -> DataFrame:
    asked = rollups.trailing_windows(kept, "symbol", panels.WINDOW_DAYS)
    found = rollups.over_windows(kept, asked, "symbol", BAR_MEASURES)
    return found.select(
        "symbol",
        "days",
        (F.col("growth") - 1).alias("value"),
        F.col("since").alias("start_date"),
        F.col("upto").alias("end_date"),
        "open",
        "high",
        "low",
        "close",
        F.col("last_day").alias("as_of"),
    )


def _return_windows_of(table: Callable[[Lake], DataFrame], by_part: bool = False):
    def run(lake: Lake) -> DataFrame:
        rolled = rollups.roll_up(_return_rows(table(lake)), "symbol", "date", BAR_MEASURES, daily=by_part)
        kept = rollups.write_rollups(rolled, new_path(lake.spark, "rollups"), gather=not by_part)
        return r6(_return_windows(kept), "value")

    return run


register("return_windows", _return_windows_of(Lake.market_daily))
register("return_windows_by_part", _return_windows_of(Lake.part_daily, by_part=True))


@query
def volume_windows(lake: Lake) -> DataFrame:
    """Volume of every symbol in all five windows, which all symbols share, from kept summaries."""
    rolled = rollups.roll_up(lake.bars(), "symbol", "date", VOLUME_MEASURES)
    kept = rollups.write_rollups(rolled, new_path(lake.spark, "rollups"))
    asked = rollups.trailing_windows(kept, "symbol", panels.WINDOW_DAYS, returns=False, shared=True)
    return rollups.over_windows(kept, asked, "symbol", VOLUME_MEASURES).select("symbol", "days", "value", "bars")


@query
def refreshed_windows(lake: Lake) -> DataFrame:
    """The windows after the summaries took two weeks of bars that were missing at first."""
    rows, path = _return_rows(lake.market_daily()), new_path(lake.spark, "rollups")
    late = F.col("date").between("2001-06-05", "2001-06-20")
    rollups.write_rollups(rollups.roll_up(rows.filter(~late), "symbol", "date", BAR_MEASURES), path)
    kept = rollups.refresh_rollups(lake.spark, path, rows, rows.filter(late), "symbol", "date", BAR_MEASURES)
    return r6(_return_windows(kept), "value")


@query
def latest_per_series(lake: Lake) -> DataFrame:
    return shaping.latest(no_period(lake.indicators()), "series", "date")


@query
def readiness(lake: Lake) -> DataFrame:
    inputs = {
        "market_daily": (lake.market_daily(), "date", "daily_return"),
        "volatility": (lake.volatility(), "date", "rolling_volatility"),
        "levels": (lake.levels(), "snapshot_date", "level"),
    }
    return union([panels.readiness(df, dt, v).withColumn("input", F.lit(n)) for n, (df, dt, v) in inputs.items()])


@query
def as_of_dates(lake: Lake) -> DataFrame:
    inputs = {
        "bars": (lake.bars(), "date"),
        "indicators": (lake.indicators(), "date"),
        "attention": (lake.attention(), "date"),
        "levels": (lake.levels(), "snapshot_date"),
    }
    return union([panels.as_of(df, dt).withColumn("input", F.lit(n)) for n, (df, dt) in inputs.items()])


@query
def volatility_panel_90d(lake: Lake) -> DataFrame:
    tail = panels.known_tail(lake.volatility(), "date", "rolling_volatility", 90)
    return r6(no_period(tail), "rolling_volatility", "latest_value")


# --- findings -----------------------------------------------------------------------------------


def _curves(lake: Lake) -> DataFrame:
    return findings.cumulative(
        lake.spread().select("date", "basket_return", "benchmark_return"),
        "date",
        {"basket_return": "basket_cum", "benchmark_return": "benchmark_cum"},
    )


def _attention(lake: Lake) -> DataFrame:
    return findings.total_change(lake.attention(), "date", "views")


def _lags(lake: Lake) -> DataFrame:
    return findings.lag_corr(_attention(lake), lake.spread(), "date", "pct_change", "basket_return")


def _events(lake: Lake) -> DataFrame:
    daily = _attention(lake)
    spikes = findings.top_spikes(daily, "date", "pct_change")
    return findings.event_study(spikes, daily, lake.spread(), "date", "pct_change", "basket_return")


def _symbol_lags(lake: Lake) -> DataFrame:
    rows, bench = lake.market_daily(), lake.benchmark().select("date", "daily_return")
    return findings.lag_corr(rows, bench, "date", "daily_return", "daily_return", by="symbol")


def _rates(lake: Lake) -> DataFrame:
    series = lake.indicators().filter(F.col("series") == YIELD_SERIES)
    return findings.direction(series, "date", "value")


def _sensitivity(lake: Lake) -> DataFrame:
    return findings.conditional_return(lake.sector(), _rates(lake), "symbol", "date", "daily_return")


def _cohorts(lake: Lake) -> DataFrame:
    return findings.cohort(lake.basket(), "symbol", {"core": CORE, "infra": INFRA})


def _summary(lake: Lake) -> DataFrame:
    return findings.cohort_summary(_cohorts(lake), "symbol", "date", "daily_return")


@query
def cumulative_curves(lake: Lake) -> DataFrame:
    return r6(_curves(lake), "basket_return", "benchmark_return", "basket_cum", "benchmark_cum")


@query
def spread_totals(lake: Lake) -> DataFrame:
    totals = findings.spread_totals(lake.spread(), "date", "basket_return", "benchmark_return")
    return r6(totals, "left_total_pct", "right_total_pct", "spread_pts")


@query
def attention_change(lake: Lake) -> DataFrame:
    return r6(_attention(lake), "pct_change")


@query
def attention_spikes(lake: Lake) -> DataFrame:
    return r6(findings.top_spikes(_attention(lake), "date", "pct_change"), "pct_change")


@query
def lag_correlation(lake: Lake) -> DataFrame:
    return r6(_lags(lake), "correlation")


@query
def best_lag(lake: Lake) -> DataFrame:
    return r6(findings.best_lag(_lags(lake)), "best_corr", "threshold")


@query
def event_study(lake: Lake) -> DataFrame:
    return r6(_events(lake), "spike_size_pct", "return_before_pct", "return_after_pct")


@query
def lag_correlation_by_symbol(lake: Lake) -> DataFrame:
    """Every symbol's returns against the benchmark's, ten days either way."""
    return r6(_symbol_lags(lake), "correlation")


@query
def best_lag_by_symbol(lake: Lake) -> DataFrame:
    return r6(findings.best_lag(_symbol_lags(lake), "symbol"), "best_corr", "threshold")


@query
def event_study_by_symbol(lake: Lake) -> DataFrame:
    """The benchmark before and after the five best days of every symbol, on the symbol's own dates."""
    rows = lake.market_daily().select("symbol", "date", "daily_return")
    spikes = findings.top_spikes(rows, "date", "daily_return", by="symbol")
    study = findings.event_study(spikes, rows, lake.benchmark().select("date", "daily_return"), "date", "daily_return", "daily_return", by="symbol")
    return r6(study, "spike_size_pct", "return_before_pct", "return_after_pct")


@query
def event_summary(lake: Lake) -> DataFrame:
    return r6(findings.event_summary(_events(lake)), "return_before_pct", "return_after_pct", "gap_pts")


@query
def volume_share(lake: Lake) -> DataFrame:
    return r6(findings.volume_share(lake.basket(), "symbol", "volume", None), "share_pct")


_CONCENTRATION = (
    "hhi",
    "top_share_pct",
    "second_share_pct",
    "effective_n",
    "fair_share_pct",
    "rest_share_pct",
    "top_vs_fair",
    "top_vs_second",
)


@query
def concentration(lake: Lake) -> DataFrame:
    return r6(findings.concentration(lake.basket(), "symbol", "volume"), *_CONCENTRATION)


@query
def concentration_cohort(lake: Lake) -> DataFrame:
    """Concentration of each cohort, on shares rounded to one place."""
    groups = {"core": CORE, "infra": INFRA, "legacy": LEGACY}
    members = findings.cohort(lake.basket(), "symbol", groups)
    each = [
        findings.concentration(members.filter(F.col("cohort") == g), "symbol", "volume", 1).withColumn(
            "cohort", F.lit(g)
        )
        for g in groups
    ]
    return r6(union(each), *_CONCENTRATION)


@query
def rate_direction(lake: Lake) -> DataFrame:
    return _rates(lake)


@query
def rate_sensitivity(lake: Lake) -> DataFrame:
    return findings.sensitivity_board(_sensitivity(lake), "symbol")


@query
def rate_exceptions(lake: Lake) -> DataFrame:
    return findings.exceptions(_sensitivity(lake))


@query
def rate_exception_counts(lake: Lake) -> DataFrame:
    return findings.exception_counts(_sensitivity(lake))


@query
def volatility_extremes(lake: Lake) -> DataFrame:
    found = findings.extremes(lake.volatility(), "date", "rolling_volatility", "symbol")
    return r6(found, "first_value", "latest_value", "max_value", "min_value", "mean_value", "max_to_mean")


@query
def cohort_members(lake: Lake) -> DataFrame:
    labelled = findings.cohort(lake.basket(), "symbol", {"core": CORE, "infra": INFRA, "legacy": LEGACY})
    return labelled.groupBy("cohort", "symbol").agg(F.count(F.lit(1)).alias("bars"))


@query
def cohort_curve(lake: Lake) -> DataFrame:
    return r6(findings.cohort_curve(_cohorts(lake), "date", "daily_return"), "mean_return", "cumulative")


@query
def entity_total_return(lake: Lake) -> DataFrame:
    return r6(findings.total_return_by(lake.market_daily(), "symbol", "daily_return"), "total_return_pct")


@query
def cohort_summary(lake: Lake) -> DataFrame:
    return r6(_summary(lake), "final_return_pct", "annual_vol", "worst_return_pct", "median_return_pct")


@query
def cohort_gap(lake: Lake) -> DataFrame:
    return r6(findings.cohort_gap(_summary(lake), "infra", "core"), "left_final_pct", "right_final_pct", "gap_pts", "vol_ratio")


@query
def input_coverage(lake: Lake) -> DataFrame:
    return findings.coverage(
        {
            "market_daily": (lake.market_daily(), "date", "daily_return"),
            "attention": (lake.attention(), "date", "views"),
            "spread": (lake.spread(), "date", "basket_return"),
        }
    )


# --- snapshots ---------------------------------------------------------------------------------


@query
def metric_change(lake: Lake) -> DataFrame:
    return snapshots.metric_change(lake.monthly_volumes(), 1)


@query
def snapshot_last_two(lake: Lake) -> DataFrame:
    return snapshots.last_two(lake.monthly_volumes())


@query
def snapshot_history(lake: Lake) -> DataFrame:
    """The metric history appended in two runs, the second repeating part of the first."""
    target = new_path(lake.spark, "history")
    months = lake.monthly_volumes()
    snapshots.append_snapshot(lake.spark, target, months.filter(F.col("snapshot_date") < "1999-01-01"))
    rest = months.filter(F.col("snapshot_date") >= "1998-07-01")
    return no_period(snapshots.append_snapshot(lake.spark, target, rest))


@query
def metric_snapshot(lake: Lake) -> DataFrame:
    """The run's headline metrics of all findings as long rows."""
    metrics = headline_metrics(
        lake.market_daily(),
        lake.spread(),
        lake.attention(),
        lake.volatility(),
        lake.indicators().filter(F.col("series") == YIELD_SERIES),
        panels.as_of(lake.market_daily(), "date").scalar(),
        {"infra": INFRA, "core": CORE},
    )
    return r6(metrics, "value")


# --- landing and shaping ------------------------------------------------------------------------

_RECORDS = (
    "records array<struct<symbol string, category string, date string, open double, high double,"
    " low double, close double, volume bigint>>, fetched_at string"
)


@query
def explode_records(lake: Lake) -> DataFrame:
    """Bars nested into documents of one symbol and month (31 records at most), landed, read, exploded, typed."""
    path = new_path(lake.spark, "landing-bars")
    cols = ["symbol", "category", F.col("date").cast("string").alias("date"), "open", "high", "low", "close", "volume"]
    (
        lake.bars()
        .groupBy("symbol", F.trunc("date", "month").alias("month"))
        .agg(F.collect_list(F.struct(*cols)).alias("records"))
        .select("records", F.concat(F.col("month").cast("string"), F.lit("T12:00:00+00:00")).alias("fetched_at"))
        .write.json(path)
    )
    docs = landing.read_landing(lake.spark, path, _RECORDS, one_per_file=False)
    types = {"symbol": "string", "category": "string", "date": "date", "open": "double", "high": "double"}
    types |= {"low": "double", "close": "double", "volume": "long", "fetched_at": "timestamp"}
    typed = landing.type_cols(landing.explode_records(docs), types)
    return typed.withColumn("fetched_at", F.to_date("fetched_at")).withColumnRenamed("fetched_at", "fetched_on")


@query
def quarantined_documents(lake: Lake) -> DataFrame:
    """Landed documents of which every fifth month's are cut off: the others' bars, and how many were broken."""
    path, target = new_path(lake.spark, "landing-broken"), new_path(lake.spark, "bronze")
    cols = ["symbol", "category", F.col("date").cast("string").alias("date"), "open", "high", "low", "close", "volume"]
    text = F.to_json(F.struct("records", F.lit("2024-01-01T12:00:00+00:00").alias("fetched_at")))
    (
        lake.bars()
        .groupBy("symbol", F.trunc("date", "month").alias("month"))
        .agg(F.collect_list(F.struct(*cols)).alias("records"))
        .select(F.when(F.month("month") == 5, F.substring(text, 1, 60)).otherwise(text).alias("value"))
        .write.text(path)
    )
    good = landing.land_documents(lake.spark, path, _RECORDS, target, one_per_file=False)
    bars = landing.explode_records(good).select("symbol", F.to_date("date").alias("date"), "close", F.lit("landed").alias("status"))
    broken = landing.broken_documents(lake.spark, target).groupBy("file").agg(F.count(F.lit(1)).alias("n"))
    broken = broken.agg(F.sum("n").cast("double").alias("close")).select(
        F.lit(None).cast("string").alias("symbol"), F.lit(None).cast("date").alias("date"), "close", F.lit("broken").alias("status")
    )
    return bars.unionByName(broken)


@query
def melt_series(lake: Lake) -> DataFrame:
    """Indicators as one document of named structs per date, landed and melted back."""
    path = new_path(lake.spark, "landing-series")
    names = [YIELD_SERIES, *MONTHLY_SERIES]
    cell = F.struct(F.col("date").cast("string").alias("date"), "value")
    (
        lake.indicators()
        .groupBy(F.col("date").alias("run"))
        .agg(*[F.max(F.when(F.col("series") == n, cell)).alias(n) for n in names])
        .select(*[F.col(f"`{n}`") for n in names], F.col("run").cast("string").alias("fetched_at"))
        .write.json(path)
    )
    docs = landing.read_landing_text(lake.spark, path, one_per_file=False)
    melted = landing.melt_structs(docs, "date string, value double", "series")
    typed = {"series": "string", "date": "date", "value": "double", "fetched_at": "date"}
    return landing.type_cols(melted, typed).withColumnRenamed("fetched_at", "snapshot_date")


@query
def parse_json_props(lake: Lake) -> DataFrame:
    parsed = F.from_json("props", "k bigint")
    return lake.raw("events").select("event_id", "event_type", parsed["k"].alias("k"))


@query
def settled_bars(lake: Lake) -> DataFrame:
    """Bars without the ones a price is missing from."""
    gap = F.col("volume") % 7
    holes = lake.bars().select(
        "symbol",
        "date",
        F.when(gap != 0, F.col("open")).alias("open"),
        "high",
        F.when(gap != 1, F.col("low")).alias("low"),
        F.when(gap != 2, F.col("close")).alias("close"),
        "volume",
    )
    return shaping.settled(holes)


@query
def last_n_bars(lake: Lake) -> DataFrame:
    return shaping.last_n(lake.bars().select("symbol", "date", "close", "volume"), "symbol", "date", 3)


@query
def classify(lake: Lake) -> DataFrame:
    """Parts classified by a dimension frame; parts without a line item get the default."""
    flagged = (
        lake.raw("lineitem")
        .groupBy(F.col("l_partkey").alias("p_partkey"))
        .agg(F.when(F.sum("l_quantity") > 700, "busy").otherwise("quiet").alias("category"))
    )
    return shaping.classify(lake.raw("part").select("p_partkey", "p_brand"), "p_partkey", flagged, "idle")


@query
def missing_entities(lake: Lake) -> DataFrame:
    """Customers without an order in 1998."""
    year = F.year("o_orderdate") == 1998
    placed = lake.raw("orders").filter(year).select(F.col("o_custkey").alias("c_custkey"))
    return shaping.missing_entities(lake.raw("customer"), placed, "c_custkey")


@query
def missing_marker(lake: Lake) -> DataFrame:
    """Prices as feed text with `.` for unsettled orders, read back as numbers."""
    text = F.when(F.col("o_orderstatus") == "P", ".").otherwise(F.col("o_totalprice").cast("string"))
    return lake.raw("orders").select("o_orderkey", C.null_marker(text).alias("value"))


@query
def compact_dates(lake: Lake) -> DataFrame:
    stamp = F.date_format("o_orderdate", "yyyyMMdd00")
    return lake.raw("orders").select("o_orderkey", C.compact_date(stamp).alias("date"))


@query
def rounded_bars(lake: Lake) -> DataFrame:
    slim = lake.bars().select("symbol", "date", "open", "high", "low", "close", "volume")
    return C.round_cols(slim, ["open", "high", "low", "close"], 2)


@query
def tidy_labels(lake: Lake) -> DataFrame:
    path = F.concat("p_brand", F.lit("/"), F.translate("p_name", " ", "_"))
    return lake.raw("part").select("p_partkey", C.spaced_label(C.short_label(path)).alias("label"))


# --- tables: upsert, profile, export --------------------------------------------------------------


def _slices(lake: Lake) -> tuple[DataFrame, DataFrame]:
    bars = no_period(lake.bars())
    first = bars.filter(F.col("date") < "1999-01-01").withColumn("fetched_at", F.lit(1))
    second = bars.filter(F.col("date") >= "1998-06-01").withColumns(
        {"close": F.col("close") + 1, "fetched_at": F.lit(2)}
    )
    return first, second


@query
def upsert_overlap(lake: Lake) -> DataFrame:
    """Two overlapping slices merged, the second one twice and with every row doubled."""
    target = new_path(lake.spark, "upsert")
    first, second = _slices(lake)
    keys = ["symbol", "date"]
    upsert(lake.spark, target, first, keys, "date", "fetched_at", "year")
    stale = second.withColumns({"close": F.lit(0.0), "fetched_at": F.lit(0)})
    upsert(lake.spark, target, second.unionByName(stale), keys, "date", "fetched_at", "year")
    return no_period(upsert(lake.spark, target, second, keys, "date", "fetched_at", "year"))


@query
def table_profile(lake: Lake) -> DataFrame:
    return row_counts(
        {
            "bars": lake.bars(),
            "indicators": lake.indicators(),
            "attention": lake.attention(),
            "levels": lake.levels(),
            "market_daily": lake.market_daily(),
            "spread": lake.spread(),
        }
    )


@query
def table_rebuild(lake: Lake) -> DataFrame:
    """A gold table rebuilt over an older one of another layout."""
    path = new_path(lake.spark, "rebuild")
    write_table(lake.indicators().select("series", "date"), path, "date", grain="month")
    trends = returns.trend(no_period(lake.indicators()), "series", "date", "value")
    return no_period(write_table(trends, path, "date", cluster=("series",)))


@query
def export_clean(lake: Lake) -> DataFrame:
    """Returns with NaN and infinities in them, published in order and read back."""
    path = new_path(lake.spark, "published")
    spoilt = (
        F.when(F.col("volume") % 5 == 0, F.lit(float("nan")))
        .when(F.col("volume") % 5 == 1, F.lit(float("-inf")))
        .otherwise(F.col("daily_return"))
    )
    rows = lake.market_daily().select("symbol", "date", "volume", spoilt.alias("daily_return"))
    export_json(rows, ["symbol", "date"], path)
    schema = "symbol string, date date, volume bigint, daily_return double"
    return landing.read_published(lake.spark, path, schema, array_file=False)


@query
def export_array(lake: Lake) -> DataFrame:
    """The same rows published as one JSON array in parts, and read back from them."""
    path = new_path(lake.spark, "published")
    export_json_array(lake.market_daily().select("symbol", "date", "volume", "daily_return"), ["symbol", "date"], path)
    return landing.read_array_parts(lake.spark, path, "symbol string, date date, volume bigint, daily_return double")


@query
def snapshot_overwrite(lake: Lake) -> DataFrame:
    """A snapshot replaced by a later one with another schema."""
    path = new_path(lake.spark, "snapshot")
    write_snapshot(lake.raw("nation"), path)
    write_snapshot(lake.raw("supplier").select("s_suppkey", "s_acctbal"), path)
    return read_table(lake.spark, path)


# --- freshness and run log ------------------------------------------------------------------------

SPECS = [
    freshness.TableSpec("market_daily", "bars", "lineitem", "date", "trading_day", "Market snapshot"),
    freshness.TableSpec("volatility", "bars", "lineitem", "date", "trading_day", "Volatility"),
    freshness.TableSpec("spread", "bars", "lineitem", "date", "trading_day", "Basket and benchmark"),
    freshness.TableSpec("indicators", "indicators", "orders", "date", "mixed", "Indicators"),
    freshness.TableSpec("attention", "attention", "orders", "date", "daily_lagged", "Attention"),
    freshness.TableSpec("levels", "levels", "events", "snapshot_date", "daily", "Growth"),
]


def _tables(lake: Lake) -> dict[str, DataFrame]:
    return {
        "market_daily": lake.market_daily(),
        "volatility": lake.volatility(),
        "spread": lake.spread(),
        "indicators": lake.indicators(),
        "attention": lake.attention(),
        "levels": lake.levels(),
    }


def _table_freshness(lake: Lake) -> DataFrame:
    return freshness.table_freshness(_tables(lake), SPECS, moment(MARKET_AS_OF))


def _series_freshness(lake: Lake) -> DataFrame:
    return freshness.series_freshness(lake.indicators(), "series", "date", MONTHLY_SERIES, moment(MARKET_AS_OF))


def _run_state(lake: Lake) -> DataFrame:
    return freshness.run_state(lake.run_log(), moment(EVENTS_AS_OF), "ts", tie="event_id")


def _incidents(lake: Lake) -> DataFrame:
    return freshness.open_incidents(lake.incidents(), "opened", "title", tie="event_id")


def _stale(lake: Lake) -> DataFrame:
    return freshness.stale_sources(_table_freshness(lake), _series_freshness(lake), "series")


@query
def last_run_per_day(lake: Lake) -> DataFrame:
    return freshness.last_run_per_day(
        lake.run_log(), moment(EVENTS_AS_OF), "ts", ["time_utc", "event", "status", "conclusion"], "event_id"
    )


@query
def run_state(lake: Lake) -> DataFrame:
    return _run_state(lake)


@query
def open_incidents(lake: Lake) -> DataFrame:
    return _incidents(lake).withColumn("latest_opened", F.to_date("latest_opened"))


@query
def expected_dates(lake: Lake) -> DataFrame:
    """The trading day due at the moment of every event."""
    return lake.raw("events").select("event_id", freshness.expected_date(F.col("ts")).alias("expected"))


# Days in the sample's month on which no market is open.
HOLIDAYS = ("2023-12-25", "2024-01-01", "2024-01-15")


@query
def holiday_status(lake: Lake) -> DataFrame:
    """Expected day, missing business days and status at the moment of every event, over weeks with holidays.

    The data's latest date lies up to five days before the event.
    """
    closed = lake.spark.range(1).select(F.explode(F.array(*[F.to_date(F.lit(d)) for d in HOLIDAYS])).alias("day"))
    calendar = business_days.business_calendar(lake.spark, "2023-12-01", "2024-12-31", closed)
    rows = lake.raw("events").select("event_id", "ts", F.date_sub(F.to_date("ts"), (F.col("event_id") % 6).cast("int")).alias("latest"))
    due = business_days.with_expected(rows, "ts", calendar)
    missing = business_days.with_business_gap(due, "latest", "expected", calendar, "missing")
    return missing.select("event_id", "latest", "expected", "missing", business_days.business_status(F.col("missing")).alias("status"))


@query
def table_freshness(lake: Lake) -> DataFrame:
    return _table_freshness(lake)


@query
def table_freshness_from_footers(lake: Lake) -> DataFrame:
    """The same from the statistics in the tables' files."""
    paths = {name: lake.path(name) for name in _tables(lake)}
    return freshness.freshness_from_footers(lake.spark, paths, SPECS, moment(MARKET_AS_OF))


@query
def table_lineage(lake: Lake) -> DataFrame:
    return freshness.lineage(_table_freshness(lake), freshness.registry(lake.spark, SPECS))


@query
def series_freshness(lake: Lake) -> DataFrame:
    return _series_freshness(lake)


@query
def stale_sources(lake: Lake) -> DataFrame:
    return _stale(lake)


@query
def stale_verdict(lake: Lake) -> DataFrame:
    return freshness.verdict(_run_state(lake), _incidents(lake), _stale(lake))


@query
def latest_digest(lake: Lake) -> DataFrame:
    sources = {
        "market": (lake.benchmark(), "symbol", "date", "close"),
        "spread": (lake.spread(), None, "date", "spread"),
        "volatility": (
            lake.volatility().filter(F.col("rolling_volatility").isNotNull()),
            "symbol",
            "date",
            "rolling_volatility",
        ),
        "indicators": (lake.indicators(), "series", "date", "value"),
        "attention": (lake.attention(), "topic", "date", "views"),
        "counts": (lake.trailing_counts(), "category", "snapshot_date", "count"),
        "levels": (freshness.at_latest_date(lake.levels(), "snapshot_date"), "entity", "snapshot_date", "level"),
    }
    return r6(freshness.digest(sources), "value")


# --- streaming ------------------------------------------------------------------------------------


@query
def stream_upsert(lake: Lake) -> DataFrame:
    """The bars table's files as a stream of landings, merged batch by batch."""
    bars = no_period(lake.bars())
    feed = new_path(lake.spark, "feed")
    bars.write.parquet(feed)
    stream = lake.spark.readStream.schema(bars.schema).option("maxFilesPerTrigger", 8).parquet(feed)
    target, checkpoint = new_path(lake.spark, "stream-upsert"), new_path(lake.spark, "offsets")
    return no_period(
        jobs.stream_upsert(lake.spark, stream, target, ["symbol", "date"], "date", checkpoint, grain="year")
    )


@query
def stream_sliding_count(lake: Lake) -> DataFrame:
    events = lake.raw("events").select("event_id", "ts", "event_type")
    stream = (
        lake.spark.readStream.schema(events.schema)
        .option("pathGlobFilter", "events.parquet")
        .parquet(lake.sf_dir)
    )
    target, checkpoint = new_path(lake.spark, "sliding"), new_path(lake.spark, "offsets")
    return no_period(jobs.sliding_counts_table(lake.spark, stream, "ts", "event_type", "event_id", target, checkpoint))


@query
def stream_sliding_count_kept(lake: Lake) -> DataFrame:
    """The events land in three goes, each spread over the whole month: most of the later ones are past the watermark."""
    events = lake.raw("events").select("event_id", "ts", "event_type")
    feed, target, checkpoint = (new_path(lake.spark, name) for name in ("feed", "kept", "offsets"))
    for go in range(3):
        events.filter(F.pmod(F.xxhash64("event_id"), F.lit(3)) == go).write.mode("append").parquet(feed)
        stream = lake.spark.readStream.schema(events.schema).parquet(feed)
        counts = state.sliding_counts_kept(lake.spark, stream, "ts", "event_type", target, checkpoint)
    return no_period(counts)


@query
def late_recovery(lake: Lake) -> DataFrame:
    """Bars of a few weeks arrive late; the touched returns are brought up to date."""
    bars_at, gold_at = new_path(lake.spark, "late-bars"), new_path(lake.spark, "late-gold")
    bars = lake.bars().drop(PERIOD).withColumn("fetched_at", F.lit(1))
    late = F.col("date").between("2001-06-05", "2001-06-20")
    keys = ["symbol", "date"]
    on_time = upsert(lake.spark, bars_at, bars.filter(~late), keys, "date", "fetched_at", "year")
    upsert(lake.spark, gold_at, returns.market_daily(on_time, prev_dt="prev_date"), keys, "date", None, "year")
    return no_period(jobs.recover_late(lake.spark, bars_at, gold_at, bars.filter(late), grain="year", prev_dt="prev_date"))


@query
def upsert_partial_columns(lake: Lake) -> DataFrame:
    """Two merges that update only the closes of some months, and leave all other columns as they are."""
    target = new_path(lake.spark, "partial")
    bars, keys = lake.bars().drop(PERIOD), ["symbol", "date"]
    upsert(lake.spark, target, bars, keys, "date", grain="year")
    for month in (3, 6):
        doubled = bars.filter(F.month("date") == month).select(*keys, (F.col("close") * 2).alias("close"))
        upsert(lake.spark, target, doubled, keys, "date", grain="year", columns=["close"])
    return no_period(read_table(lake.spark, target))


@query
def upsert_catalog_table(lake: Lake) -> DataFrame:
    """The same merges, whole rows, into a table of the catalog."""
    target = f"bars_{uuid.uuid4().hex}"
    bars, keys = lake.bars().drop(PERIOD), ["symbol", "date"]
    upsert(lake.spark, target, bars.filter(F.month("date") != 6), keys, "date", grain="year")
    for month in (3, 6):
        doubled = bars.filter(F.month("date") == month).withColumn("close", F.col("close") * 2)
        upsert(lake.spark, target, doubled, keys, "date", grain="year")
    return no_period(read_table(lake.spark, target))


@query
def incremental_gold(lake: Lake) -> DataFrame:
    """Late bars, values and events brought through all derived tables, which then equal a full rebuild."""
    gold = incremental.Gold(new_path(lake.spark, "gold"), {"core": CORE, "infra": INFRA}, "year")
    bars = lake.bars().drop(PERIOD)
    values = lake.attention().select(F.col("topic").alias("entity"), "date", F.col("views").alias("value"))
    events = lake.raw("events").select("event_id", F.col("event_type").alias("category"), "ts")
    late_bars = F.col("date").between("2001-06-05", "2001-06-20") | ((F.col("symbol") == "Brand#14") & (F.year("date") == 1999))
    # all of one entity's first year, and a few days of another
    late_values = ((F.col("entity") == "F") & (F.year("date") == 1995)) | ((F.col("entity") == "O") & F.col("date").between("1999-02-01", "1999-02-20"))
    late_events = F.to_date("ts").between("2024-01-09", "2024-01-12")
    incremental.build(gold, bars.filter(~late_bars), values.filter(~late_values), events.filter(~late_events))
    incremental.land_bars(gold, bars.filter(late_bars))
    incremental.land_values(gold, values.filter(late_values))
    incremental.land_events(gold, events.filter(late_events))

    def rows(name: str, key: str, dt: str, value: str) -> DataFrame:
        return gold.table(lake.spark, name).select(
            F.lit(name).alias("table"), F.expr(key).alias("key"), F.col(dt).alias("date"), F.col(value).cast("double").alias("value")
        )

    return r6(
        union(
            [
                rows("market_daily", "symbol", "date", "daily_return"),
                rows("volatility", "symbol", "date", "rolling_volatility"),
                rows("spread", "'spread'", "date", "spread"),
                rows("curves", "cohort", "date", "cumulative").filter("value is not null"),
                rows("indexed", "entity", "date", "index"),
                rows("counts", "category", "snapshot_date", "count"),
            ]
        ),
        "value",
    )
