"""Shapes of physical plans that have to hold at any size."""

import re

import pytest
from pyspark.sql import functions as F

from seriesframe.operators import panels, returns, shaping
from seriesframe.plans.lake import Lake
from seriesframe.plans.queries import QUERIES

def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


@pytest.fixture(scope="module")
def lake(spark, sf_dir):
    return Lake(spark, sf_dir)


def test_rows_are_shuffled_once_and_not_by_entity_alone(lake):
    plan = _plan(returns.market_daily(lake.bars()))
    assert not re.search(r"hashpartitioning\(symbol#\d+, \d+\), ENSURE_REQUIREMENTS.*\n.*Union", plan)
    union = plan.index("Union")
    assert "_chunk" in plan[:union] and plan[:union].count("Exchange") == 1
    assert "SinglePartition" not in plan


def test_columns_are_pruned_to_the_scan(lake):
    plan = _plan(returns.category_returns(lake.bars(), "sector"))
    assert "open" not in plan and "EqualTo(category,sector)" in plan


def test_trailing_window_prunes_partitions(lake):
    plan = _plan(panels.window_sum(lake.bars(), "symbol", "date", "volume", 30))
    assert re.search(r"PartitionFilters: \[isnotnull\(period#\d+\), \(period#\d+ >= trunc", plan)


def test_last_n_is_limited_before_the_shuffle(lake):
    plan = _plan(shaping.last_n(lake.bars(), "symbol", "date", 3))
    assert plan.count("WindowGroupLimit") == 2


def test_top_n_takes_without_a_sort(lake):
    plan = _plan(panels.top_n_other(panels.window_sum(lake.bars(), "symbol", "date", "volume", None), "symbol", "value", 6))
    assert "TakeOrderedAndProject" in plan and "BroadcastHashJoin" in plan and "LeftAnti" in plan


def test_no_window_over_all_raw_rows(lake):
    """A position over the whole frame is counted per chunk, never by one task."""
    from seriesframe.functions.ordered import with_position

    plan = _plan(with_position(lake.bars().select("date"), None, "date", "pos"))
    single = plan[plan.index("SinglePartition") :]
    assert single.index("HashAggregate") < single.index("FileScan")


def test_skewed_entity_is_split(spark):
    hot = spark.range(3000).select(F.lit("hot").alias("symbol"), F.date_add(F.lit("1990-01-01").cast("date"), F.col("id").cast("int")).alias("date"), F.col("id").cast("double").alias("close"))
    cold = spark.range(6000).select(F.col("id").cast("string").alias("symbol"), F.lit("2000-01-01").cast("date").alias("date"), F.lit(1.0).alias("close"))
    from seriesframe.functions.ordered import CHUNK, chunk_of

    df = hot.unionByName(cold)
    biggest = df.withColumn(CHUNK, chunk_of(df, "date")).groupBy("symbol", CHUNK).count().agg(F.max("count")).collect()[0][0]
    assert biggest == 366
    got = returns.returns(df, "symbol", "date", "close")
    assert got.filter("symbol = 'hot'").agg(F.sum("change")).collect()[0][0] == 2999.0


WINDOWED = [
    "compound_return_1",
    "compound_return_7",
    "compound_return_30",
    "compound_return_90",
    "compound_return_90_by_part",
    "trailing_rows_7d",
    "spread_return_30d",
    "ohlc_window_30d",
    "sector_board",
    "level_delta_1",
    "level_delta_7",
    "growth_board",
    "indicator_board",
    "window_volume_30d",
    "volume_share_30d",
    "rebased_index_90d",
    "aligned_series",
    "volatility_panel_90d",
]


@pytest.mark.parametrize("name", [n for n in WINDOWED if n != "volume_share_30d"])
def test_every_windowed_query_prunes_partitions(spark, sf_dir, name):
    plan = _plan(QUERIES[name](spark, sf_dir))
    assert re.search(r"PartitionFilters: \[[^]]*period#\d+ >= trunc", plan)


def _scans(df):
    """Scans that were run, those of a reused subquery or exchange once."""
    df.collect()
    return len(re.findall(r"FileScan parquet", _plan(df)))


MOST_SCANS = {"window_volume_30d": 4, "volume_share_30d": 3, "best_lag": 2, "event_study": 6, "metric_snapshot": 24}


@pytest.mark.parametrize("name", MOST_SCANS)
def test_tables_are_not_read_again_and_again(spark, sf_dir, name):
    assert _scans(QUERIES[name](spark, sf_dir)) <= MOST_SCANS[name]


def _part_rows(spark):
    items = [(5, 2, 1, 9, 7.0), (5, 1, 1, 9, 3.0), (4, 7, 1, 9, 5.0), (5, 1, 2, 8, 6.0), (5, 1, 2, 8, None), (6, 1, 3, 8, 1.0), (6, 1, None, 8, 1.0)]
    rows = [(o, n, p, s, None if x is None else 1e4 * x, 2.0, day) for o, n, p, s, x in items for day in ("1999-01-01", "2001-01-02")]
    lineitem = spark.createDataFrame(rows, "l_orderkey long, l_linenumber long, l_partkey long, l_suppkey long, l_extendedprice double, l_quantity double, day string")
    parts = spark.createDataFrame([(1,), (1,), (2,), (4,), (None,)], "l_partkey long")
    return lineitem.withColumn("l_shipdate", F.to_date("day")), parts.withColumn("symbol", F.col("l_partkey").cast("string"))


def test_bars_by_part_are_those_by_symbol(spark):
    from seriesframe.plans.lake import bars_of

    lineitem, parts = _part_rows(spark)
    want = sorted(map(repr, bars_of(lineitem, parts).collect()))
    assert sorted(map(repr, bars_of(lineitem, parts, by_part=True).collect())) == want
    first = bars_of(lineitem, parts, by_part=True).filter("symbol = '1'").orderBy("date").first()
    assert (first.open, first.high, first.low, first.close, first.volume) == (105.0, 107.0, 103.0, 107.0, 12)
    other = bars_of(lineitem, parts, by_part=True).filter("symbol = '2'").first()
    assert (other.open, other.close, other.high) == (None, 106.0, 106.0)


def test_bars_by_part_are_not_shuffled_after_the_join(spark):
    from seriesframe.plans.lake import bars_of

    lineitem, parts = _part_rows(spark)
    plan = bars_of(lineitem.hint("merge"), parts, by_part=True)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and "SortMergeJoin" in plan
