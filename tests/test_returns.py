from datetime import date

import pytest
from pyspark.sql import functions as F

from seriesframe.operators.indexing import align, align_long, index_to_first, rebase
from seriesframe.operators.returns import basket_vs_benchmark, category_returns, returns, rolling_vol, trend


def _by_date(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.orderBy("symbol", "date").collect()]


def test_first_row_gap_and_zero_base(series):
    df = series({"a": [("2024-01-05", 10.0), ("2024-01-08", 11.0), ("2024-01-09", 0.0), ("2024-01-10", 5.0)], "b": [("2024-01-05", 1.0)]})
    assert _by_date(returns(df, "symbol", "date", "value"), "change", "daily_return") == [
        (None, None),
        (1.0, 0.1),
        (-11.0, -1.0),
        (5.0, None),
        (None, None),
    ]


def test_category_filter_comes_before_the_window(spark):
    rows = [("a", "x", "2024-01-01", 1.0), ("a", "sector", "2024-01-02", 2.0), ("a", "sector", "2024-01-03", 3.0)]
    bars = spark.createDataFrame([(s, c, date.fromisoformat(d), v, 1) for s, c, d, v in rows], "symbol string, category string, date date, close double, volume long")
    assert _by_date(category_returns(bars, "sector"), "daily_return") == [(None,), (0.5,)]


@pytest.mark.parametrize("n,known", [(20, 0), (21, 1), (30, 10)])
def test_volatility_waits_for_twenty_returns(series, days, n, known):
    prices = [100.0 + (i * 7) % 5 for i in range(n)]
    rets = returns(series({"a": list(zip(days("2024-01-01", n), prices))}), "symbol", "date", "value")
    vol = [v for (v,) in _by_date(rolling_vol(rets, "symbol", "date"), "rolling_volatility")]
    assert [v is not None for v in vol] == [False] * (n - known) + [True] * known


def test_null_return_in_a_full_frame(series, days):
    values = [0.01 * ((i * 3) % 7) for i in range(41)]
    values[0] = values[30] = None
    df = series({"a": list(zip(days("2024-01-01", 41), values))}, "daily_return")
    vol = [v for (v,) in _by_date(rolling_vol(df, "symbol", "date"), "rolling_volatility")]
    import statistics

    assert vol[19] is None and vol[20] is not None
    assert vol[35] == pytest.approx(statistics.stdev([v for v in values[16:36] if v is not None]))


def test_trend_labels(series, days):
    values = [1.0, 2.0, 1.5, 1.5, None, 3.0]
    got = _by_date(trend(series({"a": list(zip(days("2024-01-01", 6), values))}), "symbol", "date", "value"), "change", "trend")
    assert got == [(None, "n/a"), (1.0, "up"), (-0.5, "down"), (0.0, "flat"), (None, "flat"), (None, "n/a")]


def test_spread_keeps_one_sided_dates(spark):
    rows = [
        ("a", "basket", "2024-01-02", 0.01),
        ("b", "basket", "2024-01-02", 0.03),
        ("c", "basket", "2024-01-02", None),
        ("a", "basket", "2024-01-03", 0.01),
        ("i", "benchmark", "2024-01-02", 0.01),
        ("i", "benchmark", "2024-01-04", 0.02),
    ]
    df = spark.createDataFrame([(s, c, date.fromisoformat(d), r) for s, c, d, r in rows], "symbol string, category string, date date, daily_return double")
    got = {r.date.day: (r.basket_return, r.benchmark_return, r.spread) for r in basket_vs_benchmark(df).collect()}
    assert got[2] == (pytest.approx(0.02), 0.01, pytest.approx(0.01))
    assert got[3] == (0.01, None, None)
    assert got[4] == (None, 0.02, None)


def test_index_to_first(series):
    df = series({"a": [("2023-12-31", 50.0), ("2024-01-01", 75.0)], "z": [("2024-01-01", 0.0), ("2024-01-02", 5.0)]})
    assert _by_date(index_to_first(df, "symbol", "date", "value"), "index") == [(100.0,), (150.0,), (None,), (None,)]


def test_rebase_uses_one_window_for_all(series):
    df = series({"a": [("2024-01-01", 10.0), ("2024-01-09", 20.0), ("2024-01-10", 30.0)], "old": [("2024-01-02", 1.0)]})
    assert _by_date(rebase(df, "symbol", "date", "value", 7), "symbol", "index") == [("a", 100.0), ("a", 150.0)]


def test_aligned_gaps_are_null(series):
    df = series({"a": [("2024-01-01", 1.0), ("2024-01-02", 2.0)], "b": [("2024-01-02", 3.0)]})
    wide = align(df, "symbol", "date", "value", ["a", "b"]).orderBy("date").collect()
    assert [(r.a, r.b) for r in wide] == [(1.0, None), (2.0, 3.0)]
    assert align_long(df, "symbol", "date", "value", ["a", "b"]).filter(F.col("value").isNull()).count() == 1
