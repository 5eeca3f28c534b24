from datetime import date

import pytest
from pyspark.sql import functions as F

from seriesframe.operators import panels
from seriesframe.operators.shaping import latest

D = date.fromisoformat


def _rets(series, points):
    return series(points, "r")


def _one(df):
    return df.collect()[0]


def test_trailing_cut_is_by_calendar_day(series):
    df = series({"a": [("2024-01-01", 1.0), ("2024-01-05", 1.0), ("2024-01-08", 1.0)], "b": [("2024-01-03", 1.0), ("2024-01-01", 1.0)]})
    assert panels.trail(df, "date", 3).count() == 2
    own = panels.trail(df, "date", 3, "symbol").groupBy("symbol").count().collect()
    assert {r.symbol: r["count"] for r in own} == {"a": 2, "b": 2}
    assert panels.trail(df, "date", None).count() == 5


def test_trailing_cut_across_years_and_null_entities(spark):
    rows = [(None, D("2023-12-30"), 1), (None, D("2024-01-02"), 2), ("a", D("2023-12-01"), 3)]
    df = spark.createDataFrame(rows, "e string, date date, v int")
    assert sorted(r.v for r in panels.trail(df, "date", 3, "e").collect()) == [1, 2, 3]
    assert sorted(r.v for r in panels.trail(df, "date", 2, "e").collect()) == [2, 3]


def test_span():
    assert [panels.span_days(d) for d in (1, 7, None, 0)] == [0, 6, None, 0]


def test_one_day_return_uses_the_latest_row_only(series):
    df = _rets(series, {"a": [("2024-01-01", None), ("2024-01-02", 0.5), ("2024-01-03", 0.1)]})
    r = _one(panels.compound_return(df, "date", "r", 1, "symbol"))
    assert (r.value, r.start_date, r.end_date) == (pytest.approx(0.1), D("2024-01-02"), D("2024-01-03"))
    d = _one(panels.level_delta(df, "symbol", "date", "r", 1))
    assert (d.value, d.start_date) == (pytest.approx(-0.4), D("2024-01-02"))


def test_an_n_day_window_compounds_n_returns(series, days):
    df = _rets(series, {"a": [(d, 1.0) for d in days("2024-01-01", 20)]})
    assert _one(panels.compound_return(df, "date", "r", 7, "symbol")).value == 2.0**7 - 1


def test_a_null_latest_row_anchors_returns_but_not_levels(series):
    df = _rets(series, {"a": [("2024-01-01", 1.0), ("2024-01-02", 2.0), ("2024-01-09", None)]})
    r = _one(panels.compound_return(df, "date", "r", 7, "symbol"))
    assert (r.value, r.start_date, r.end_date) == (None, None, None)
    assert _one(panels.level_delta(df, "symbol", "date", "r", 7)).value == 1.0


def test_start_date_is_the_row_before_the_first_used(series):
    df = _rets(series, {"a": [("2024-01-01", 0.5), ("2024-01-02", None), ("2024-01-03", 0.5)]})
    assert _one(panels.compound_return(df, "date", "r", None, "symbol")).start_date == D("2024-01-01")
    r = _one(panels.compound_return(df.filter("date > '2024-01-01'"), "date", "r", None, "symbol"))
    assert r.start_date == D("2024-01-02")


def test_one_series_without_entity(series):
    df = _rets(series, {"a": [("2024-01-01", 0.5), ("2024-01-02", 1.0)]})
    assert _one(panels.compound_return(df, "date", "r", None)).value == 2.0


def test_single_reading_gives_no_delta(series):
    df = series({"a": [("2024-01-01", 5.0)], "b": [("2024-01-01", 5.0), ("2024-01-02", 9.0)]})
    got = {r.symbol: r.value for r in panels.level_delta(df, "symbol", "date", "value", None).collect()}
    assert got == {"a": None, "b": 4.0}
    assert [r.symbol for r in panels.growth_board(df, "symbol", "date", "value", None).collect()] == ["b"]


def test_anchor_is_per_entity_for_deltas_and_shared_for_sums(series):
    df = series({"a": [("2024-01-01", 1.0), ("2024-01-02", 3.0)], "b": [("2024-01-30", 5.0), ("2024-01-31", 6.0)]})
    assert {r.symbol: r.value for r in panels.level_delta(df, "symbol", "date", "value", 7).collect()} == {"a": 2.0, "b": 1.0}
    sums = panels.window_sum(df, "symbol", "date", "value", 7).collect()
    assert [(r.symbol, r.value, r.start_date) for r in sums] == [("b", 11.0, D("2024-01-30"))]


def test_level_growth_vector(series):
    stars = {"tool": [("2026-08-15", 100.0), ("2026-08-21", 672.0), ("2026-08-22", 745.0)]}
    df = series(stars)
    assert _one(panels.level_delta(df, "symbol", "date", "value", 7)).value == 645.0
    assert _one(panels.level_delta(df, "symbol", "date", "value", 1)).value == 73.0


@pytest.mark.parametrize("n,expect", [(2, [("c", 5, 1), ("b", 4, 2), ("Other", 4, 3)]), (4, [("c", 5, 1), ("b", 4, 2), ("a", 3, 3), ("d", 1, 4)])])
def test_top_n_and_rest(spark, n, expect):
    sums = spark.createDataFrame([("a", 3), ("b", 4), ("c", 5), ("d", 1)], "k string, v long")
    got = panels.top_n_other(sums, "k", "v", n).orderBy("slot").collect()
    assert [(r.k, r.v, r.slot) for r in got] == expect


def test_shares_add_up_and_a_zero_total_gives_zero(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 3.0)], "k string, v double")
    assert sorted(r.share_pct for r in panels.share(df, "v").collect()) == [25.0, 75.0]
    assert [r.share_pct for r in panels.share(df.withColumn("v", F.lit(0.0)), "v").collect()] == [0.0, 0.0]


def test_indicator_board(series):
    df = series({"cpi": [("2024-01-01", 3.0)], "y": [("2024-01-01", 4.0), ("2024-01-02", 4.5)]}, ent="series")
    got = {r.series: r for r in panels.indicator_board(df, "series", "date", "value", 30, ["cpi"]).collect()}
    assert (got["cpi"].value, got["cpi"].change, got["cpi"].enough_history, got["cpi"].rate_series) == (3.0, None, False, False)
    assert (got["y"].value, got["y"].change, got["y"].rate_series) == (4.5, 0.5, True)


def test_readiness(series):
    r = _one(panels.readiness(series({"a": [("2024-01-01", None)]}), "date", "value"))
    assert (r.collected, r.needed, r.usable, r.ready, r.latest_only) == (1, 20, 0, False, True)


def test_known_tail_shows_the_latest_row_even_if_null(series):
    df = series({"a": [("2024-01-01", 1.0), ("2024-01-02", 2.0), ("2024-01-03", None)]})
    got = panels.known_tail(df, "date", "value", 0).collect()
    assert [(r.date, r.value, r.latest_date, r.latest_value) for r in got] == [(D("2024-01-02"), 2.0, D("2024-01-03"), None)]


def test_latest_row_per_key(series):
    df = series({"a": [("2024-01-01", 1.0), ("2024-01-02", None)], "b": [("2024-01-01", 7.0)]})
    assert {r.symbol: r.value for r in latest(df, "symbol", "date").collect()} == {"a": None, "b": 7.0}


def test_a_column_named_like_the_period_drops_no_rows(spark, tmp_path):
    from datetime import date

    from seriesframe.sources.tables import write_table

    rows = [(date(2020, 12, 30), "x"), (date(2021, 1, 1), "y"), (date(2021, 1, 6), None)]
    df = spark.createDataFrame(rows, "date date, period string")
    assert panels.trail(df, "date", 7).count() == 3
    for grain in ("day", "week", "month", "year"):
        table = write_table(df.drop("period"), f"{tmp_path}/{grain}", "date", grain)
        assert panels.trail(table, "date", 7).count() == panels.trail(table, "date", 7, grain=grain).count() == 3
