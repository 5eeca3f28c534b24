import math
import statistics
from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from seriesframe.functions.quantiles import exact_median, value_chunk
from seriesframe.operators import findings, snapshots

D = date.fromisoformat


def _line(spark, start, values, name):
    from datetime import timedelta

    return spark.createDataFrame([(D(start) + timedelta(days=i), v) for i, v in enumerate(values)], f"date date, {name} double")


def test_curves_use_complete_rows(spark):
    rows = [(D("2024-01-01"), 0.1, 0.2), (D("2024-01-02"), None, 0.2), (D("2024-01-03"), 0.1, 0.0)]
    df = spark.createDataFrame(rows, "date date, a double, b double")
    got = findings.cumulative(df, "date", {"a": "ca", "b": "cb"}).orderBy("date").collect()
    assert [(round(r.ca, 9), round(r.cb, 9)) for r in got] == [(0.1, 0.2), (0.21, 0.2)]


def test_total_change_over_entities(spark):
    rows = [("x", D("2024-01-01"), 0), ("x", D("2024-01-02"), 4), ("y", D("2024-01-02"), 6), ("x", D("2024-01-03"), 15)]
    got = findings.total_change(spark.createDataFrame(rows, "t string, date date, views long"), "date", "views")
    assert [(r.views, r.pct_change) for r in got.orderBy("date").collect()] == [(0, None), (10, None), (15, 0.5)]


def test_spikes_prefer_the_earlier_of_equal_ones(spark):
    df = _line(spark, "2024-01-01", [0.1, 0.9, None, 0.9, 0.5], "c")
    assert [r.date.day for r in findings.top_spikes(df, "date", "c", 2).collect()] == [2, 4]


def test_lag_scan_matches_a_loop(spark):
    rng = np.random.default_rng(3)
    x = [None if i % 7 == 3 else float(v) for i, v in enumerate(rng.normal(size=40))]
    y = [None if i % 5 == 1 else float(v) for i, v in enumerate(rng.normal(size=40))]
    got = {r.lag: r for r in findings.lag_corr(_line(spark, "2023-12-20", x, "x"), _line(spark, "2023-12-25", y, "y"), "date", "x", "y").collect()}
    axis = 45
    xs, ys = x + [None] * 5, [None] * 5 + y
    for k in range(-10, 11):
        pairs = [(xs[i], ys[i + k]) for i in range(axis) if 0 <= i + k < axis and xs[i] is not None and ys[i + k] is not None]
        assert got[k].n_pairs == len(pairs)
        assert got[k].correlation == pytest.approx(np.corrcoef(*zip(*pairs))[0, 1])


def test_lag_scan_with_too_few_pairs_or_a_constant_side(spark):
    x = _line(spark, "2024-01-01", [1.0, 2.0], "x")
    y = _line(spark, "2024-01-01", [2.0, 1.0], "y")
    assert [(r.correlation, r.n_pairs) for r in findings.lag_corr(x, y, "date", "x", "y", [0, 5]).orderBy("lag").collect()] == [(None, 2), (None, 0)]
    flat = _line(spark, "2024-01-01", [1.0] * 6, "x")
    ramp = _line(spark, "2024-01-01", [float(i) for i in range(6)], "y")
    assert findings.lag_corr(flat, ramp, "date", "x", "y", [0]).collect()[0].correlation is None


def test_best_lag_takes_the_smallest_of_equals(spark):
    scan = spark.createDataFrame([(-2, -0.5, 16), (1, 0.5, 16), (3, None, 16)], "lag int, correlation double, n_pairs long")
    r = findings.best_lag(scan).collect()[0]
    assert (r.best_lag, r.best_corr, r.threshold, r.above_noise) == (-2, -0.5, 0.5, True)


def test_event_at_the_edge(spark):
    axis = _line(spark, "2024-01-01", [None, 0.5, 0.1, 9.0], "c")
    ret = spark.createDataFrame([(D("2024-01-02"), 0.1), (D("2024-01-03"), 0.2)], "date date, r double")
    events = axis.filter(F.col("c").isin(0.5, 9.0))
    got = {r.spike_date.day: r for r in findings.event_study(events, axis, ret, "date", "c", "r").collect()}
    assert (got[2].return_before_pct, got[2].n_before, got[2].n_after) == (0.0, 0, 1)
    assert got[2].return_after_pct == pytest.approx(20.0)
    assert (got[4].return_after_pct, got[4].n_after, got[4].n_before) == (0.0, 0, 2)
    assert got[4].return_before_pct == pytest.approx(32.0)
    gap = findings.event_summary(findings.event_study(events, axis, ret, "date", "c", "r")).collect()[0]
    assert gap.gap_pts == pytest.approx((20.0 + 0.0) / 2 - (0.0 + 32.0) / 2)


def test_concentration(spark):
    df = spark.createDataFrame([("a", 60.0), ("b", 30.0), ("c", 10.0)], "s string, v double")
    r = findings.concentration(df, "s", "v").collect()[0]
    assert (r.n, r.hhi, r.band, r.top_entity, r.second_share_pct, r.top_vs_rest) == (3, 4600.0, "highly concentrated", "a", 30.0, "more than the rest")
    assert r.effective_n == pytest.approx(10000 / 4600) and r.top_vs_fair == pytest.approx(1.8)
    one = findings.concentration(df.filter("s = 'a'"), "s", "v").collect()[0]
    assert (one.second_share_pct, one.top_vs_second) == (None, None)


def test_rounded_shares(spark):
    df = spark.createDataFrame([(c, 1.0) for c in "abc"], "s string, v double")
    assert findings.concentration(df, "s", "v", 1).collect()[0].hhi == pytest.approx(3 * 33.3**2)


def test_direction_has_no_label_for_equal_values(spark):
    got = findings.direction(_line(spark, "2024-01-01", [1.0, 2.0, 2.0, 1.0, None, 3.0], "v"), "date", "v")
    assert [r.direction for r in got.orderBy("date").collect()] == [None, "rising", None, "falling", None, None]


def test_conditional_returns_and_exceptions(spark):
    labels = spark.createDataFrame([(D("2024-01-02"), "rising"), (D("2024-01-03"), "falling"), (D("2024-01-04"), None)], "date date, direction string")
    rows = [("a", "2024-01-02", 0.1), ("a", "2024-01-03", -0.1), ("a", "2024-01-04", 9.0), ("b", "2024-01-02", 0.5), ("c", "2024-01-02", -0.2), ("c", "2024-01-03", 0.3)]
    ret = spark.createDataFrame([(s, D(d), r) for s, d, r in rows], "symbol string, date date, r double")
    sens = findings.conditional_return(ret, labels, "symbol", "date", "r")
    assert {r.symbol: (r.rising, r.falling) for r in sens.collect()} == {"a": (10.0, -10.0), "b": (50.0, None), "c": (-20.0, 30.0)}
    assert [r.symbol for r in findings.exceptions(sens).collect()] == ["a"]
    c = findings.exception_counts(sens).collect()[0]
    assert (c.total, c.exceptions, c.typical) == (3, 1, 2)
    assert [r.symbol for r in findings.sensitivity_board(sens, "symbol").collect()] == ["c", "a", "b"]


def test_extremes_take_the_earliest_of_equals(spark):
    r = findings.extremes(_line(spark, "2024-01-01", [None, 2.0, 5.0, 1.0, 5.0, 1.0], "v"), "date", "v").collect()[0]
    assert (r.max_date.day, r.min_date.day, r.first_date.day, r.latest_value) == (3, 4, 2, 1.0)
    assert r.max_to_mean == pytest.approx(5 / 2.8)


def test_cohorts(spark):
    data = {"p": [0.1, 0.1], "q": [0.3, -0.1], "r": [-0.5, 0.0], "z": [0.0, 0.02]}
    rows = [(s, D("2024-01-01") if i == 0 else D("2024-01-02"), v) for s, vs in data.items() for i, v in enumerate(vs)]
    df = spark.createDataFrame(rows, "symbol string, date date, r double")
    members = findings.cohort(df, "symbol", {"infra": ["p", "q", "r"], "core": ["z", "p"]})
    assert members.filter("symbol = 'p'").select("cohort").distinct().count() == 2
    got = {x.cohort: x for x in findings.cohort_summary(members, "symbol", "date", "r").collect()}
    infra = got["infra"]
    means = [(0.1 + 0.3 - 0.5) / 3, 0.0]
    totals = [(1.1 * 1.1 - 1) * 100, (1.3 * 0.9 - 1) * 100, -50.0]
    assert infra.final_return_pct == pytest.approx((math.prod(1 + m for m in means) - 1) * 100)
    assert infra.annual_vol == pytest.approx(statistics.stdev(means) * math.sqrt(252))
    assert (infra.members, infra.negative_members, infra.worst_member) == (3, 1, "r")
    assert infra.median_return_pct == pytest.approx(sorted(totals)[1])
    gap = findings.cohort_gap(findings.cohort_summary(members, "symbol", "date", "r"), "infra", "core").collect()[0]
    assert gap.gap_pts == pytest.approx(infra.final_return_pct - got["core"].final_return_pct)


def test_cohort_from_a_dimension(spark):
    df = spark.createDataFrame([("p", 1.0), ("q", 2.0), ("x", 9.0)], "symbol string, v double")
    dim = spark.createDataFrame([("p", "core"), ("p", "infra"), ("q", "infra")], "symbol string, cohort string")
    got = findings.cohort(df, "symbol", dim)
    assert sorted((r.cohort, r.symbol) for r in got.collect()) == [("core", "p"), ("infra", "p"), ("infra", "q")]


def test_product_of_returns_is_last_over_first(spark, series, days):
    from seriesframe.operators.returns import returns

    prices = [100 + (i * 37) % 11 for i in range(30)]
    rets = returns(series({"a": list(zip(days("2023-12-20", 30), map(float, prices)))}), "symbol", "date", "value")
    total = findings.total_return_by(rets, "symbol", "daily_return").collect()[0].total_return_pct
    assert total == pytest.approx((prices[-1] / prices[0] - 1) * 100)


# fixed values: two weekly snapshots, their metrics, and how each has moved
STEPS = [
    ("spread", "spread_pts", 60.670534102703996, 66.84592916836012, 1, "up", 6.2),
    ("events", "gap_pts", 5.961012037604146, 5.961012037604146, 1, "flat", 0.0),
    ("concentration", "top_share_pct", 29.5, 29.4, 1, "down", 0.1),
    ("rates", "typical", 10.0, 10.0, 0, "flat", 0.0),
    ("volatility", "latest", 0.9067253300534128, 0.8397481235443242, 2, "down", 0.07),
    ("cohorts", "gap_pts", 75.10015781934894, 93.01230882270325, 1, "up", 17.9),
]


def test_metric_change(spark):
    rows = [(D(d), s, m, v) for s, m, old, new, *_ in STEPS for d, v in (("2026-08-07", old), ("2026-08-14", new))]
    history = spark.createDataFrame(rows, "snapshot_date date, section string, metric string, value double")
    places = F.lit(1)
    for section, metric, _, _, n, _, _ in STEPS:
        places = F.when((F.col("section") == section) & (F.col("metric") == metric), n).otherwise(places)
    got = snapshots.metric_change(history, places)
    moved = {(r.section, r.metric): (r.moved, r.magnitude) for r in got.filter("snapshot_date = '2026-08-14'").collect()}
    assert moved == {(s, m): (word, pytest.approx(size)) for s, m, *_, word, size in STEPS}
    assert {r.moved for r in got.filter("snapshot_date = '2026-08-07'").collect()} == {"first"}


def test_snapshot_history_is_keyed_by_run(spark, tmp_path):
    target = str(tmp_path / "history")
    one = spark.createDataFrame([(5.0, "x")], "v double, t string")

    def rows(day, df=one):
        return snapshots.snapshot_rows({"s": (df, {"value": "v", "name": "t"})}, F.lit(day).cast("date"))

    for day in ("2024-01-01", "2024-01-08", "2024-01-15", "2024-01-15"):
        history = snapshots.append_snapshot(spark, target, rows(day))
    assert history.count() == 6
    recent = snapshots.last_two(history)
    assert {(r.snapshot_date.day, r.age) for r in recent.collect()} == {(15, 1), (8, 2)}
    assert {(r.metric, r.value, r.label) for r in recent.filter("age = 1").collect()} == {("value", 5.0, None), ("name", None, "x")}


def test_median_leaves_out_nan_and_orders_infinities(spark):
    inf, nan = float("inf"), float("nan")
    groups = {"a": [1.0, nan, 3.0, None], "b": [-inf, 0.0, inf], "c": [inf, inf, 1.0], "d": [-0.003, -0.002, 0.001, 0.004], "e": [nan]}
    df = spark.createDataFrame([(k, v) for k, vs in groups.items() for v in vs], "k string, v double")
    got = {r.k: r.m for r in exact_median(df, "k", "v", "m").collect()}
    assert got == {"a": 2.0, "b": 0.0, "c": inf, "d": -0.0005}


def test_value_chunks_are_ordered_and_split_small_values(spark):
    rows = spark.range(200_000).select(((F.col("id") - 100_000) / 1e7).alias("v"))
    extremes = spark.sql("select explode(array(4.9e-324D, -4.9e-324D, 1.7976931348623157e308D, -1.7976931348623157e308D,"
                         " double('inf'), double('-inf'), 0.5D, 0.49999999999999994D, 8D, 7.999999999999999D)) as v")
    chunked = rows.union(extremes).select("v", value_chunk(F.col("v")).alias("c"))
    bounds = sorted((r.lo, r.hi, r.c, r.n) for r in chunked.groupBy("c").agg(
        F.min("v").alias("lo"), F.max("v").alias("hi"), F.count("*").alias("n")).collect())
    assert [b[2] for b in bounds] == sorted(b[2] for b in bounds)
    assert all(x[1] < y[0] for x, y in zip(bounds, bounds[1:]))
    assert len(bounds) > 5000 and max(b[3] for b in bounds) < 200
