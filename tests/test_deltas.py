"""Deltas merged into old tables against full rebuilds, for random late rows."""

import random
from datetime import date, timedelta

import pytest

from seriesframe.operators import deltas, findings, indexing, returns, shaping
from seriesframe.sources.workspace import written

START = date(2023, 11, 1)
COHORTS = {"left": ["a", "b"], "right": ["b", "c"]}


def _bars(draw):
    rows = []
    for symbol, kind in (("a", "basket"), ("b", "basket"), ("c", "basket"), ("x", "benchmark")):
        for i in range(90):
            if draw.random() < 0.8:
                price = 0.0 if draw.random() < 0.05 else round(draw.uniform(50, 150), 2)
                rows.append((symbol, kind, START + timedelta(days=i), price, price, price, price, 1))
    return rows


SCHEMA = "symbol string, category string, date date, open double, high double, low double, close double, volume long"


def _merged(old, delta, keys):
    """{key: row} of the old rows with those of the delta put over them."""
    names = [c for c in delta.columns]
    out = {tuple(r[k] for k in keys): tuple(r[c] for c in names) for r in old.select(*names).collect()}
    return out | {tuple(r[k] for k in keys): tuple(r[c] for c in names) for r in delta.collect()}


def _same(got, want, names, keys):
    expected = {tuple(r[k] for k in keys): tuple(r[c] for c in names) for r in want.select(*names).collect()}
    assert got.keys() == expected.keys()
    for key, row in expected.items():
        for a, b in zip(got[key], row):
            assert a == b or a == pytest.approx(b, rel=1e-9, abs=1e-12), (key, got[key], row)


@pytest.mark.parametrize("seed", [1, 2])
def test_bars(spark, seed):
    draw = random.Random(seed)
    rows = _bars(draw)
    # late: scattered rows, an entity's first ones, and a replaced one
    late = [r for r in rows if draw.random() < 0.05 or (r[0] == "b" and r[2] < START + timedelta(days=12))]
    early = [r for r in rows if r not in late]
    replaced = early[40]
    late.append((*replaced[:6], replaced[6] + 7.0, 1))
    final = [r for r in early if r[:3] != replaced[:3]] + late
    old, new = (written(returns.market_daily(spark.createDataFrame(x, SCHEMA), prev_dt="prev_date"), "daily") for x in (early, final))
    changed = deltas.changed_returns(new, spark.createDataFrame(late, SCHEMA), "symbol", "date", "prev_date")
    keys = ["symbol", "date"]
    vol = deltas.volatility_delta(new, changed, "symbol", "date", n=5)
    _same(_merged(returns.rolling_vol(old, "symbol", "date", n=5), vol, keys), returns.rolling_vol(new, "symbol", "date", n=5), vol.columns, keys)
    spread = deltas.spread_delta(new, changed, "date")
    _same(_merged(returns.basket_vs_benchmark(old), spread, ["date"]), returns.basket_vs_benchmark(new), spread.columns, ["date"])

    def curves(daily):
        return findings.cohort_curve(findings.cohort(daily, "symbol", COHORTS), "date", "daily_return")

    members = findings.cohort(new, "symbol", COHORTS)
    moved = members.join(changed, keys, "left_semi").select("cohort", "date").distinct()
    curve = deltas.curve_delta(curves(old), members, moved, "date", "daily_return")
    kept = {k: v for k, v in _merged(curves(old), curve, ["cohort", "date"]).items() if v[curve.columns.index("mean_return")] is not None}
    _same(kept, curves(new), curve.columns, ["cohort", "date"])


def test_reach_is_short(spark):
    rows = [("a", "basket", START + timedelta(days=i), 1.0, 1.0, 1.0, 100.0 + i % 7, 1) for i in range(300)]
    daily = returns.market_daily(spark.createDataFrame(rows, SCHEMA), prev_dt="prev_date")
    late = spark.createDataFrame(rows[200:201], SCHEMA)
    changed = deltas.changed_returns(daily, late, "symbol", "date", "prev_date")
    assert {r.date for r in changed.collect()} == {rows[200][2], rows[201][2]}
    reached = {r.date for r in deltas.volatility_delta(daily, changed, "symbol", "date").collect()}
    assert {rows[i][2] for i in range(200, 221)} <= reached and not reached & {rows[i][2] for i in [*range(40, 200), *range(221, 300)]}


def test_values_and_events(spark):
    draw = random.Random(3)
    rows = [(e, START + timedelta(days=i), draw.choice([0, 5, 9, 12])) for e in "pqr" for i in range(30) if draw.random() < 0.7]
    schema = "entity string, date date, value long"
    late = [r for r in rows if (r[0] == "p" and r[1] < START + timedelta(days=5)) or (r[0] == "q" and r[1] > START + timedelta(days=20))]
    full, old = (indexing.index_to_first(spark.createDataFrame(x, schema), "entity", "date", "value") for x in (rows, [r for r in rows if r not in late]))
    delta = deltas.index_delta(spark.createDataFrame(rows, schema), spark.createDataFrame(late, schema), "entity", "date", "value")
    _same(_merged(old, delta, ["entity", "date"]), full, delta.columns, ["entity", "date"])
    assert {r.entity for r in delta.collect()} == {"p", "q"}

    events = [(i, draw.choice("st"), START + timedelta(days=draw.randrange(40))) for i in range(120)]
    schema = "event_id int, category string, ts date"
    late = [e for e in events if e[0] % 17 == 0]
    full, old = (shaping.trailing_count(spark.createDataFrame(x, schema), "category", "ts") for x in (events, [e for e in events if e not in late]))
    delta = deltas.trailing_delta(spark.createDataFrame(events, schema), spark.createDataFrame(late, schema), "category", "ts")
    _same(_merged(old, delta, ["category", "snapshot_date"]), full, delta.columns, ["category", "snapshot_date"])
