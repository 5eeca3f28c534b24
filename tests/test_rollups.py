"""Kept summaries of dyadic runs against plain aggregates over the same windows."""

import random
import re
from datetime import date, timedelta

from pyspark.sql import functions as F

from seriesframe.operators import rollups

M = {
    "growth": rollups.Measure("growth", "r"),
    "total": rollups.Measure("sum", "v"),
    "known": rollups.Measure("count", "v"),
    "top": rollups.Measure("max", "v"),
    "low": rollups.Measure("min", "v"),
    "start": rollups.Measure("first", "v"),
    "end": rollups.Measure("last", "v"),
}
SCHEMA = "ent string, dt date, v long, r double"


def _rows(draw, ents="ab"):
    first = date(1969, 11, 20)
    return [
        (e, first + timedelta(days=i), draw.choice([None, draw.randrange(100)]), draw.choice([None, 0.5, -0.25]))
        for e in ents
        for i in range(140)
        if draw.random() < 0.6
    ]


def _plain(rows, ent, lo, hi):
    mine = sorted((r for r in rows if r[0] == ent and lo <= r[1] <= hi), key=lambda r: r[1])
    known = [r[2] for r in mine if r[2] is not None]
    growth = None
    for r in mine:
        if r[3] is not None:
            growth = (1.0 if growth is None else growth) * (1 + r[3])
    ends = (max(known), min(known), known[0], known[-1]) if known else (None,) * 4
    return (mine[0][1], mine[-1][1], growth and round(growth, 9), sum(known) if known else None, len(known), *ends) if mine else None


def _got(rolled, windows):
    found = rollups.over_windows(rolled, windows, "ent", M, 6)
    return {(r.ent, r.label): (r.first_day, r.last_day, r.growth and round(r.growth, 9), r.total, r.known, r.top, r.low, r.start, r.end) for r in found.collect()}


def test_runs_cover_a_window_once(spark):
    draw = random.Random(8)
    spans = [(-5, -5), (0, 63), (1, 62), (-40, 200), (7, 6)] + [(a, a + draw.randrange(150)) for a in draw.choices(range(-90, 90), k=30)]
    df = spark.createDataFrame(spans, "a int, b int").select("a", "b", F.date_from_unix_date("a").alias("x"), F.date_from_unix_date("b").alias("y"))
    for r in df.select("a", "b", rollups.runs_of(F.col("x"), F.col("y"), 6).alias("runs")).collect():
        days = sorted(d for n in r.runs for d in range(n.run << n.level, (n.run + 1) << n.level))
        assert days == list(range(r.a, r.b + 1))
        assert len(r.runs) <= 2 * 6 + 4


def test_any_window_and_a_refresh(spark, tmp_path):
    draw = random.Random(5)
    rows = _rows(draw)
    days = sorted({r[1] for r in rows})
    asked = [(e, f"w{i}", *sorted(draw.sample(days, 2))) for i, e in enumerate("ab" * 12)] + [("a", "one", days[3], days[3]), ("z", "none", days[0], days[9])]
    windows = spark.createDataFrame(asked, "ent string, label string, first date, last date")
    want = {(e, label): _plain(rows, e, lo, hi) for e, label, lo, hi in asked}
    want = {k: v for k, v in want.items() if v}
    rolled = rollups.roll_up(spark.createDataFrame(rows, SCHEMA), "ent", "dt", M, 6)
    assert _got(rollups.write_rollups(rolled, str(tmp_path / "r")), windows) == want

    late = [r for r in rows if draw.random() < 0.1]
    replaced = {(r[0], r[1]) for r in late}
    before = [(e, d, 1 if (e, d) in replaced and d.day % 2 else v, g) for e, d, v, g in rows if (e, d) not in replaced or d.day % 2]
    target = str(tmp_path / "s")
    rollups.write_rollups(rollups.roll_up(spark.createDataFrame(before, SCHEMA), "ent", "dt", M, 6), target)
    frame = spark.createDataFrame(rows, SCHEMA)
    kept = rollups.refresh_rollups(spark, target, frame, spark.createDataFrame(late, SCHEMA), "ent", "dt", M, 6)
    assert _got(kept, windows) == want


def test_days_are_read_at_the_ends_only(spark, tmp_path):
    start = date(2001, 1, 1)
    rows = [("a", start + timedelta(days=i), 1, 0.0) for i in range(4000)]
    kept = rollups.write_rollups(rollups.roll_up(spark.createDataFrame(rows, SCHEMA), "ent", "dt", M), str(tmp_path / "r"))
    asked = rollups.trailing_windows(kept, "ent", [3000, None])
    found = rollups.over_windows(kept, asked, "ent", M)
    assert {r.days: r.known for r in found.collect()} == {3000: 3000, None: 4000}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*array_contains\(", plan)
    assert asked.withColumn("n", F.size(rollups.runs_of(F.col("first"), F.col("last")))).agg(F.max("n")).first()[0] <= 28


def _sparse(draw, ents=60, n=25):
    first = date(1992, 1, 1)
    return [(f"e{e}", first + timedelta(days=d), draw.randrange(100), 0.5) for e in range(ents) for d in draw.sample(range(2500), n)]


def test_sparse_entities_keep_less_than_two_rows_a_day(spark):
    rows = _sparse(random.Random(3)) + [("dense", date(1999, 1, 1) + timedelta(days=i), 1, 0.0) for i in range(300)] + [(None, date(1970, 1, 1), 1, 0.0)]
    rolled = rollups.roll_up(spark.createDataFrame(rows, SCHEMA), "ent", "dt", M).collect()
    assert len(rolled) < 2 * len(rows)
    days = {}
    for r in rows:
        days.setdefault(r[0], set()).add((r[1] - date(1970, 1, 1)).days)
    want = set()
    for e, mine in days.items():
        for k in range(rollups.TOP + 1):
            runs = {d >> k for d in mine}
            want |= {(e, k, x) for x in runs if k == rollups.TOP or x ^ 1 in runs}
    assert {(r.ent, r.level, r.run) for r in rolled} == want and len(want) == len(rolled)


def test_a_refresh_gives_the_rows_of_a_new_roll_up(spark, tmp_path):
    draw = random.Random(9)
    rows = _sparse(draw, 20)
    late = [r for r in rows if draw.random() < 0.2]
    target = str(tmp_path / "r")
    rollups.write_rollups(rollups.roll_up(spark.createDataFrame([r for r in rows if r not in late], SCHEMA), "ent", "dt", M), target)
    frame = spark.createDataFrame(rows, SCHEMA)
    kept = rollups.refresh_rollups(spark, target, frame, spark.createDataFrame(late, SCHEMA), "ent", "dt", M)
    whole = rollups.roll_up(frame, "ent", "dt", M).select(*kept.columns)
    assert sorted(map(repr, kept.collect())) == sorted(map(repr, whole.collect()))


def test_daily_rows_travel_once(spark, tmp_path):
    rows = _rows(random.Random(4)) + [("a", date(1970, 1, 2), 7, 0.5)] * 2 + [(None, date(1971, 3, 4), 1, None), ("b", None, 1, 0.5)]
    frame = spark.createDataFrame([(*r, "unused") for r in rows], SCHEMA + ", other string")
    once = rollups.roll_up(frame, "ent", "dt", M, 6, daily=True)
    assert once._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    want = sorted(map(repr, rollups.roll_up(frame, "ent", "dt", M, 6).select(*once.columns).collect()))
    kept = rollups.write_rollups(once, str(tmp_path / "r"), gather=False).select(*once.columns)
    assert sorted(map(repr, once.collect())) == sorted(map(repr, kept.collect())) == want


def test_a_window_over_everything_reads_the_longest_runs_only(spark, tmp_path):
    rows = _rows(random.Random(6))
    kept = rollups.write_rollups(rollups.roll_up(spark.createDataFrame(rows, SCHEMA), "ent", "dt", M), str(tmp_path / "r"))
    asked = rollups.trailing_windows(kept, "ent", [None])
    longest = kept.filter(F.col("part") >= rollups.TOP * rollups.YEARS)
    want = {e: sum(r[2] is not None for r in rows if r[0] == e) for e in "ab"}
    assert {r.ent: r.known for r in rollups.over_windows(longest, asked, "ent", M).collect()} == want
    parts = rollups._end_parts(rollups._widened(kept, asked, ["ent"], rollups.TOP), rollups.TOP)
    assert spark.range(1).select(F.size(parts).alias("n")).first().n == 0


def test_days_of_known_values_are_kept_where_they_are_not_the_ends(spark):
    rows = [("a", date(2001, 1, d), v, 0.0) for d, v in ((8, None), (9, 3), (10, 4), (11, None))]
    rolled = rollups.roll_up(spark.createDataFrame(rows, SCHEMA), "ent", "dt", M)
    found = {(r.first_day.day, r.last_day.day): (r.start, r.start_on and r.start_on.day, r.end, r.end_on and r.end_on.day) for r in rolled.collect()}
    assert found[8, 11] == (3, 9, 4, 10) and found[9, 9] == (3, None, 3, None) and found[8, 8] == (None,) * 4
    windows = spark.createDataFrame([("a", date(2001, 1, 8), date(2001, 1, 10))], "ent string, first date, last date")
    met = rollups.over_windows(rolled, windows, "ent", M).first()
    assert (met.start_on, met.end_on) == (date(2001, 1, 9), date(2001, 1, 10))
