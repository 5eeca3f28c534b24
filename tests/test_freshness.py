from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from seriesframe.functions.columns import utc_hour
from seriesframe.operators import freshness

D = date.fromisoformat


def _ts(text):
    return F.to_timestamp_ntz(F.lit(text))


@pytest.mark.parametrize(
    "moment,expected",
    [
        ("2024-03-02 12:00:00", "2024-03-01"),
        ("2024-03-03 22:00:00", "2024-03-01"),
        ("2024-03-04 20:59:00", "2024-03-01"),
        ("2024-03-04 21:00:00", "2024-03-04"),
        ("2024-03-06 05:00:00", "2024-03-05"),
    ],
)
def test_expected_trading_date(spark, moment, expected):
    got = spark.range(1).select(freshness.expected_date(_ts(moment)).alias("d")).collect()[0].d
    assert got == D(expected)


@pytest.mark.parametrize(
    "cadence,latest,status",
    [
        ("trading_day", "2024-03-01", "FRESH"),
        ("trading_day", "2024-02-29", "STALE"),
        ("daily", "2024-03-03", "FRESH"),
        ("daily", "2024-03-02", "STALE"),
        ("daily_lagged", "2024-03-02", "FRESH"),
        ("daily_lagged", "2024-03-01", "STALE"),
        ("mixed", "2020-01-01", "SEE PER-SERIES"),
        ("weekly", "2024-03-04", "UNKNOWN"),
        ("daily", None, "NO DATA"),
    ],
)
def test_cadence(spark, cadence, latest, status):
    day = F.lit(latest).cast("date")
    got = spark.range(1).select(freshness.cadence_status(F.lit(cadence), day, _ts("2024-03-04 13:00:00")).alias("s"))
    assert got.collect()[0].s == status


def test_series_thresholds(series):
    df = series({"cpi": [("2024-01-01", 1.0)], "gdp": [("2023-12-31", 1.0)], "y": [("2024-03-11", 1.0)], "z": [("2024-03-10", 1.0)]}, ent="series")
    got = freshness.series_freshness(df, "series", "date", ["cpi", "gdp"], _ts("2024-03-16 09:00:00"))
    assert {r.series: r.status for r in got.collect()} == {"cpi": "FRESH", "gdp": "STALE", "y": "FRESH", "z": "STALE"}


@pytest.fixture(scope="module")
def runs(spark):
    rows = [
        (datetime(2024, 3, 4, 6), "failure", "schedule"),
        (datetime(2024, 3, 4, 9), "success", "manual"),
        (datetime(2024, 3, 2, 6), "success", "schedule"),
        (datetime(2024, 3, 5, 6), None, "schedule"),
    ]
    return spark.createDataFrame(rows, "ts timestamp_ntz, conclusion string, event string")


def test_last_run_of_each_day(runs):
    got = freshness.last_run_per_day(runs, _ts("2024-03-05 07:00:00"), "ts", ["event", "conclusion"]).orderBy("date").collect()
    assert [r.date.day for r in got] == [28, 29, 1, 2, 3, 4, 5]
    assert [(r.event, r.conclusion) for r in got][3:] == [("schedule", "success"), (None, None), ("manual", "success"), ("schedule", None)]


def test_a_running_run_is_not_a_failure(runs):
    r = freshness.run_state(runs, _ts("2024-03-05 07:00:00"), "ts").collect()[0]
    assert (r.completed_date, r.completed_status, r.in_progress_today) == (D("2024-03-04"), "success", True)
    none = freshness.run_state(runs.filter("conclusion is null"), _ts("2024-03-06 07:00:00"), "ts").collect()[0]
    assert (none.completed_status, none.in_progress_today) == (None, False)


@pytest.mark.parametrize(
    "status,n_open,n_stale,word",
    [
        ("success", 0, 0, "HEALTHY"),
        ("failure", 0, 0, "CHECK RUN LOG"),
        ("success", 1, 0, "CHECK RUN LOG"),
        (None, 0, 0, "CHECK RUN LOG"),
        ("success", 0, 2, "CHECK DATA"),
        ("failure", 0, 1, "NEEDS ATTENTION"),
    ],
)
def test_verdict(spark, status, n_open, n_stale, word):
    state = spark.createDataFrame([(status,)], "completed_status string")
    incidents = spark.createDataFrame([(n_open,)], "open_incidents long")
    stale = spark.range(n_stale).select(F.lit("x").alias("source"))
    assert freshness.verdict(state, incidents, stale).collect()[0].verdict == word


def test_stale_list_and_lineage(spark, series):
    specs = [freshness.TableSpec("t", "s", "b", "date", "daily", "Panel"), freshness.TableSpec("e", "s", "b", "date", "daily", "Other")]
    frames = {"t": series({"a": [("2024-03-01", 1.0)]}), "e": series({"a": [("2024-03-01", 1.0)]}).limit(0)}
    now = _ts("2024-03-05 07:00:00")
    fresh = freshness.table_freshness(frames, specs, now)
    assert {r.table: (r.status, r.total_rows) for r in fresh.collect()} == {"t": ("STALE", 1), "e": ("NO DATA", 0)}
    by_series = freshness.series_freshness(series({"cpi": [("2023-01-01", 1.0)]}, ent="series"), "series", "date", [], now)
    assert {r.source for r in freshness.stale_sources(fresh, by_series, "series").collect()} == {"t", "series:cpi"}
    assert {r.panel for r in freshness.lineage(fresh, freshness.registry(spark, specs)).collect()} == {"Panel", "Other"}


def test_open_incidents(spark):
    rows = [(datetime(2024, 3, 1), "old", "open"), (datetime(2024, 3, 3), "new", "open"), (datetime(2024, 3, 4), "done", "closed")]
    df = spark.createDataFrame(rows, "opened timestamp_ntz, title string, state string")
    r = freshness.open_incidents(df, "opened", "title").collect()[0]
    assert (r.open_incidents, r.latest_title) == (2, "new")


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Tokyo"])
def test_dates_are_cut_in_utc_in_any_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        row = spark.sql(
            "select timestamp'2024-03-06T21:30:00Z' as zoned, timestamp_ntz'2024-03-06 21:30:00' as plain,"
            " timestamp'2024-03-10T00:15:00Z' as sunday, timestamp'2024-11-03T05:30:00Z' as doubled"
        ).select(
            freshness.expected_date(F.col("zoned")).alias("a"),
            freshness.expected_date(F.col("plain")).alias("b"),
            freshness.expected_date(F.col("sunday")).alias("c"),
            utc_hour("doubled").alias("d"),
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert (str(row.a), str(row.b), str(row.c), row.d) == ("2024-03-06", "2024-03-06", "2024-03-08", 5)


def test_footers_alone_tell_dates_and_counts(spark, tmp_path):
    from seriesframe.sources.tables import write_table
    from seriesframe.sources.upsert import upsert

    rows = spark.createDataFrame([("a", date(2024, 1, 1), 1.0), ("a", date(2024, 2, 3), None), ("b", None, 2.0)], "k string, day date, v double")
    paths = {n: str(tmp_path / n) for n in ("plain", "parts", "merged")}
    write_table(rows, paths["plain"])
    write_table(rows, paths["parts"], "day", "month")
    upsert(spark, paths["merged"], rows, ["k", "day"], "day")
    upsert(spark, paths["merged"], rows.filter("day > '2024-02-01'").withColumn("day", F.date_add("day", 1)), ["k", "day"], "day")
    probed = freshness.footer_probe(spark, paths, dict.fromkeys(paths, "day"))
    assert {r.table: (r.latest_date, r.total_rows) for r in probed.collect()} == {
        "plain": (date(2024, 2, 3), 3),
        "parts": (date(2024, 2, 3), 3),
        "merged": (date(2024, 2, 4), 4),
    }
    for name in paths:
        plan = freshness.footer_aggregate(spark, paths[name], "day")._jdf.queryExecution().executedPlan().toString()
        assert "PushedAggregation: [MAX(day), COUNT(*)]" in plan
