"""The daily and weekly jobs and the streaming jobs end to end."""

import json
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from seriesframe.operators.returns import returns
from seriesframe.plans import daily, weekly
from seriesframe.sources.landing import read_published
from seriesframe.sources.tables import read_table
from seriesframe.streaming import jobs, state

D = date.fromisoformat
SYMBOLS = {"IDX": "benchmark", "S1": "sector", "S2": "sector", "A": "ai_basket", "B": "ai_basket", "C": "ai_basket"}

KEYS = ["symbol", "date"]


def _price(symbol, day):
    return 100.0 + (sum(map(ord, symbol)) * (day.toordinal() % 17)) % 13


def _land(folder, run_day, span=3):
    """One run's documents: the last `span` bars per symbol, one reading per other series."""
    folder.mkdir(exist_ok=True)
    fetched = f"{run_day}T06:00:00+00:00"
    bars = [
        {"symbol": s, "category": c, "date": str(d), "open": _price(s, d), "high": _price(s, d) + 1, "low": _price(s, d) - 1, "close": _price(s, d), "volume": 10 + d.day}
        for s, c in SYMBOLS.items()
        for d in (run_day - timedelta(days=i) for i in range(1, span + 1))
    ]
    yesterday = str(run_day - timedelta(days=1))
    docs = {
        "market_data": {"records": bars, "fetched_at": fetched},
        "macro_data": {"10y_yield": {"date": yesterday, "value": 4 + run_day.day % 3}, "cpi": {"date": "2024-01-01", "value": None}, "fetched_at": fetched},
        "attention_data": {"Topic_x": {"date": yesterday, "views": 100 + (run_day.day * 37) % 50}, "fetched_at": fetched},
        "dev_momentum": {"own/er.x": {"stars": 1000 + run_day.toordinal() % 100}, "fetched_at": fetched},
        "research_pace": {"cs.AI": {"count": 50 + run_day.day}, "fetched_at": fetched},
    }
    for name, doc in docs.items():
        (folder / f"{name}.json").write_text(json.dumps(doc, indent=2))


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("lake")
    landing, lake = base / "landing", str(base / "lake")
    for run_day, span in ((D("2024-02-10"), 30), (D("2024-02-12"), 3)):
        _land(landing, run_day, span)
        gold = daily.run(spark, str(landing), lake, str(base / "published"))
    return base, lake, gold


def test_daily_job_accumulates_history(spark, built):
    _, lake, gold = built
    assert read_table(spark, f"{lake}/bronze/market_data").count() == 1
    assert read_table(spark, f"{lake}/silver/market_data").count() == 6 * 32
    assert gold["market_daily"].count() == 6 * 32
    assert gold["sector_rotation"].select("symbol").distinct().count() == 2
    assert gold["volatility"].filter(F.col("rolling_20d_volatility").isNotNull()).count() == 12
    assert gold["basket_vs_benchmark"].filter(F.col("spread").isNull()).count() == 1
    stars = {r.snapshot_date: r.stars for r in gold["dev_momentum"].collect()}
    assert set(stars) == {D("2024-02-10"), D("2024-02-12")}
    cpi = gold["macro_snapshot"].filter("series = 'cpi'").collect()
    assert [(r.value, r.trend) for r in cpi] == [(None, "n/a")]


def test_daily_job_publishes_ordered_json(spark, built):
    base, _, gold = built
    parts = sorted((base / "published" / "market_daily").glob("part-*"))
    rows = [json.loads(x) for p in parts for x in p.read_text().splitlines()]
    assert [(r["symbol"], r["date"]) for r in rows] == sorted((r["symbol"], r["date"]) for r in rows)
    assert rows[0]["daily_return"] is None and len(rows) == 6 * 32
    back = read_published(spark, str(base / "published" / "volatility"), "symbol string, date date, rolling_20d_volatility double", array_file=False)
    assert back.count() == gold["volatility"].count()


def test_weekly_job_compares_with_the_last_run(spark, built, tmp_path):
    _, _, gold = built
    market = gold["market_daily"]

    def metrics(until):
        upto = F.col("date") <= until
        return weekly.headline_metrics(
            market.filter(upto),
            gold["basket_vs_benchmark"].filter(upto),
            gold["attention_index"].filter(upto),
            gold["volatility"].filter(upto),
            gold["macro_snapshot"].filter((F.col("series") == "10y_yield") & upto),
            F.lit(until).cast("date"),
            {"infra": ["A"], "core": ["B", "C"]},
            vol_col="rolling_20d_volatility",
            basket="ai_basket",
        )

    first = weekly.run(spark, str(tmp_path / "h"), metrics("2024-02-05"))
    assert {r.moved for r in first.collect()} == {"first"}
    second = {(r.section, r.metric): r for r in weekly.run(spark, str(tmp_path / "h"), metrics("2024-02-11")).collect()}
    moved = second[("spread", "spread_pts")]
    step = round(moved.value - moved.previous, 1)
    assert moved.moved == ("flat" if step == 0 else "up" if step > 0 else "down")
    assert second[("rates", "total")].value is not None


def _run_of(spark, day, values):
    rows = [(D(day), section, metric, value, None) for (section, metric), value in values.items()]
    return spark.createDataFrame(rows, "snapshot_date date, section string, metric string, value double, label string")


def test_weekly_changes_are_flat_at_the_places_of_each_metric(spark, tmp_path):
    vol, corr, count, share = ("volatility", "latest_pct"), ("lag", "best_corr"), ("rates", "typical"), ("concentration", "top_share_pct")
    before = {vol: 1.00, corr: 0.100, count: 7.0, share: 20.00}
    after = {vol: 1.48, corr: 0.148, count: 6.0, share: 20.04}
    weekly.run(spark, str(tmp_path / "h"), _run_of(spark, "2024-02-05", before))
    rows = weekly.run(spark, str(tmp_path / "h"), _run_of(spark, "2024-02-12", after)).collect()
    got = {(r.section, r.metric): (r.moved, round(r.magnitude, 6)) for r in rows}
    assert got == {vol: ("up", 0.48), corr: ("up", 0.05), count: ("down", 1.0), share: ("flat", 0.0)}


def test_repeated_weekly_run_replaces_its_whole_snapshot(spark, tmp_path):
    target = str(tmp_path / "h")
    a, b = ("lag", "best_lag"), ("rates", "total")
    weekly.run(spark, target, _run_of(spark, "2024-02-05", {a: 1.0}))
    weekly.run(spark, target, _run_of(spark, "2024-02-12", {a: 2.0, b: 9.0}))
    weekly.run(spark, target, _run_of(spark, "2024-02-12", {a: 3.0}))
    kept = {(r.snapshot_date, r.metric, r.value) for r in spark.read.parquet(target).collect()}
    assert kept == {(D("2024-02-05"), "best_lag", 1.0), (D("2024-02-12"), "best_lag", 3.0)}


def test_weekly_metrics_from_the_gold_tables(spark, built):
    base, _, _ = built
    rows = weekly.from_gold(spark, str(base / "lake"), {"infra": ["A"], "core": ["B", "C"]}).collect()
    cells = {(r.section, r.metric): r.value for r in rows}
    assert cells[("cohorts", "gap_pts")] == pytest.approx(
        cells[("cohorts", "left_final_pct")] - cells[("cohorts", "right_final_pct")]
    )
    assert ("volatility", "latest_pct") in cells


def _feed(spark, folder, rows):
    spark.createDataFrame([(s, D(d), v, f) for s, d, v, f in rows], "symbol string, date date, close double, fetched_at int").coalesce(1).write.mode("append").parquet(folder)


def test_stream_upsert_equals_batch_and_continues(spark, tmp_path):
    feed, target, offsets = (str(tmp_path / n) for n in ("feed", "table", "offsets"))
    schema = "symbol string, date date, close double, fetched_at int"
    _feed(spark, feed, [("a", "2024-01-01", 1.0, 1), ("a", "2024-01-02", 2.0, 1)])

    def step():
        stream = spark.readStream.schema(schema).parquet(feed)
        return jobs.stream_upsert(spark, stream, target, ["symbol", "date"], "date", offsets, "fetched_at")

    assert step().count() == 2
    _feed(spark, feed, [("a", "2024-01-02", 2.5, 2), ("b", "2024-02-01", 3.0, 2)])
    want = [("a", 1, 1.0), ("a", 2, 2.5), ("b", 1, 3.0)]
    for _ in range(2):
        assert sorted((r.symbol, r.date.day, r.close) for r in step().collect()) == want


def test_landed_documents_stream_into_the_table(spark, tmp_path):
    from seriesframe.sources.landing import explode_records, type_cols

    folder = tmp_path / "landing"
    target, offsets = str(tmp_path / "bars"), str(tmp_path / "offsets")
    counts = []
    for run_day in (D("2024-02-10"), D("2024-02-11"), D("2024-02-12")):
        folder.mkdir(exist_ok=True)
        _land(folder / str(run_day), run_day)
        docs = jobs.stream_landing(spark, f"{folder}/*/market_data.json", daily.BARS_DOCUMENT, files_per_batch=1)
        rows = type_cols(explode_records(docs), daily.BAR_TYPES)
        table = jobs.stream_upsert(spark, rows, target, ["symbol", "date"], "date", offsets, "fetched_at")
        counts.append(table.count())
    assert counts == [18, 24, 30]
    assert {r.fetched_at.day for r in table.filter("date = '2024-02-09'").collect()} == {12}


def test_late_bars_fill_the_gap_and_its_neighbour(spark, tmp_path, series, days):
    from seriesframe.operators.returns import market_daily
    from seriesframe.sources.upsert import upsert

    bars_at, gold_at = str(tmp_path / "bars"), str(tmp_path / "gold")
    all_days = days("2023-12-28", 8)
    points = {s: [(d, 100.0 + i * k) for i, d in enumerate(all_days)] for k, s in enumerate(["a", "b"], 1)}
    full = series(points, "close").selectExpr("*", "'basket' category", "close open", "close high", "close low", "7L volume", "1 fetched_at")
    late = (F.col("symbol") == "a") & F.col("date").isin([D(all_days[3]), D(all_days[4])])
    early = upsert(spark, bars_at, full.filter(~late), KEYS, "date", "fetched_at")
    gold = market_daily(early, prev_dt="prev_date").withColumn("note", F.concat("symbol", F.lit("!")))
    upsert(spark, gold_at, gold, KEYS, "date")
    for _ in range(2):
        got = jobs.recover_late(spark, bars_at, gold_at, full.filter(late), prev_dt="prev_date")
    want = market_daily(full, prev_dt="prev_date")
    assert sorted(map(tuple, got.select(want.columns).collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    notes = {(r.symbol, r.date): r.note for r in got.collect()}
    assert {d for (_, d), note in notes.items() if note is None} == {D(all_days[3]), D(all_days[4])}


def test_stream_counts_equal_batch_counts_however_late(spark, tmp_path):
    rows = [(i, D(f"2024-01-{1 + i % 28:02d}"), "ab"[i % 2]) for i in range(60)]
    events = spark.createDataFrame(rows, "id int, ts date, kind string").withColumn("ts", F.col("ts").cast("timestamp"))
    feed = str(tmp_path / "feed")
    lots = [F.dayofmonth("ts") > 20, F.dayofmonth("ts") < 4, F.dayofmonth("ts").between(4, 20), F.dayofmonth("ts") == 9]
    for lot in lots:
        events.filter(lot).coalesce(1).write.mode("append").parquet(feed)
        stream = spark.readStream.schema(events.schema).parquet(feed)
        got = jobs.sliding_counts_table(spark, stream, "ts", "kind", "id", str(tmp_path / "t"), str(tmp_path / "o"))
    want = jobs.sliding_counts(events, "ts", "kind")
    assert sorted(map(tuple, got.select(want.columns).collect())) == sorted(map(tuple, want.collect()))


def test_kept_counts_equal_batch_counts_past_the_watermark(spark, tmp_path):
    rows = [(i, D(f"2024-01-{1 + i % 28:02d}"), "ab"[i % 2]) for i in range(90)]
    events = spark.createDataFrame(rows, "id int, ts date, kind string").withColumn("ts", F.col("ts").cast("timestamp"))
    feed, target = str(tmp_path / "feed"), str(tmp_path / "t")
    day = F.dayofmonth("ts")
    lots = [day.between(8, 12), (F.col("id") < 40) & (day > 20), (day < 8) | (F.col("id") >= 40) & (day > 20), day.between(13, 20)]
    for lot in lots:
        events.filter(lot).coalesce(1).write.mode("append").parquet(feed)
        stream = spark.readStream.schema(events.schema).parquet(feed)
        got = state.sliding_counts_kept(spark, stream, "ts", "kind", target, str(tmp_path / "o"), pieces=2)
    want = jobs.sliding_counts(events, "ts", "kind")
    assert sorted(map(tuple, got.select(want.columns).collect())) == sorted(map(tuple, want.collect()))
    kept = read_table(spark, f"{target}_days")
    assert kept.filter(F.col("lot") == state.HELD).count() and kept.filter(F.col("lot") > 0).count()
    assert spark.conf.get("spark.sql.streaming.noDataMicroBatches.enabled") == "true"


def test_kept_counts_refuse_events_without_a_category(spark, tmp_path):
    from pyspark.errors import StreamingQueryException

    spark.createDataFrame([(1, D("2024-01-01"), None)], "id int, ts date, kind string").write.parquet(str(tmp_path / "feed"))
    stream = spark.readStream.schema("id int, ts date, kind string").parquet(str(tmp_path / "feed"))
    with pytest.raises(StreamingQueryException):
        state.sliding_counts_kept(spark, stream, "ts", "kind", str(tmp_path / "t"), str(tmp_path / "o"))


def test_health_report(spark, built):
    from datetime import datetime

    from seriesframe.plans import health

    _, _, gold = built
    runs = spark.createDataFrame([(datetime(2024, 2, 12, 6), "schedule", "success", "success")], "ts timestamp_ntz, event string, status string, conclusion string")
    incidents = spark.createDataFrame([], "opened timestamp_ntz, title string, state string")
    now = F.to_timestamp_ntz(F.lit("2024-02-12 07:00:00"))
    report = health.report(gold, runs, incidents, now)
    status = {r.table: r.status for r in report["tables"].collect()}
    assert status.pop("macro_snapshot") == "SEE PER-SERIES" and set(status.values()) == {"FRESH"} and len(status) == 8
    assert [r.source for r in report["stale"].collect()] == []
    assert report["verdict"].collect()[0].verdict == "HEALTHY"
    late = health.report(gold, runs, incidents, F.to_timestamp_ntz(F.lit("2024-03-20 07:00:00")))
    assert {"market_daily", "macro:cpi", "macro:10y_yield"} <= {r.source for r in late["stale"].collect()}
    assert late["verdict"].collect()[0].verdict == "CHECK DATA"
    assert {r.source for r in report["digest"].collect()} == {"market", "spread", "volatility", "macro", "attention", "levels", "counts"}


def test_dashboard_panels(spark, built):
    from seriesframe.plans import dashboard

    _, _, gold = built
    for days in (7, None):
        shown = {name: df.collect() for name, df in dashboard.panel_tables(gold, days).items()}
        assert [r.as_of for r in shown["as_of"]] == [D("2024-02-11")]
        assert len(shown["sector_returns"]) == 2 and len(shown["spread"]) == 2 and len(shown["market"]) == 1
        assert sum(r.share_pct for r in shown["basket_volume"]) == pytest.approx(100)
        assert {r.label for r in shown["attention"]} == {"Topic x"} and {r.label for r in shown["growth"]} == {"er.x"}
        first = gold["market_daily"].filter("symbol = 'IDX'").orderBy("date").collect()
        kept = [r for r in first if days is None or r.date > D("2024-02-11") - timedelta(days=days)]
        market = shown["market"][0]
        assert (market.open, market.high, market.close) == (kept[0].open, max(r.high for r in kept), kept[-1].close)
