"""Upsert, snapshots, landing, export."""

import glob
import json
import os
import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from seriesframe.functions import columns as C
from seriesframe.operators import shaping
from seriesframe.sources import landing, tables
from seriesframe.sources import upsert as upserts
from seriesframe.sources.export import export_json, export_json_array, publishable
from seriesframe.sources.tables import read_table, write_table
from seriesframe.sources.upsert import merge_rows, upsert
from seriesframe.sources.workspace import Folder

D = date.fromisoformat
KEYS = ["symbol", "date"]


def _bars(spark, rows):
    typed = [(s, D(d) if d else None, v, f) for s, d, v, f in rows]
    return spark.createDataFrame(typed, "symbol string, date date, close double, fetched_at int")


def _rows(df):
    return sorted(((r.symbol, r.date and r.date.isoformat(), r.close) for r in df.collect()), key=repr)


def test_upsert_creates_replaces_and_adds(spark, tmp_path):
    target = str(tmp_path / "t")
    upsert(spark, target, _bars(spark, [("a", "2024-01-30", 1.0, 1), ("a", "2024-02-01", 2.0, 1), ("b", "2023-12-01", 9.0, 1)]), KEYS, "date", "fetched_at")
    untouched = sorted(p.name for p in (tmp_path / "t" / "merge=0" / "period=2023-12-01").iterdir())
    second = _bars(spark, [("a", "2024-02-01", 2.5, 2), ("a", "2024-02-02", 3.0, 2), ("a", "2024-02-02", 2.9, 1)])
    want = [("a", "2024-01-30", 1.0), ("a", "2024-02-01", 2.5), ("a", "2024-02-02", 3.0), ("b", "2023-12-01", 9.0)]
    for _ in range(2):
        assert _rows(upsert(spark, target, second, KEYS, "date", "fetched_at")) == want
    assert sorted(p.name for p in (tmp_path / "t" / "merge=0" / "period=2023-12-01").iterdir()) == untouched


def test_first_batch_is_reduced_to_one_row_per_key(spark, tmp_path):
    got = upsert(spark, str(tmp_path / "t"), _bars(spark, [("a", "2024-01-01", 1.0, 2), ("a", "2024-01-01", 5.0, 1)]), KEYS, "date", "fetched_at")
    assert _rows(got) == [("a", "2024-01-01", 1.0)]


def test_null_keys_are_added_every_time(spark, tmp_path):
    batch = _bars(spark, [(None, "2024-01-01", 1.0, 1), ("a", None, 2.0, 1), ("a", "2024-01-01", 3.0, 1)])
    for n in (3, 5, 7):
        assert upsert(spark, str(tmp_path / "t"), batch, KEYS, "date", "fetched_at").count() == n


def test_null_overwrites_unless_told_otherwise(spark):
    target = _bars(spark, [("a", "2024-01-01", 1.0, 1)])
    update = _bars(spark, [("a", "2024-01-01", None, 2)])
    assert _rows(merge_rows(target, update, KEYS)) == [("a", "2024-01-01", None)]
    assert _rows(merge_rows(target, update, KEYS, keep_non_null=True)) == [("a", "2024-01-01", 1.0)]


def test_overlapping_batches_equal_one(spark, tmp_path):
    rows = [(s, f"2024-0{m}-0{d}", float(m * d), 1) for s in "ab" for m in (1, 2, 3) for d in (1, 2, 3)]
    for part in (rows[:8], rows[4:14], rows[10:]):
        got = upsert(spark, str(tmp_path / "t"), _bars(spark, part), KEYS, "date", "fetched_at")
    assert _rows(got) == _rows(_bars(spark, rows))


def test_key_must_hold_the_date(spark, tmp_path):
    with pytest.raises(ValueError):
        upsert(spark, str(tmp_path / "t"), _bars(spark, []), ["symbol"], "date")


def test_snapshot_replaces_rows_and_schema(spark):
    tables.ensure_namespace(spark, "bronze")
    for df in (spark.range(3), spark.range(2).select(F.lit("x").alias("name"))):
        tables.write_snapshot(df, "bronze.feed")
    assert tables.find_table(spark, "bronze.feed") is not None and tables.find_table(spark, "bronze.nothing") is None
    assert tables.read_table(spark, "bronze.feed").columns == ["name"]
    counts = tables.row_counts({"feed": tables.read_table(spark, "bronze.feed"), "none": spark.range(0)})
    assert {r.table: r.rows for r in counts.collect()} == {"feed": 2, "none": 0}
    assert tables.heads({"feed": spark.range(20)})["feed"].count() == 5


def test_pretty_printed_documents(spark, tmp_path):
    docs = [
        {"records": [{"symbol": "a", "date": "2024-01-02", "open": 1.5}, {"symbol": "b", "date": "2024-01-02", "open": None}], "fetched_at": "2024-01-03T06:00:00+00:00"},
        {"records": [], "fetched_at": "2024-01-04T06:00:00+00:00"},
    ]
    for i, doc in enumerate(docs):
        (tmp_path / f"bars{i}.json").write_text(json.dumps(doc, indent=2))
    schema = "records array<struct<symbol string, date string, open double>>, fetched_at string"
    rows = landing.explode_records(landing.read_landing(spark, f"{tmp_path}/bars*.json", schema))
    typed = landing.type_cols(rows, {"symbol": "string", "date": "date", "open": "double", "fetched_at": "timestamp"})
    assert sorted((r.symbol, r.date, r.open, r.fetched_at.hour) for r in typed.collect()) == [("a", D("2024-01-02"), 1.5, 6), ("b", D("2024-01-02"), None, 6)]


def test_a_broken_document_fails_loudly(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"records": [{"symbol": "a"')
    with pytest.raises(Exception, match="(?i)malformed"):
        landing.read_landing(spark, f"{tmp_path}/x.json", "records array<struct<symbol string>>").collect()


def test_named_structs_are_discovered(spark, tmp_path):
    doc = {"cpi": {"date": "2024-01-01", "value": 3.1}, "10y.yield/x": {"date": "2024-01-02", "value": None}, "fetched_at": "2024-01-03T00:00:00+00:00"}
    (tmp_path / "m.json").write_text(json.dumps(doc, indent=2))
    got = landing.melt_structs(landing.read_landing_text(spark, f"{tmp_path}/m.json"), "date string, value double", "series")
    assert sorted((r.series, r.date, r.value) for r in got.collect()) == [("10y.yield/x", "2024-01-02", None), ("cpi", "2024-01-01", 3.1)]


def test_lenient_typing(spark):
    df = spark.createDataFrame([("x", "1.5")], "a string, b string")
    assert landing.type_cols(df, {"a": "double", "b": "double"}, strict=False).collect()[0].asDict() == {"a": None, "b": 1.5}


def test_published_array(spark, tmp_path):
    (tmp_path / "t.json").write_text(json.dumps([{"k": "a", "v": 1.0}, {"k": "b", "v": None}], indent=2))
    assert landing.read_published(spark, f"{tmp_path}/t.json", "k string, v double").count() == 2


def test_export_is_ordered_and_keeps_nulls(spark, tmp_path):
    rows = [("b", 2, float("nan")), ("a", 2, 1.5), ("a", 1, float("inf")), ("b", 1, None)]
    df = spark.createDataFrame(rows, "s string, d int, v double").withColumn("m", F.lit("1.25").cast("decimal(5,2)"))
    export_json(df.repartition(4), ["s", "d"], str(tmp_path / "out"))
    lines = [json.loads(x) for f in sorted((tmp_path / "out").glob("part-*")) for x in f.read_text().splitlines()]
    assert [(r["s"], r["d"], r["v"], r["m"]) for r in lines] == [("a", 1, None, 1.25), ("a", 2, 1.5, 1.25), ("b", 1, None, 1.25), ("b", 2, None, 1.25)]


def test_a_surviving_non_finite_value_fails(spark):
    df = spark.createDataFrame([(float("inf"),)], "v double")
    assert publishable(df).collect()[0].v is None
    with pytest.raises(Exception, match="non-finite"):
        C.require_finite(df).collect()


def test_row_rules(spark):
    df = spark.createDataFrame([(".", "2024013100", "a_b c", "x/y"), ("1.5", "20240201", "d", "x")], "v string, t string, l string, p string")
    got = df.select(C.null_marker("v").alias("v"), C.compact_date("t").alias("t"), C.spaced_label("l").alias("l"), C.short_label("p").alias("p")).collect()
    assert [tuple(r) for r in got] == [(None, D("2024-01-31"), "a b c", "y"), (1.5, D("2024-02-01"), "d", "")]


def test_settled_needs_every_price(spark):
    rows = [(1.0, 1.0, 1.0, 1.0, None), (None, 1.0, 1.0, 1.0, 5), (1.0, 1.0, float("nan"), 1.0, 5)]
    assert shaping.settled(spark.createDataFrame(rows, "open double, high double, low double, close double, volume long")).count() == 1


def test_last_n_and_missing(spark, series, days):
    df = series({"a": [(d, 1.0) for d in days("2024-01-01", 9)], "b": [("2024-01-01", 1.0)]})
    assert {r.symbol: r["count"] for r in shaping.last_n(df, "symbol", "date", 3).groupBy("symbol").count().collect()} == {"a": 3, "b": 1}
    expected = spark.createDataFrame([("a",), ("c",), ("c",)], "symbol string")
    assert [r.symbol for r in shaping.require_some(expected, df, "symbol").collect()] == ["c"]
    with pytest.raises(Exception, match="no rows"):
        shaping.require_some(expected, df.limit(0), "symbol").collect()


def test_classify_by_list_and_by_frame(spark):
    df = spark.createDataFrame([("i",), ("x",), ("q",)], "symbol string")
    lists = shaping.classify(df, "symbol", {"benchmark": ["i"], "sector": ["x"]})
    dim = spark.createDataFrame([("i", "benchmark"), ("x", "sector")], "symbol string, category string")
    want = {"i": "benchmark", "x": "sector", "q": "basket"}
    assert {r.symbol: r.category for r in lists.collect()} == want
    assert {r.symbol: r.category for r in shaping.classify(df, "symbol", dim).collect()} == want


def test_half_cents_round_up(spark):
    df = spark.createDataFrame([(1.005,), (2.675,), (1.004,)], "v double")
    assert [r.v for r in C.round_cols(df, ["v"]).collect()] == [1.01, 2.68, 1.0]


def test_partial_columns_keep_the_others(spark, tmp_path):
    target = str(tmp_path / "t")
    first = _bars(spark, [("a", "2024-01-01", 1.0, 1), ("b", "2024-01-02", 2.0, 1)]).withColumn("volume", F.lit(5))
    upsert(spark, target, first, KEYS, "date")
    update = _bars(spark, [("a", "2024-01-01", 9.0, 2), ("c", "2024-01-03", 3.0, 2)])
    with pytest.raises(ValueError, match="volume"):
        upsert(spark, target, update, KEYS, "date")
    got = upsert(spark, target, update, KEYS, "date", "fetched_at", columns=["close"])
    assert sorted((r.symbol, r.close, r.fetched_at, r.volume) for r in got.filter("symbol < 'c'").collect()) == [("a", 9.0, 1, 5), ("b", 2.0, 1, 5)]
    assert [(r.close, r.volume) for r in got.filter("symbol = 'c'").collect()] == [(3.0, None)]
    shared = spark.conf.get("spark.checkpoint.dir")
    assert not glob.glob(f"{shared}/seriesframe/*/updates-*")


def test_catalog_tables_are_merged(spark):
    name = "merged_bars"
    for n, rows in enumerate(([("a", "2024-01-01", 1.0, 1), ("a", "2024-02-01", 2.0, 1)], [("a", "2024-01-01", 5.0, 2)], [("b", "2024-03-01", 3.0, 3)])):
        got = upsert(spark, name, _bars(spark, rows), KEYS, "date", "fetched_at")
    assert sorted((r.symbol, r.date.month, r.close) for r in got.collect()) == [("a", 1, 5.0), ("a", 2, 2.0), ("b", 3, 3.0)]


OLD = [("a", 1, 1.0), ("a", 2, 2.0), ("a", 3, 3.0)]
NEW = [("a", 1, 5.0), ("a", 2, 2.0), ("a", 3, 6.0), ("b", 1, 7.0)]


def _merged(spark, target):
    rows = [("a", "2024-01-01", 5.0, 2), ("b", "2024-01-05", 7.0, 2), ("a", "2024-03-01", 6.0, 2)]
    return upsert(spark, target, _bars(spark, rows), KEYS, "date", "fetched_at")


def _seen(spark, target):
    return sorted((r.symbol, r.date.month, r.close) for r in read_table(spark, target).collect())


class Lost(Exception):
    pass


def _stops_at(monkeypatch, cls, method, n):
    """The n-th call of a method, from 0, raises instead."""
    calls, real = iter(range(1000)), getattr(cls, method)

    def call(self, *args, **kwargs):
        if next(calls) == n:
            raise Lost
        return real(self, *args, **kwargs)

    monkeypatch.setattr(cls, method, call)


@pytest.mark.parametrize("kind", ["path", "catalog"])
@pytest.mark.parametrize("step", ["no success", "delete 0", "delete 1", "sql 1", "sql 3", "sql 5"])
def test_a_driver_lost_between_steps_leaves_the_old_or_the_new_table(spark, tmp_path, monkeypatch, step, kind):
    target = str(tmp_path / "t") if kind == "path" else f"lost_{step.replace(' ', '_')}"
    first = [(s, f"2024-0{m}-01", v, 1) for s, m, v in OLD]
    upsert(spark, target, _bars(spark, first), KEYS, "date", "fetched_at")
    with monkeypatch.context() as patch:
        if step == "no success":
            real = upserts._write_periods

            def cut_off(*args):
                os.remove(f"{real(*args).removeprefix('file:')}/_SUCCESS")
                raise Lost

            patch.setattr(upserts, "_write_periods", cut_off)
        elif step.startswith("sql"):
            _stops_at(patch, type(spark), "sql", int(step[4:]))
        else:
            _stops_at(patch, Folder, "delete", int(step[7:]))
        try:
            _merged(spark, target)
        except Lost:
            pass
    spark.catalog.refreshTable(target) if kind == "catalog" else None
    seen = _seen(spark, target)
    if kind == "path":
        assert seen in (OLD, NEW)
    else:  # whole periods, one by one
        assert all([r for r in seen if r[1] == m] in ([r for r in OLD if r[1] == m], [r for r in NEW if r[1] == m]) for m in (1, 2, 3))
    assert sorted((r.symbol, r.date.month, r.close) for r in _merged(spark, target).collect()) == _seen(spark, target) == NEW
    if kind == "path":
        assert len(spark.read.parquet(target).collect()) == len(NEW)  # nothing that was replaced is left


def _files(df):
    return {r[0] for r in df.select(F.input_file_name()).collect()}


def test_new_columns_do_not_rewrite_old_periods(spark, tmp_path):
    for target in (str(tmp_path / "t"), "evolving_bars"):
        upsert(spark, target, _bars(spark, [(s, f"2024-0{m}-01", v, 1) for s, m, v in OLD]), KEYS, "date", "fetched_at")
        wide = _bars(spark, [("a", "2024-03-01", 6.0, 2), ("c", "2024-03-02", 8.0, 2)]).withColumn("note", F.lit("new"))
        with pytest.raises(ValueError, match="note"):
            upsert(spark, target, wide, KEYS, "date", "fetched_at")
        old = _files(read_table(spark, target).filter("month(date) < 3"))
        got = upsert(spark, target, wide, KEYS, "date", "fetched_at", evolve=True)
        want = [("a", 1, None), ("a", 2, None), ("a", 3, "new"), ("c", 3, "new")]
        for table in (got, read_table(spark, target)):
            assert sorted((r.symbol, r.date.month, r.note) for r in table.collect()) == want
        assert _files(got.filter("month(date) < 3")) == old
        again = upsert(spark, target, _bars(spark, [("a", "2024-01-01", 9.0, 3)]).withColumn("note", F.lit("late")), KEYS, "date", "fetched_at")
        assert sorted((r.symbol, r.date.month, r.note) for r in again.collect()) == [("a", 1, "late"), *want[1:]]


def test_a_plain_table_takes_merges(spark, tmp_path):
    from seriesframe.operators.panels import trail

    target = str(tmp_path / "t")
    write_table(_bars(spark, [(s, f"2024-0{m}-01", v, 1) for s, m, v in OLD] + [("n", None, 0.0, 1)]), target, "date", "month")
    _merged(spark, target)
    assert sorted((r.symbol, r.close) for r in read_table(spark, target).collect()) == sorted([(s, v) for s, _, v in NEW] + [("n", 0.0)])
    assert {f.name for f in os.scandir(target) if f.is_dir()} == {"merge=0"}
    plan = trail(read_table(spark, target), "date", 7)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*period#\d+ >= trunc", plan)  # the mark is kept in the files
    empty = upsert(spark, str(tmp_path / "e"), _bars(spark, []), KEYS, "date")
    assert empty.count() == 0 and _merged(spark, str(tmp_path / "e")).count() == 3


def test_broken_published_rows_fail(spark, tmp_path):
    (tmp_path / "t.json").write_text('{"k": "a", "v": 1.0}\n{"k": "b", "v": "x"}\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        landing.read_published(spark, f"{tmp_path}/t.json", "k string, v double", array_file=False).collect()


def _joined(folder):
    return "".join((folder / f).read_text() for f in sorted(os.listdir(folder)) if f.startswith("part-"))


def test_array_parts_are_one_array(spark, tmp_path):
    rows = [(s, i, None if i % 3 else i / 2) for s in "ba" for i in range(40)] + [("a", 0, 0.0)] * 2 + [(None, 1, float("nan"))] * 2
    df = spark.createDataFrame(rows, "s string, i int, v double")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        export_json_array(df.repartition(5), ["s", "i"], str(tmp_path / "out"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len([f for f in os.listdir(tmp_path / "out") if f.startswith("part-")]) > 1
    got = json.loads(_joined(tmp_path / "out"))
    want = sorted(((s, i, None if v is None or v != v else v) for s, i, v in rows), key=lambda r: (r[0] is not None, r[0] or "", r[1]))
    assert [(r["s"], r["i"], r["v"]) for r in got] == want
    (tmp_path / "one.json").write_text(_joined(tmp_path / "out"))
    schema = "s string, i int, v double"
    assert landing.read_published(spark, str(tmp_path / "one.json"), schema).count() == len(rows)
    assert sorted(map(tuple, landing.read_array_parts(spark, str(tmp_path / "out"), schema).collect()), key=repr) == sorted(want, key=repr)
    export_json_array(df.limit(0), ["s"], str(tmp_path / "none"))
    assert json.loads(_joined(tmp_path / "none")) == []
    assert landing.read_array_parts(spark, str(tmp_path / "none"), schema).count() == 0


def test_broken_documents_are_set_aside(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for name, text in {"a": '{"v": 1,\n "w": "x"}', "b": '{"v": 1, "w"', "c": '{"v": "no number", "w": "y"}', "d": '{"v": 2}'}.items():
        (tmp_path / "in" / f"{name}.json").write_text(text)
    good = landing.land_documents(spark, f"{tmp_path}/in", "v int, w string", f"{tmp_path}/out")
    assert sorted(map(tuple, good.collect())) == [(1, "x"), (2, None)]
    bad = landing.broken_documents(spark, f"{tmp_path}/out").collect()
    assert sorted((r.file[-6:], r.corrupt_record[:9]) for r in bad) == [("b.json", '{"v": 1, '), ("c.json", '{"v": "no')]
    texts = landing.land_texts(spark, f"{tmp_path}/in", f"{tmp_path}/texts")
    assert texts.count() == 3 and [r.file[-6:] for r in landing.broken_documents(spark, f"{tmp_path}/texts").collect()] == ["b.json"]
    with pytest.raises(landing.AllBroken, match="1 documents"):
        landing.land_documents(spark, f"{tmp_path}/in/b.json", "v int, w string", f"{tmp_path}/bad")
    assert landing.broken_documents(spark, f"{tmp_path}/bad").count() == 1


def test_a_table_that_is_not_gathered_is_not_shuffled(spark, tmp_path):
    """Same rows, same period partitions and mark, no shuffle before the write."""
    rows = [(s, f"{y}-0{1 + i % 9}-11", float(i), 1) for i in range(30) for s in "abc" for y in (1999, 2001)] + [("a", None, 1.0, 1)]
    bars = _bars(spark, rows).repartition(3)
    first = write_table(bars, str(tmp_path / "a"), "date", cluster=("symbol",))
    second = write_table(bars, str(tmp_path / "b"), "date", cluster=("symbol",), gather=False)
    assert sorted(map(repr, first.collect())) == sorted(map(repr, second.collect()))
    assert first.schema == second.schema and tables.grain_of(second, "date") == "year"
    files = [len(glob.glob(f"{tmp_path}/{x}/period=1999-01-01/*.parquet")) for x in "ab"]
    assert files[0] == 1 and files[1] == 3
