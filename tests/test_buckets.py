"""Windows over bucketed tables against the same windows over plain ones, and their plans."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from seriesframe.functions.ordered import CHUNK, bucketed
from seriesframe.operators.returns import returns, rolling_vol
from seriesframe.sources.buckets import write_bucketed


@pytest.fixture(scope="module")
def bars(spark):
    """An entity with a third of the rows, one with a row every few years, repeated values and NULLs."""
    draw = random.Random(5)
    rows = [("hot", date(2018, 1, 1) + timedelta(days=3 * i), draw.choice([1.0, 2.0, 3.5, None])) for i in range(400)]
    rows += [("rare", date(1990 + i, 6, 1), float(i + 1)) for i in range(30)]
    rows += [(f"s{i % 7}", date(2019, 11, 1) + timedelta(days=i), 10.0 + draw.random()) for i in range(300)]
    return spark.createDataFrame(rows + [(None, date(2020, 1, 1), 4.0)], "symbol string, date date, close double")


def rows_of(df):
    return sorted(((r[0] or "", *r[1:-1], None if r[-1] is None else round(r[-1], 9)) for r in df.collect()), key=repr)


def chain(df):
    return rolling_vol(returns(df, "symbol", "date", "close"), "symbol", "date", n=5)


def test_chain_equals_the_plain_one(spark, bars):
    table = write_bucketed(bars, "bucketed_bars", "symbol", "date", 6)
    assert bucketed(table, ["symbol"], "date") == 6 and bucketed(table, ["close"]) is None
    assert bucketed(table.drop(CHUNK), ["symbol"]) is None
    got = returns(table, "symbol", "date", "close").drop(CHUNK)
    assert rows_of(got) == rows_of(returns(bars, "symbol", "date", "close"))
    assert rows_of(chain(table)) == rows_of(chain(bars))
    empty = write_bucketed(bars.filter("false"), "no_bars", "symbol", "date", 3)
    assert chain(empty).count() == 0


def test_rows_are_not_shuffled(spark, bars):
    table = write_bucketed(bars, "bucketed_plan", "symbol", "date", 6)
    node = chain(table)._jdf.queryExecution().executedPlan().inputPlan()
    path = []
    while True:
        path.append(node.nodeName())
        if not node.children().size():
            break
        node = node.children().head()
    assert path.count("Window") >= 3 and path.count("Union") == 3
    assert not [x for x in path if "Exchange" in x] and path[-1].startswith("Scan parquet")


def test_sparse_entities_are_not_cut(spark, bars):
    """An entity with few rows has one chunk, however many years they span; others have whole calendar chunks in order."""
    table = write_bucketed(bars, "bucketed_sparse", "symbol", "date", 6, 200)
    chunks = {(r.symbol, r[CHUNK]): r for r in table.groupBy("symbol", CHUNK).agg(F.min("date").alias("a"), F.max("date").alias("b"), F.count("*").alias("n")).collect()}
    per = {}
    for (symbol, _), r in sorted(chunks.items(), key=lambda x: (x[0][0] or "", x[0][1])):
        per.setdefault(symbol, []).append(r)
    assert len(per["rare"]) == 1 and len(per[None]) == 1 and len(per["s0"]) == 1 and len(per["hot"]) == 2
    assert per["hot"][0].b.year < per["hot"][1].a.year and sum(r.n for r in per["hot"]) == 400
    assert rows_of(chain(table)) == rows_of(chain(bars))
    for rows in (1, 50, 5000):
        assert rows_of(chain(write_bucketed(bars, f"bucketed_by_{rows}", "symbol", "date", 3, rows))) == rows_of(chain(bars))


def test_rows_without_a_date_keep_their_chunk(spark, bars):
    undated = bars.filter("symbol in ('hot', 'rare', 's1')").unionByName(spark.createDataFrame([("hot", None, 9.0), ("rare", None, 8.0), ("rare", None, 8.5)], bars.schema))
    want = [r for r in rows_of(returns(undated, "symbol", "date", "close")) if r[1]]
    for rows in (1, 200, 5000):
        table = write_bucketed(undated, f"bucketed_undated_{rows}", "symbol", "date", 3, rows)
        assert table.filter("date is null").select(CHUNK).distinct().count() == 1
        assert [r for r in rows_of(returns(table, "symbol", "date", "close").drop(CHUNK)) if r[1]] == want
        assert rows_of(chain(table).filter("date is not null")) == rows_of(chain(undated).filter("date is not null"))
