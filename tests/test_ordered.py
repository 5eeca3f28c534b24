"""Split windows against the plain windows they stand for."""

import random
import statistics
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from seriesframe.functions.ordered import rolling, with_position, with_prev, with_running
from seriesframe.functions.quantiles import exact_median


@pytest.fixture(scope="module")
def history(spark):
    rng = random.Random(7)
    rows = []
    for ent, n in (("hot", 400), ("a", 40), ("b", 1), (None, 30)):
        for i in rng.sample(range(4000), n):
            rows.append((ent, date(1995, 1, 1) + timedelta(days=i), rng.choice([None, *[rng.random() for _ in range(6)]])))
    return spark.createDataFrame(rows, "ent string, dt date, v double").cache()


def _same(a, b, places=None):
    def key(rows):
        return sorted([tuple(round(x, places) if places and isinstance(x, float) else x for x in r) for r in rows], key=repr)

    assert key(a.collect()) == key(b.collect())


def test_prev_equals_lag(history):
    w = Window.partitionBy("ent").orderBy("dt")
    _same(
        with_prev(history, "ent", "dt", {"pv": "v", "pd": "dt"}).select("ent", "dt", "v", "pv", "pd"),
        history.select("ent", "dt", "v", F.lag("v").over(w), F.lag("dt").over(w)),
    )


def test_prev_without_entity(history):
    days = history.groupBy("dt").agg(F.max("v").alias("v"))
    w = Window.orderBy("dt")
    _same(with_prev(days, None, "dt", {"p": "v"}).select("dt", "v", "p"), days.select("dt", "v", F.lag("v").over(w)))


def test_prev_over_timestamps(spark):
    rows = [("x", datetime(2024, 1, 1) + timedelta(hours=5 * i), float(i)) for i in range(60)]
    df = spark.createDataFrame(rows, "ent string, ts timestamp, v double")
    w = Window.partitionBy("ent").orderBy("ts")
    _same(with_prev(df, "ent", "ts", {"p": "v"}).select("ent", "ts", "v", "p"), df.select("ent", "ts", "v", F.lag("v").over(w)))


def test_position_equals_row_number(history):
    w = Window.partitionBy("ent").orderBy("dt")
    _same(
        with_position(history, "ent", "dt", "pos").select("ent", "dt", "pos"),
        history.select("ent", "dt", (F.row_number().over(w) - 1).alias("pos")),
    )


def test_running_sum_and_product(history):
    w = Window.partitionBy("ent").orderBy("dt").rowsBetween(Window.unboundedPreceding, 0)
    got = with_running(history, "ent", "dt", {"s": ("sum", F.col("v")), "p": ("product", 1 + F.col("v") / 100)})
    _same(
        got.select("ent", "dt", "s", "p"),
        history.select("ent", "dt", F.sum("v").over(w), F.product(1 + F.col("v") / 100).over(w)),
        places=9,
    )


@pytest.mark.parametrize("block", [1, 5, 7, 64])
def test_rolling_in_blocks(history, block):
    placed = with_position(history, "ent", "dt", "pos")
    w = Window.partitionBy("ent").orderBy("dt").rowsBetween(-4, 0)
    got = rolling(placed, "ent", "pos", 5, lambda f: {"n": F.count("v").over(f), "m": F.max("v").over(f)}, block)
    _same(got.select("ent", "dt", "n", "m"), history.select("ent", "dt", F.count("v").over(w), F.max("v").over(w)))


@pytest.mark.parametrize(
    "values",
    [[1.0], [1.0, 2.0], [3.0, 1.0, 2.0], [5.0] * 9 + [1.0, 100.0], [-1e9, -2.5, 0.0, 1e-9, 1e300, 7.0], [0.1 * i for i in range(-50, 51)]],
)
def test_exact_median(spark, values):
    df = spark.createDataFrame([("g", v) for v in values] + [("g", None), ("h", 4.0)], "g string, v double")
    got = {r.g: r.m for r in exact_median(df, "g", "v", "m").collect()}
    assert got == {"g": statistics.median(values), "h": 4.0}
