"""Business days over a holiday week."""

from datetime import date, datetime

from pyspark.sql import functions as F

from seriesframe.operators import business_days as b

D = date.fromisoformat


def test_a_holiday_week(spark):
    closed = spark.createDataFrame([(D("2024-01-01"),), (D("2024-01-01"),), (D("2024-01-06"),)], "day date")
    calendar = b.business_calendar(spark, "2023-12-28", "2024-01-10", closed)
    rows = [
        (1, datetime(2024, 1, 2, 12), D("2023-12-29")),  # before the close on the day after the holiday
        (2, datetime(2024, 1, 2, 22), D("2023-12-29")),
        (3, datetime(2024, 1, 1, 23), D("2023-12-28")),
        (4, datetime(2024, 1, 8, 3), D("2024-01-05")),  # the weekend counts once, its holiday too
        (5, datetime(2024, 1, 10, 23), None),
        (6, datetime(2030, 1, 1, 3), D("2024-01-05")),
        (7, None, D("2024-01-05")),
    ]
    df = spark.createDataFrame(rows, "id int, ts timestamp_ntz, latest date")
    got = b.with_business_gap(b.with_expected(df, "ts", calendar), "latest", "expected", calendar)
    got = {r.id: (r.expected, r.gap, r.s) for r in got.withColumn("s", b.business_status(F.col("gap"))).collect()}
    assert got == {
        1: (D("2023-12-29"), 0, "FRESH"),
        2: (D("2024-01-02"), 1, "STALE"),
        3: (D("2023-12-29"), 1, "STALE"),
        4: (D("2024-01-05"), 0, "FRESH"),
        5: (D("2024-01-10"), None, "NO DATA"),
        6: (None, None, "NO DATA"),
        7: (None, None, "NO DATA"),
    }
