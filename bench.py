"""Time the registered queries and print one JSON line.

BENCH_SF_DIR   data folder (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_QUERIES  comma-separated names (default: all)
BENCH_REPEAT   runs per query (default 1); from 2 on, `warm` holds the best of the later runs
BENCH_PLANS=1  adds the shuffles in each query's executed plan and how many of them go to one task

`silver_gold_build` is the time to write the derived tables the other queries read; every
query is run once in a session that has them, its whole result going to the no-op sink.
"""

from __future__ import annotations

import json
import os
import re
import time

from pyspark.sql import DataFrame, SparkSession

from seriesframe.plans.lake import Lake
from seriesframe.plans.queries import QUERIES


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def build_tables(spark: SparkSession, sf_dir: str) -> None:
    lake = Lake(spark, sf_dir)
    for table in (lake.market_daily, lake.volatility, lake.spread, lake.indicators, lake.attention, lake.levels):
        table()
    lake.trailing_counts()
    lake.part_daily()


def timed(spark: SparkSession, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 2)


def exchanges(df: DataFrame) -> list[int]:
    """Shuffles of the plan that ran, and those among them with a single target task."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    kinds = re.findall(r" Exchange (\w+)", plan)
    return [len(kinds), kinds.count("SinglePartition")]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(QUERIES)
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    spark.range(1000).selectExpr("sum(id)").collect()

    took: dict[str, float] = {}
    start = time.perf_counter()
    build_tables(spark, sf_dir)
    took["silver_gold_build"] = round(time.perf_counter() - start, 2)
    warm: dict[str, float] = {}
    plans: dict[str, list[int]] = {}
    repeat = int(os.environ.get("BENCH_REPEAT", "1"))
    for name in names:
        runs = [timed(spark, name, sf_dir) for _ in range(repeat)]
        took[name] = runs[0]
        if repeat > 1:
            warm[name] = min(runs[1:])
        if os.environ.get("BENCH_PLANS"):
            plans[name] = exchanges(QUERIES[name](spark, sf_dir))
    line = {
        "metric": "total wall time of all queries",
        "value": round(sum(took.values()), 3),
        "unit": "sec",
        "queries": took,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    if warm:
        line["warm"] = warm
    if plans:
        line["shuffles_and_single"] = plans
    print(json.dumps(line, separators=(",", ":")))
    spark.stop()


if __name__ == "__main__":
    main()
