"""Run a registered query on Spark and its SQL on DuckDB and compare the rows."""

from __future__ import annotations

import math

import duckdb
from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def _cell(v) -> str:
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "null"
    if isinstance(v, float):
        return repr(v + 0.0)
    return str(v)


def _rows(names, rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(got: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Empty when names, types' families and values agree."""
    want = con.execute(sql)
    names = [d[0] for d in want.description]
    if sorted(names) != sorted(got.columns):
        return [f"columns {sorted(got.columns)} != {sorted(names)}"]
    a = _rows(got.columns, [tuple(r) for r in got.collect()])
    b = _rows(names, want.fetchall())
    if a == b:
        return []
    only_a, only_b = sorted(set(a) - set(b)), sorted(set(b) - set(a))
    return [f"rows {len(a)} vs {len(b)}", f"columns {sorted(names)}"] + [
        f"spark {x}" for x in only_a[:4]
    ] + [f"sql   {x}" for x in only_b[:4]]


def session(name: str = "compare", cores: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
