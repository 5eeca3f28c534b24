"""The sample tables seen as market-style history, and the tables derived from them.

The sample data has no market feed, so brands play the symbols, order priorities the
indicators, order states the attention topics and event types the counters. Each derived
table is written once per application under the shared folder and read from there, as
the daily job does with its silver and gold tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from seriesframe.operators.returns import basket_vs_benchmark, market_daily, rolling_vol
from seriesframe.operators.shaping import classify, running_level, trailing_count
from seriesframe.sources.tables import read_table, write_table
from seriesframe.sources.workspace import new_path, utc

# Which entity plays which role.
BENCHMARK = "Brand#1"
SECTORS = [f"Brand#{i}" for i in range(2, 13)]
CORE = [f"Brand#{i}" for i in range(13, 19)]
INFRA = [f"Brand#{i}" for i in range(19, 26)]
LEGACY = ["Brand#13", "Brand#14", "Brand#15"]
YIELD_SERIES = "1-URGENT"
MONTHLY_SERIES = ["2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
TOPICS = ["F", "O", "P"]

_written: dict[tuple[str, str, str], tuple[str, StructType]] = {}


def source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bars_of(lineitem: DataFrame, symbols: DataFrame, by_part: bool = False) -> DataFrame:
    """Daily bars per symbol from priced line items; `symbols` has l_partkey and symbol.

    Open and close are the first and last price of the day in item order, found by
    aggregates so that one busy day needs no single task. `by_part` says that every part is a
    symbol of its own: the part is then a key too, by which a join that shuffles leaves the rows
    where the aggregate takes them, and no part of the order.
    """
    price = (F.lit(100) + F.col("l_extendedprice") / F.lit(10000)).alias("price")
    keys = ["l_partkey", "symbol", "date"] if by_part else ["symbol", "date"]
    order = ["l_orderkey", "l_linenumber", *([] if by_part else ["l_partkey"]), "l_suppkey"]
    ticks = lineitem.join(symbols, "l_partkey").select(
        *keys[:-1],
        F.col("l_shipdate").cast("date").alias("date"),
        F.col("l_quantity").alias("qty"),
        F.struct(*order, price).alias("at"),
    )
    bars = ticks.groupBy(*keys).agg(
        F.min("at")["price"].alias("open"),
        F.max("at.price").alias("high"),
        F.min("at.price").alias("low"),
        F.max("at")["price"].alias("close"),
        F.sum("qty").cast("long").alias("volume"),
    )
    labelled = classify(bars, "symbol", {"benchmark": [BENCHMARK], "sector": SECTORS})
    return labelled.select("symbol", "category", "date", "open", "high", "low", "close", "volume")


class Lake:
    """Derived tables of one data folder, built when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = utc(spark)
        self.sf_dir = sf_dir

    def raw(self, name: str) -> DataFrame:
        return source(self.spark, self.sf_dir, name)

    def _table(
        self, name: str, build: Callable[[], DataFrame], dt: str | None = None, cluster: tuple = (), gather: bool = True
    ) -> DataFrame:
        key = (self.spark.sparkContext.applicationId, self.sf_dir, name)
        if key not in _written:
            path = new_path(self.spark, name)
            _written[key] = path, write_table(build(), path, dt, cluster=cluster, gather=gather).schema
        return read_table(self.spark, *_written[key])

    def path(self, name: str) -> str:
        """Where a derived table lies, after it has been asked for."""
        return _written[(self.spark.sparkContext.applicationId, self.sf_dir, name)][0]

    # silver ------------------------------------------------------------------------------

    def bars(self) -> DataFrame:
        def build() -> DataFrame:
            part = self.raw("part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("symbol"))
            return bars_of(self.raw("lineitem"), part)

        return self._table("bars", build, "date", ("symbol",))

    def part_bars(self) -> DataFrame:
        """Bars with every part as its own symbol."""

        def build() -> DataFrame:
            key = F.col("p_partkey")
            part = self.raw("part").select(key.alias("l_partkey"), key.cast("string").alias("symbol"))
            return bars_of(self.raw("lineitem"), part, by_part=True)

        return self._table("part_bars", build, "date", ("symbol",), gather=False)

    def indicators(self) -> DataFrame:
        """Four monthly series and one daily one."""

        def build() -> DataFrame:
            day = F.col("o_orderdate").cast("date")
            when = F.when(F.col("o_orderpriority") == YIELD_SERIES, day).otherwise(F.trunc(day, "month"))
            return (
                self.raw("orders")
                .groupBy(F.col("o_orderpriority").alias("series"), when.alias("date"))
                .agg(F.max("o_totalprice").alias("value"))
            )

        return self._table("indicators", build, "date", ("series",))

    def attention(self) -> DataFrame:
        def build() -> DataFrame:
            return (
                self.raw("orders")
                .groupBy(F.col("o_orderstatus").alias("topic"), F.col("o_orderdate").cast("date").alias("date"))
                .agg(F.count(F.lit(1)).alias("views"))
            )

        return self._table("attention", build, "date", ("topic",))

    def _event_days(self) -> DataFrame:
        return self.raw("events").select(F.col("event_type"), "ts")

    def levels(self) -> DataFrame:
        def build() -> DataFrame:
            return running_level(self._event_days().withColumnRenamed("event_type", "entity"), "entity", "ts")

        return self._table("levels", build, "snapshot_date", ("entity",))

    def trailing_counts(self) -> DataFrame:
        def build() -> DataFrame:
            return trailing_count(self._event_days().withColumnRenamed("event_type", "category"), "category", "ts")

        return self._table("trailing_counts", build, "snapshot_date", ("category",))

    def run_log(self) -> DataFrame:
        """Events as pipeline runs: views are unfinished, errors are failures."""
        kind = F.col("event_type")
        done = F.when(kind == "view", None).when(kind == "error", "failure").otherwise("success")
        return self.raw("events").select(
            F.col("ts").cast("date").alias("date"),
            "ts",
            "event_id",
            kind.alias("event"),
            F.date_format("ts", "HH:mm").alias("time_utc"),
            done.alias("conclusion"),
            F.coalesce(done, F.lit("in_progress")).alias("status"),
        )

    def incidents(self) -> DataFrame:
        return self.raw("events").filter(F.col("event_type") == "error").select(
            F.col("ts").alias("opened"),
            "event_id",
            F.concat(F.lit("incident "), F.col("event_id").cast("string")).alias("title"),
            F.when(F.col("value") > 100, "open").otherwise("closed").alias("state"),
        )

    # gold --------------------------------------------------------------------------------

    def market_daily(self) -> DataFrame:
        """Bars with returns and the previous bar's date; every other gold table starts here."""
        return self._table(
            "market_daily", lambda: market_daily(self.bars(), prev_dt="prev_date"), "date", ("symbol",)
        )

    def part_daily(self) -> DataFrame:
        """Returns with every part as its own symbol."""
        returns = lambda: market_daily(self.part_bars(), prev_dt="prev_date")
        return self._table("part_daily", returns, "date", ("symbol",), gather=False)

    def sector(self) -> DataFrame:
        return self.market_daily().filter(F.col("category") == "sector")

    def basket(self) -> DataFrame:
        return self.market_daily().filter(F.col("category") == "basket")

    def benchmark(self) -> DataFrame:
        return self.market_daily().filter(F.col("category") == "benchmark")

    def volatility(self) -> DataFrame:
        return self._table("volatility", lambda: rolling_vol(self.benchmark(), "symbol", "date"), "date")

    def spread(self) -> DataFrame:
        return self._table("spread", lambda: basket_vs_benchmark(self.market_daily()), "date")

    def monthly_volumes(self) -> DataFrame:
        """A metric history: volume per symbol and month."""
        return (
            self.bars()
            .groupBy(F.trunc("date", "month").alias("snapshot_date"), F.col("symbol").alias("metric"))
            .agg(F.sum("volume").cast("double").alias("value"))
            .select("snapshot_date", F.lit("volume").alias("section"), "metric", "value")
        )
