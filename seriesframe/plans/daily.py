"""The daily job: landed documents -> bronze -> silver -> gold -> published JSON.

    spark-submit -m seriesframe.plans.daily LANDING LAKE PUBLISHED

LANDING holds one JSON document per feed (or a folder of documents per feed), LAKE the
tables, PUBLISHED the ordered JSON of every gold table.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesframe.operators.indexing import index_to_first
from seriesframe.operators.returns import basket_vs_benchmark, market_daily, rolling_vol, trend
from seriesframe.operators.shaping import settled
from seriesframe.sources.export import export_json
from seriesframe.sources.landing import BROKEN, explode_records, land_documents, land_texts, melt_structs, type_cols
from seriesframe.sources.tables import read_table, write_table
from seriesframe.sources.upsert import upsert
from seriesframe.sources.workspace import utc

# Document layouts and table types of the feeds.
BARS_DOCUMENT = (
    "records array<struct<symbol string, category string, date string, open double, high double,"
    " low double, close double, volume bigint>>, fetched_at string"
)
BAR_TYPES = {
    "symbol": "string",
    "category": "string",
    "date": "date",
    "open": "double",
    "high": "double",
    "low": "double",
    "close": "double",
    "volume": "long",
    "fetched_at": "timestamp",
}


@dataclass(frozen=True)
class NamedFeed:
    """A feed whose documents hold one struct per entity name."""

    feed: str
    entity: str
    fields: str
    types: dict
    dt: str


NAMED_FEEDS = [
    NamedFeed("macro_data", "series", "date string, value double", {"date": "date", "value": "double"}, "date"),
    NamedFeed("attention_data", "article", "date string, views bigint", {"date": "date", "views": "long"}, "date"),
    NamedFeed("dev_momentum", "repo", "stars bigint", {"stars": "long"}, "snapshot_date"),
    NamedFeed("research_pace", "category", "count bigint", {"count": "long"}, "snapshot_date"),
]

# The order in which each gold table is published.
PUBLISHED_ORDER = {
    "market_daily": ["symbol", "date"],
    "sector_rotation": ["symbol", "date"],
    "volatility": ["date"],
    "macro_snapshot": ["series", "date"],
    "basket_vs_benchmark": ["date"],
    "basket_detail": ["symbol", "date"],
    "attention_index": ["article", "date"],
    "dev_momentum": ["repo", "snapshot_date"],
    "research_pace": ["category", "snapshot_date"],
}


def to_bronze(spark: SparkSession, landing: str, lake: str) -> None:
    """Every feed's documents as landed, replacing the previous run's.

    Broken documents are kept beside the others (`broken_documents`); a feed without a good one fails the run.
    """
    land_documents(spark, f"{landing}/market_data*", BARS_DOCUMENT, f"{lake}/bronze/market_data")
    for feed in NAMED_FEEDS:
        land_texts(spark, f"{landing}/{feed.feed}*", f"{lake}/bronze/{feed.feed}")


def to_silver(spark: SparkSession, lake: str) -> None:
    """Typed rows of this run merged into the keyed history."""

    def bronze(feed: str) -> DataFrame:
        return read_table(spark, f"{lake}/bronze/{feed}").filter(~F.col(BROKEN))

    bars = type_cols(explode_records(bronze("market_data")), BAR_TYPES)
    upsert(spark, f"{lake}/silver/market_data", settled(bars), ["symbol", "date"], "date", "fetched_at")
    for feed in NAMED_FEEDS:
        rows = melt_structs(bronze(feed.feed), feed.fields, feed.entity)
        typed = type_cols(rows, {feed.entity: "string", **feed.types, "fetched_at": "timestamp"})
        if feed.dt not in typed.columns:
            typed = typed.withColumn(feed.dt, F.to_date("fetched_at"))
        upsert(spark, f"{lake}/silver/{feed.feed}", typed, [feed.entity, feed.dt], feed.dt, "fetched_at")


def to_gold(
    spark: SparkSession, lake: str, basket: str = "ai_basket", sector: str = "sector", benchmark: str = "benchmark"
) -> dict[str, DataFrame]:
    """Rebuild the nine gold tables; returns are computed once and shared."""

    def silver(name: str) -> DataFrame:
        return read_table(spark, f"{lake}/silver/{name}")

    def gold(name: str, df: DataFrame, dt: str, ent: str | None = None) -> DataFrame:
        return write_table(df, f"{lake}/gold/{name}", dt, "month", (ent,) if ent else ())

    bars = gold("market_daily", market_daily(silver("market_data"), prev_dt="prev_date"), "date", "symbol")
    slim = bars.select("symbol", "category", "date", "volume", "daily_return")

    def of(category: str) -> DataFrame:
        return slim.filter(F.col("category") == category)

    detail = ["symbol", "date", "volume", "daily_return"]
    vol = rolling_vol(of(benchmark), "symbol", "date", out="rolling_20d_volatility")
    macro = silver("macro_data").select("series", "date", "value")
    attention = silver("attention_data").select("article", "date", "views")
    return {
        "market_daily": bars,
        "sector_rotation": gold("sector_rotation", of(sector).select(*detail), "date", "symbol"),
        "volatility": gold("volatility", vol, "date"),
        "macro_snapshot": gold("macro_snapshot", trend(macro, "series", "date", "value"), "date", "series"),
        "basket_vs_benchmark": gold(
            "basket_vs_benchmark", basket_vs_benchmark(slim, basket=basket, benchmark=benchmark), "date"
        ),
        "basket_detail": gold("basket_detail", of(basket).select(*detail), "date", "symbol"),
        "attention_index": gold(
            "attention_index", index_to_first(attention, "article", "date", "views", "attention_index"), "date", "article"
        ),
        "dev_momentum": gold(
            "dev_momentum", silver("dev_momentum").select("repo", "snapshot_date", "stars"), "snapshot_date", "repo"
        ),
        "research_pace": gold(
            "research_pace",
            silver("research_pace").select("category", "snapshot_date", "count"),
            "snapshot_date",
            "category",
        ),
    }


def publish(gold: dict[str, DataFrame], folder: str) -> None:
    for name, df in gold.items():
        export_json(df.drop("period", "prev_date"), PUBLISHED_ORDER[name], f"{folder}/{name}")


def run(spark: SparkSession, landing: str, lake: str, published: str | None = None) -> dict[str, DataFrame]:
    utc(spark)
    to_bronze(spark, landing, lake)
    to_silver(spark, lake)
    gold = to_gold(spark, lake)
    if published:
        publish(gold, published)
    return gold


def main() -> None:
    landing, lake, published = sys.argv[1:4]
    run(SparkSession.builder.appName("daily").getOrCreate(), landing, lake, published)


if __name__ == "__main__":
    main()
