"""Freshness of tables and series against their cadence, and the run log.

`as_of` is an explicit UTC timestamp column, never the clock.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesframe.functions.columns import utc_date, utc_hour
from seriesframe.functions.ordered import Keys, as_keys
from seriesframe.operators.shaping import latest
from seriesframe.sources.tables import read_table
from seriesframe.sources.workspace import new_path

# Close of the trading day in UTC, and the days a source may lag.
CLOSE_HOUR_UTC = 21
DAILY_GAP = 1
LAGGED_GAP = 2
SERIES_GAP = 5
MONTHLY_SERIES_GAP = 75


@dataclass(frozen=True)
class TableSpec:
    """Where a gold table comes from and how often it should move."""

    name: str
    silver: str
    bronze: str
    date_col: str
    cadence: str
    panel: str


def registry(spark: SparkSession, specs: Sequence[TableSpec]) -> DataFrame:
    """The lineage registry as rows (one literal array, as many rows as specs)."""
    rows = [
        F.struct(
            F.lit(s.name).alias("table"),
            F.lit(s.silver).alias("silver"),
            F.lit(s.bronze).alias("bronze"),
            F.lit(s.date_col).alias("date_col"),
            F.lit(s.cadence).alias("cadence"),
            F.lit(s.panel).alias("panel"),
        )
        for s in specs
    ]
    return spark.range(1).select(F.explode(F.array(*rows)).alias("_s")).select("_s.*")


def expected_date(as_of: Column) -> Column:
    """Latest trading day whose data can be expected; weekends roll back, holidays are not known."""
    day = utc_date(as_of)
    ended = F.when(utc_hour(as_of) < CLOSE_HOUR_UTC, F.date_sub(day, 1)).otherwise(day)
    weekday = F.weekday(ended)
    return F.when(weekday >= 5, F.date_sub(ended, weekday - 4)).otherwise(ended)


def cadence_status(cadence: Column, latest_date: Column, as_of: Column) -> Column:
    gap = F.datediff(utc_date(as_of), latest_date)

    def fresh(ok: Column) -> Column:
        return F.when(ok, "FRESH").otherwise("STALE")

    return (
        F.when(latest_date.isNull(), "NO DATA")
        .when(cadence == "trading_day", fresh(latest_date >= expected_date(as_of)))
        .when(cadence == "daily_lagged", fresh(gap <= LAGGED_GAP))
        .when(cadence == "daily", fresh(gap <= DAILY_GAP))
        .when(cadence == "mixed", F.lit("SEE PER-SERIES"))
        .otherwise("UNKNOWN")
    )


def table_freshness(tables: Mapping[str, DataFrame], specs: Sequence[TableSpec], as_of: Column) -> DataFrame:
    """Latest date, row count and status of every registered table, in one plan."""
    probed = [
        tables[s.name].agg(
            F.lit(s.name).alias("table"),
            F.max(s.date_col).alias("latest_date"),
            F.count(F.lit(1)).alias("total_rows"),
            F.lit(s.cadence).alias("cadence"),
        )
        for s in specs
    ]
    rows = reduce(DataFrame.unionByName, probed)
    return rows.withColumn("status", cadence_status(F.col("cadence"), F.col("latest_date"), as_of))


def footer_aggregate(spark: SparkSession, path: str, dt: str, footers: bool = True) -> DataFrame:
    """latest_date and total_rows of a table at a path, from the footers of its files: no column is read.

    A session of its own reads it with Spark's newer Parquet source, which answers a maximum of dates and a count from
    the statistics of the row groups; one footer per file is read, by all tasks.
    """
    session = spark.newSession()
    for name, value in FOOTERS_ONLY.items() if footers else ():
        session.conf.set(name, value)
    return read_table(session, path).agg(F.max(dt).alias("latest_date"), F.count(F.lit(1)).alias("total_rows"))


def footer_probe(spark: SparkSession, paths: Mapping[str, str], dt: Mapping[str, str]) -> DataFrame:
    """table, latest_date and total_rows of tables at `paths`; `dt` names each one's date column.

    A table with a row group that has no statistics, as one without a single date, has its date column read instead.
    """
    folder = new_path(spark, "footers")
    for name, path in paths.items():
        for footers in (True, False):
            told = footer_aggregate(spark, path, dt[name], footers).select(F.lit(name).alias("table"), "latest_date", "total_rows")
            try:
                told.write.mode("overwrite").parquet(f"{folder}/part={name}")
                break
            except (Py4JJavaError, PySparkException) as failure:
                if not footers or "No min/max found" not in str(failure):
                    raise
    return spark.read.schema("table string, latest_date date, total_rows long").parquet(f"{folder}/part=*")


#: Settings under which aggregates are answered from Parquet statistics.
FOOTERS_ONLY = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}


def freshness_from_footers(spark: SparkSession, paths: Mapping[str, str], specs: Sequence[TableSpec], as_of: Column) -> DataFrame:
    """`table_freshness` of tables kept at paths, from their files' statistics."""
    specs = [s for s in specs if s.name in paths]
    probed = footer_probe(spark, paths, {s.name: s.date_col for s in specs})
    cadences = F.create_map(*[F.lit(x) for s in specs for x in (s.name, s.cadence)])
    rows = probed.withColumn("cadence", cadences[F.col("table")])
    return rows.withColumn("status", cadence_status(F.col("cadence"), F.col("latest_date"), as_of))


def lineage(freshness: DataFrame, reg: DataFrame) -> DataFrame:
    """Freshness beside where each table comes from and is shown."""
    return reg.join(freshness.drop("cadence"), "table")


def series_freshness(df: DataFrame, ent: str, dt: str, monthly: Sequence[str], as_of: Column) -> DataFrame:
    """Status per series: monthly ones may lag a release cycle, the others a few days."""
    gap = F.datediff(utc_date(as_of), F.col("latest_date"))
    allowed = F.when(F.col(ent).isin(list(monthly)), MONTHLY_SERIES_GAP).otherwise(SERIES_GAP)
    return (
        df.groupBy(ent)
        .agg(F.max(dt).alias("latest_date"), F.count(F.lit(1)).alias("total_rows"))
        .withColumn("status", F.when(gap <= allowed, "FRESH").otherwise("STALE"))
    )


def stale_sources(tables: DataFrame, series: DataFrame, ent: str, prefix: str = "series:") -> DataFrame:
    """Stale tables and series, one row each."""
    stale = F.col("status") == "STALE"
    return (
        tables.filter(stale)
        .select(F.col("table").alias("source"))
        .unionByName(series.filter(stale).select(F.concat(F.lit(prefix), F.col(ent)).alias("source")))
    )


def last_run_per_day(
    runs: DataFrame, as_of: Column, ts: str, cols: Sequence[str], tie: str | None = None, days: int = 7
) -> DataFrame:
    """The last `days` calendar days with the day's last run; days without one stay, with NULLs.

    Per column the last non-NULL value of the day is taken.
    """
    today = utc_date(as_of)
    spine = runs.sparkSession.range(1).select(
        F.explode(F.sequence(F.date_sub(today, days - 1), today)).alias("date")
    )
    order = F.struct(ts, tie) if tie else F.col(ts)
    recent = runs.filter(utc_date(ts).between(F.date_sub(today, days - 1), today))
    last = recent.groupBy(utc_date(ts).alias("date")).agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), order)).alias(c) for c in cols]
    )
    return spine.join(last, "date", "left")


def run_state(runs: DataFrame, as_of: Column, ts: str, conclusion: str = "conclusion", tie: str | None = None) -> DataFrame:
    """The most recently started finished run, and whether one of today is still going."""
    done = F.col(conclusion).isNotNull()
    order = F.struct(ts, tie) if tie else F.col(ts)
    open_today = F.col(conclusion).isNull() & (utc_date(ts) == utc_date(as_of))
    return runs.agg(
        F.max_by(utc_date(ts), F.when(done, order)).alias("completed_date"),
        F.max_by(conclusion, F.when(done, order)).alias("completed_status"),
        F.coalesce(F.bool_or(open_today), F.lit(False)).alias("in_progress_today"),
    )


def open_incidents(incidents: DataFrame, opened: str, title: str, state: str = "state", tie: str | None = None) -> DataFrame:
    """How many incidents are open, and the most recent of them."""
    order = F.struct(opened, tie) if tie else F.col(opened)
    return incidents.filter(F.col(state) == "open").agg(
        F.count(F.lit(1)).alias("open_incidents"),
        F.max(opened).alias("latest_opened"),
        F.max_by(title, order).alias("latest_title"),
    )


def verdict(state: DataFrame, incidents: DataFrame, stale: DataFrame) -> DataFrame:
    """Overall health from the run side and the data side."""
    n_open = incidents.select("open_incidents").scalar()
    n_stale = stale.select(F.count(F.lit(1)).alias("n")).scalar()
    run_ok, data_ok = F.col("run_ok"), F.col("data_ok")
    return (
        state.withColumns({"open_incidents": n_open, "stale_sources": n_stale})
        .withColumns(
            {
                "run_ok": F.coalesce(F.col("completed_status") == "success", F.lit(False))
                & (F.col("open_incidents") == 0),
                "data_ok": F.col("stale_sources") == 0,
            }
        )
        .withColumn(
            "verdict",
            F.when(run_ok & data_ok, "HEALTHY")
            .when(~run_ok & data_ok, "CHECK RUN LOG")
            .when(run_ok & ~data_ok, "CHECK DATA")
            .otherwise("NEEDS ATTENTION"),
        )
    )


def digest(sources: Mapping[str, tuple[DataFrame, Keys, str, str]]) -> DataFrame:
    """Latest row per entity of every source, as (source, entity, date, value) rows.

    The value may be NULL; a source that should show its latest known value is filtered first.
    """
    rows = []
    for name, (df, ent, dt, val) in sources.items():
        keys = as_keys(ent)
        now = latest(df.select(*keys, dt, val), keys, dt)
        entity = F.col(keys[0]) if keys else F.lit(None)
        rows.append(
            now.select(
                F.lit(name).alias("source"),
                entity.cast("string").alias("entity"),
                F.col(dt).alias("date"),
                F.col(val).cast("double").alias("value"),
            )
        )
    return reduce(DataFrame.unionByName, rows)


def at_latest_date(df: DataFrame, dt: str) -> DataFrame:
    """All rows of the frame's latest date."""
    return df.filter(F.col(dt) == df.agg(F.max(dt).alias("_d")).scalar())
