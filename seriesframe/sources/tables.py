"""Tables: snapshots, rebuilds, period partitions, profiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesframe.sources.workspace import Folder

PERIOD = "period"
MERGE = "merge"

# an overwrite of a path replaces every partition, whatever the session's default is; not for
# catalog tables, which are replaced as a whole anyway and would keep the option for good
WHOLE_TABLE = ("partitionOverwriteMode", "static")


def is_path(target: str) -> bool:
    return "/" in target


def location(spark: SparkSession, target: str) -> str:
    """The folder of a table."""
    if is_path(target):
        return target.rstrip("/")
    details = spark.sql(f"DESCRIBE FORMATTED {target}").filter("col_name = 'Location'")
    return details.first().data_type.rstrip("/")


def ensure_namespace(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{name}`")


def find_table(spark: SparkSession, target: str) -> DataFrame | None:
    """The table, or None before its first write."""
    if not is_path(target):
        return spark.table(target) if spark.catalog.tableExists(target) else None
    try:
        return read_table(spark, target)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def read_table(spark: SparkSession, target: str, schema: T.StructType | None = None) -> DataFrame:
    """The table; a schema that is known already saves reading a footer for it.

    A path that has been merged into holds folders `merge=N`, each with whole periods; of every period the newest
    finished one counts. Files that are older than a column give NULL for it.
    """
    if not is_path(target):
        return remarked(spark.table(target))
    live = live_periods(spark, target)
    if live is None:
        return remarked((spark.read.schema(schema) if schema else spark.read).parquet(target))
    if schema is None:
        newest = max(live.values(), key=lambda folder: folder[0])[1]
        schema = spark.read.option("basePath", target).parquet(newest).schema
    table = spark.read.schema(schema).option("basePath", target).parquet(*(folder for _, folder in live.values()))
    return remarked(table.drop(MERGE))


def live_periods(spark: SparkSession, target: str) -> dict[str, tuple[int, str]] | None:
    """{period folder: (number, path) of the newest finished merge that has it}; None for a path without merges.

    Spark writes `_SUCCESS` last, so a merge that was cut off has none.
    """
    live: dict[str, tuple[int, str]] = {}
    merges = [int(n) for n in Folder(spark, target).children(f"{MERGE}=")]
    done = [n for n in sorted(merges) if Folder(spark, f"{target}/{MERGE}={n}").exists("_SUCCESS")]
    for n in done:
        for period in Folder(spark, f"{target}/{MERGE}={n}").children(f"{PERIOD}="):
            live[period] = n, f"{target}/{MERGE}={n}/{PERIOD}={period}"
    return live or None


def marked(df: DataFrame, dt: str, grain: str) -> DataFrame:
    """The frame, its period column marked as that of `dt`: windows over it then skip whole partitions.

    `dt` has the mark too, and keeps it in the files that are written.
    """
    mark = {"period_of": dt, "grain": grain}
    return df.withMetadata(PERIOD, mark).withMetadata(dt, mark)


def remarked(table: DataFrame) -> DataFrame:
    """A table just read: its period column gets the mark that the date column has in the files."""
    if PERIOD in table.columns:
        for f in table.schema.fields:
            if f.metadata.get("period_of") == f.name:
                return table.withMetadata(PERIOD, f.metadata)
    return table


def grain_of(df: DataFrame, dt: str) -> str | None:
    """The grain of the frame's periods of `dt`; None for a column that only has the name."""
    mark = df.schema[PERIOD].metadata if PERIOD in df.columns else {}
    return mark.get("grain") if mark.get("period_of") == dt else None


def write_snapshot(df: DataFrame, target: str) -> None:
    """Replace rows and schema by this run's."""
    writer = df.write.mode("overwrite").format("parquet")
    writer.option(*WHOLE_TABLE).save(target) if is_path(target) else writer.saveAsTable(target)


def period_of(dt: Column, grain: str = "month") -> Column:
    return dt if grain == "day" else F.trunc(dt, grain)


def write_table(
    df: DataFrame, target: str, dt: str | None = None, grain: str = "year", cluster: tuple = (), gather: bool = True
) -> DataFrame:
    """Rebuild a table in full and return it as read back.

    With `dt` the table is partitioned by period, so date filters skip whole partitions,
    and sorted by date inside its files. Without `gather` every task writes its own rows of each
    period: a large table of few periods is not shuffled once more to have few files in each.
    """
    if dt is None:
        write_snapshot(df, target)
        return read_table(df.sparkSession, target, nullable(df.schema))
    rows, order = df.withColumn(PERIOD, period_of(F.col(dt), grain)), [dt, *cluster]
    laid_out = marked(by_period(rows, order) if gather else rows.sortWithinPartitions(PERIOD, *order), dt, grain)
    writer = laid_out.write.mode("overwrite").format("parquet").partitionBy(PERIOD)
    if is_path(target):
        writer.option(*WHOLE_TABLE).option("compression", "zstd").save(target)
    else:
        writer.saveAsTable(target)
    return read_table(df.sparkSession, target, nullable(laid_out.schema))


def nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in schema.fields])


def by_period(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows laid out for a write by period: few files per period, several for a large one.

    The rebalance hint lets AQE split a period with many rows and merge small ones at the
    advisory partition size, without the sampling pass of a range partitioning.
    """
    return df.hint("rebalance", PERIOD).sortWithinPartitions(PERIOD, *order)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table, rows) for every table in one plan."""
    counted = [t.agg(F.lit(name).alias("table"), F.count(F.lit(1)).alias("rows")) for name, t in tables.items()]
    return reduce(DataFrame.unionByName, counted)


def heads(tables: Mapping[str, DataFrame], n: int = 5) -> dict[str, DataFrame]:
    """The first rows of every table, for looking at."""
    return {name: t.limit(n) for name, t in tables.items()}
