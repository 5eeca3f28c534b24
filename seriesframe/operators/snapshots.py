"""Long-form metric snapshots and their change from run to run."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seriesframe.functions.ordered import with_prev
from seriesframe.sources.tables import PERIOD, by_period, find_table, is_path, read_table


def metric_change(
    history: DataFrame,
    decimals: int | Column = 1,
    by: Sequence[str] = ("section", "metric"),
    dt: str = "snapshot_date",
    val: str = "value",
) -> DataFrame:
    """Step from the previous snapshot of the same metric: first, flat, up or down, and how much.

    A step that rounds to zero at `decimals` places is flat.
    """
    places = F.lit(decimals) if isinstance(decimals, int) else decimals
    scale = F.pow(F.lit(10.0), places.cast("double"))
    delta = F.col(val) - F.col("previous")
    rounded = F.round(delta, decimals) if isinstance(decimals, int) else F.round(delta * scale) / scale
    label = (
        F.when(F.col("previous").isNull(), "first").when(rounded == 0, "flat").when(delta > 0, "up").otherwise("down")
    )
    return with_prev(history, list(by), dt, {"previous": val}).withColumns(
        {"moved": label, "magnitude": F.when(F.col("previous").isNotNull(), F.abs(rounded))}
    )


def snapshot_rows(sections: Mapping[str, tuple[DataFrame, Mapping[str, str]]], run_date: Column) -> DataFrame:
    """One-row findings as (snapshot_date, section, metric, value, label) rows.

    Every section gives a one-row frame and a mapping metric name -> column of it. Numbers
    go to `value`; text and dates go to `label`.
    """
    pieces = []
    for section, (df, metrics) in sections.items():
        numeric = {f.name for f in df.schema.fields if f.dataType.typeName() in _NUMBERS}
        cells = [
            F.struct(
                F.lit(metric).alias("metric"),
                (F.col(c).cast("double") if c in numeric else F.lit(None).cast("double")).alias("value"),
                (F.lit(None).cast("string") if c in numeric else F.col(c).cast("string")).alias("label"),
            )
            for metric, c in metrics.items()
        ]
        pieces.append(
            df.select(F.lit(section).alias("section"), F.explode(F.array(*cells)).alias("_cell")).select(
                run_date.alias("snapshot_date"), "section", "_cell.*"
            )
        )
    return reduce(DataFrame.unionByName, pieces)


_NUMBERS = {"double", "float", "long", "integer", "short", "byte", "decimal"}


def append_snapshot(spark: SparkSession, target: str, rows: DataFrame) -> DataFrame:
    """Add a run to the history; a repeated run replaces the whole snapshot of its date.

    Every date is a partition, so a metric that the repeated run lacks goes with the rest.
    """
    laid_out = by_period(rows.withColumn(PERIOD, F.col("snapshot_date")), ["section", "metric"])
    known = find_table(spark, target)
    if is_path(target):
        laid_out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PERIOD).parquet(target)
    elif known is None:
        laid_out.write.format("parquet").partitionBy(PERIOD).saveAsTable(target)
    else:
        laid_out.select(*known.columns).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).insertInto(target)
    return read_table(spark, target)


def last_two(history: DataFrame, dt: str = "snapshot_date") -> DataFrame:
    """Rows of the two latest runs, `age` 1 for the latest.

    The run dates are reduced to one row each and cut to two before they are ranked.
    """
    runs = history.select(dt).distinct().orderBy(F.col(dt).desc()).limit(2)
    newest = Window.partitionBy(F.lit(0)).orderBy(F.col(dt).desc())
    ages = runs.select(dt, F.row_number().over(newest).alias("age"))
    return history.join(F.broadcast(ages), dt)
