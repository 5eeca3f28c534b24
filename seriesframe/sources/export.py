"""Publishing tables as ordered JSON."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesframe.functions.columns import null_nonfinite, require_finite
from seriesframe.sources.tables import WHOLE_TABLE
from seriesframe.sources.workspace import written


def publishable(df: DataFrame) -> DataFrame:
    """Decimals as doubles, non-finite numbers as NULL; anything non-finite left fails the job."""
    decimals = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DecimalType)]
    plain = df.withColumns({c: F.col(c).cast("double") for c in decimals})
    return require_finite(null_nonfinite(plain))


def export_json(df: DataFrame, order_by: Sequence[str], path: str) -> None:
    """Write row objects in global order: the part files hold consecutive ranges of `order_by`.

    NULL fields are written out as null; dates and timestamps are ISO-8601.
    """
    rows = publishable(df).orderBy(*order_by)
    rows.write.mode("overwrite").option(*WHOLE_TABLE).option("ignoreNullFields", False).json(path)


def export_json_array(df: DataFrame, order_by: Sequence[str], path: str) -> None:
    """Write the rows as text parts that, put end to end in the order of their names, are one JSON array of row objects.

    The parts hold consecutive ranges of `order_by` (equal ones in the order of their text) and are written by all
    tasks. Every row is a line: the first one opens the array, all others begin with a comma, and a line of its own
    closes it. The first row is a minimum, so no task sees more than its own range.
    """
    rows = publishable(df)
    text = F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("_text")
    cells = [F.col(c).alias(f"_o{i}") for i, c in enumerate(order_by)]
    lines = written(rows.select(F.struct(*cells, text).alias("_row")), "array-rows")
    first = lines.agg(F.min("_row").alias("_first"))
    is_first = F.col("_row") == first.scalar()
    copies = lines.filter(is_first).agg(F.count(F.lit(1)).alias("_n"))
    comma = F.concat(F.lit(","), F.col("_row._text"))
    opening = first.select(F.lit(0).alias("_at"), F.col("_first").alias("_row"), F.concat(F.lit("["), F.coalesce("_first._text", F.lit(""))).alias("value"))
    again = copies.filter("_n > 1").select(F.explode(F.sequence(F.lit(2), F.col("_n")))).select(F.lit(1).alias("_at"), first.scalar().alias("_row"))
    body = lines.filter(~is_first).select(F.lit(1).alias("_at"), "_row").unionByName(again.select("_at", "_row"))
    closing = first.select(F.lit(2).alias("_at"), F.col("_first").alias("_row"), F.lit("]").alias("value"))
    ordered = body.withColumn("value", comma).unionByName(opening).unionByName(closing).orderBy("_at", "_row")
    ordered.select("value").write.mode("overwrite").option(*WHOLE_TABLE).text(path)
