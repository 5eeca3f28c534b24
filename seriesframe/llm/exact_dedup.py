"""Exact deduplication by skew-safe combining, in DataFrame operations only.

Rows are deduplicated where they lie (the partial aggregate of each task), then in salted groups of their digest, so
that copies of one text meet in many tasks, then the winners of the salts are combined. The full text is part of the
key in every step: texts with equal digests stay apart. The salt is the number of the scan's task, so that a task
sends at most one row for each text, however many copies it holds.

Defined cases: a null text counts as empty; a null id is never preferred to another; of rows that repeat id and text
one stays; empty tables give empty results; only the id and text columns are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesframe.llm.work import stage

#: Tasks that the copies of one text meet in before the winners are combined.
SALTS = 64


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def _combined(rows: DataFrame, partial: list[Column], final: list[Column], salts: int) -> DataFrame:
    """Aggregate by digest and full text, first per salt, then over the salts."""
    salted = rows.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
    return salted.groupBy("digest", "text", "salt").agg(*partial).groupBy("digest", "text").agg(*final)


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    salts: int = SALTS,
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """One row per document: doc_id, keep_id (largest id of its group of equal texts), group_size, kept, digest.

    The groups are written without their texts and joined to the documents by digest. Should one digest have several
    texts, which the written groups show, the join compares the texts too.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    ).withColumn("digest", digest(F.col("text")))
    groups = _combined(
        rows,
        [F.max("doc_id").alias("top"), F.count(F.lit(1)).alias("n")],
        [F.max("top").alias("keep_id"), F.sum("n").alias("group_size")],
        salts,
    )
    light = stage(groups.drop("text"), "exact-groups")
    if light.groupBy("digest").count().filter("count > 1").isEmpty():
        ids, joined_by = rows.groupBy("digest", "doc_id"), ["digest"]
    else:
        light, ids, joined_by = groups, rows.groupBy("digest", "text", "doc_id"), ["digest", "text"]
    repeats = ids.agg(F.count(F.lit(1)).cast("int").alias("repeats"))
    return (
        repeats.join(light, joined_by)
        .withColumn("nth", F.explode(F.sequence(F.lit(1), F.col("repeats"))))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1))
        .select("doc_id", "keep_id", "group_size", "kept", "digest")
    )


def survivors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """The rows that stay, with all their columns: of equal texts the row with the largest id, ties by the others.

    Columns that have no order of their own, as maps, are compared by their JSON."""
    rest = [c for c in docs.columns if c not in (id_col, text_col)]
    rows = docs.select(
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        F.struct(
            F.col(id_col).alias("id"),
            F.col(text_col).isNotNull().alias("given"),
            *(F.col(f"`{c}`").alias(f"rest{i}") for i, c in enumerate(rest)),
        ).alias("row"),
    ).withColumn("digest", sha256(F.col("text")))
    loose = {f"rest{i}" for i, c in enumerate(rest) if "map<" in docs.schema[c].dataType.simpleString()}
    if not loose:
        won = _combined(rows, [F.max("row").alias("top")], [F.max("top").alias("row")], salts)
    else:
        names = ["id", "given", *(f"rest{i}" for i in range(len(rest)))]
        rank = F.struct(*((F.to_json(F.struct(f"row.{n}")) if n in loose else F.col(f"row.{n}")).alias(n) for n in names))
        ranked = rows.withColumn("rank", rank)
        partial = [F.max_by("row", "rank").alias("top"), F.max("rank").alias("rank")]
        won = _combined(ranked, partial, [F.max_by("top", "rank").alias("row")], salts)
    columns = {id_col: F.col("row.id"), text_col: F.when(F.col("row.given"), F.col("text"))}
    columns |= {c: F.col(f"row.rest{i}") for i, c in enumerate(rest)}
    return won.select(*(columns[c].alias(c) for c in docs.columns))
