"""Reading landed JSON documents and published tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_landing(
    spark: SparkSession, path: str | list[str], schema: T.StructType | str, one_per_file: bool = True
) -> DataFrame:
    """Landed documents with a declared schema; a document that does not fit it fails the job.

    `one_per_file` reads pretty-printed documents, one per file; otherwise one document
    per line, which lets Spark split large files.
    """
    return spark.read.schema(schema).option("multiLine", one_per_file).option("mode", "FAILFAST").json(path)


def read_landing_text(spark: SparkSession, path: str | list[str], one_per_file: bool = True) -> DataFrame:
    """Documents as text in `value`, for sources whose top-level names are data."""
    return spark.read.text(path, wholetext=one_per_file)


def read_published(
    spark: SparkSession, path: str | list[str], schema: T.StructType | str, array_file: bool = True
) -> DataFrame:
    """A published table: a JSON array of row objects, or the line-delimited export; a broken row fails the job."""
    return spark.read.schema(schema).option("multiLine", array_file).option("mode", "FAILFAST").json(path)


def read_array_parts(spark: SparkSession, path: str | list[str], schema: T.StructType | str) -> DataFrame:
    """The parts of an exported array, read by all tasks line by line; a broken row fails the job."""
    text = spark.read.text(path).select(F.regexp_replace("value", r"^[\[,]", "").alias("value"))
    rows = text.filter(~F.col("value").isin("", "]"))
    return rows.select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias("_row")).select("_row.*")


class AllBroken(ValueError):
    """Not one document of a landing could be read."""


def land_documents(
    spark: SparkSession, path: str | list[str], schema: T.StructType | str, target: str, one_per_file: bool = True
) -> DataFrame:
    """Keep landed documents in the folder `target`, the broken ones beside the good ones, and return the good ones.

    A document that is no JSON or does not fit the schema is kept as text with its file (`broken_documents`), and the
    others land all the same. Both are written and counted in one pass. The call fails if documents came and all are
    broken. A rerun replaces the folder.
    """
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    whole = T.StructType([*fields.fields, T.StructField(CORRUPT, T.StringType())])
    reader = spark.read.schema(whole).option("multiLine", one_per_file).option("mode", "PERMISSIVE")
    docs = reader.option("columnNameOfCorruptRecord", CORRUPT).json(path)
    return _land(docs, F.col(CORRUPT).isNotNull(), target)


def land_texts(spark: SparkSession, path: str | list[str], target: str, one_per_file: bool = True) -> DataFrame:
    """`land_documents` for documents whose top-level names are data: whole texts in `value`, objects or broken."""
    docs = read_landing_text(spark, path, one_per_file).filter(F.trim("value") != "")
    bad = F.from_json("value", "map<string,string>").isNull()
    return _land(docs.withColumn(CORRUPT, F.when(bad, F.col("value"))), bad, target)


CORRUPT, BROKEN = "corrupt_record", "broken"


def _land(docs: DataFrame, bad: Column, target: str) -> DataFrame:
    spark, seen = docs.sparkSession, Observation()
    told = docs.withColumn("file", F.col("_metadata.file_path")).withColumn(BROKEN, bad)
    counted = told.observe(seen, F.count(F.lit(1)).alias("documents"), F.count_if(BROKEN).alias("broken"))
    writer = counted.write.mode("overwrite").option("partitionOverwriteMode", "static")
    writer.partitionBy(BROKEN).parquet(target)
    if 0 < seen.get["documents"] == seen.get["broken"]:
        raise AllBroken(f"all {seen.get['documents']} documents are broken; {target} lists them")
    return _landed(spark, target, told.schema, False).drop(CORRUPT, "file")


def _landed(spark: SparkSession, target: str, schema: T.StructType, broken: bool) -> DataFrame:
    return spark.read.schema(schema).parquet(target).filter(F.col(BROKEN) == broken).drop(BROKEN)


def broken_documents(spark: SparkSession, target: str) -> DataFrame:
    """file and corrupt_record of the documents of a landing that could not be read."""
    schema = T.StructType.fromDDL(f"{CORRUPT} string, file string, {BROKEN} boolean")
    return _landed(spark, target, schema, True)


def explode_records(df: DataFrame, records: str = "records", carry: Sequence[str] = ("fetched_at",)) -> DataFrame:
    """One row per array element with the document's own columns; empty or NULL arrays give none."""
    return df.select(F.explode(records).alias("_record"), *carry).select("_record.*", *carry)


def melt_structs(
    df: DataFrame,
    fields: T.StructType | str,
    name: str,
    text: str = "value",
    carry: Sequence[str] = ("fetched_at",),
) -> DataFrame:
    """Documents of the form {name: {fields}, ..., carried: text} to one row per name.

    The names are found in the documents (everything but the carried ones), in one pass.
    """
    doc = F.from_json(text, "map<string,string>", {"mode": "FAILFAST"})
    entries = F.map_filter(doc, lambda k, _: ~k.isin(list(carry)))
    return (
        df.select(F.explode(entries).alias(name, "_body"), *[doc[c].alias(c) for c in carry])
        .withColumn("_fields", F.from_json("_body", fields, {"mode": "FAILFAST"}))
        .select(name, "_fields.*", *carry)
    )


def type_cols(df: DataFrame, types: dict[str, str], strict: bool = True) -> DataFrame:
    """Project onto the named columns with their types; lenient mode gives NULL for bad input."""
    return df.select(
        *[(F.col(c).cast(t) if strict else F.col(c).try_cast(t)).alias(c) for c, t in types.items()]
    )
