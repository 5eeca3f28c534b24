"""From raw documents to training sequences: five stages, each over all that the one before has kept.

Language identification drops documents that no language is close enough to, exact and near deduplication keep one document of each group,
secret scans mask what they find, and packing cuts the rest into sequences. Every stage is written as Parquet and read
again, so a lost executor costs the work of one stage at most.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesframe.llm import exact_dedup, language_id, ngram_join, packing, secrets
from seriesframe.llm.work import fresh, stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are given a language; the model learns from those with one, and its cuts from those held out."""
    model = language_id.fit(docs.filter(~language_id.held_out()))
    return language_id.accepted(docs, language_id.calibrated(model, docs.filter(language_id.held_out())))


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id."""
    return exact_dedup.survivors(docs)


def distinct_runs(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the document with the least id."""
    return ngram_join.one_of_each(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets masked."""
    ledger = secrets.Ledger(spark, fresh(spark, "secret-ledger"))
    secrets.update(ledger, docs)
    return secrets.redacted(docs, ledger).withColumn("n_chars", F.length("text").cast("long"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their token ids, and the sequences they fill."""
    pieces = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))
    return pieces.withColumn("ids_crc32", F.crc32("ids"))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", known_language),
    ("exact_dedup", distinct_texts),
    ("ngram_jaccard_join", distinct_runs),
    ("secret_scans", without_secrets),
    ("packing", packed),
]

#: The stages are not expressible in SQL; tests/llm/test_pipeline.py holds them against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages on the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
