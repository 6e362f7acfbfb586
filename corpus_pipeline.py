"""Corpus pipeline: language, near duplicates, benchmark leaks, personal data, packing.

``STAGES`` lists the stages in order; each takes ``(spark, docs, sf_dir)`` and returns a
DataFrame that is written as Parquet and read again as the next stage's ``docs``.  All
but the last return the columns of ``documents``; the last returns the packed pieces.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankwright.llm import decontam, langid, neardup, packing, pii
from rankwright.session import ensure_checkpoint_dir, ship_package
from rankwright.sources.tables import table

MIN_LANGUAGE_SCORE = 0.3


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without a letter and texts that no language claims with a fair share."""
    ship_package(spark)
    model = langid.fit(docs)
    name = langid.free_name(docs.columns, "_language")
    found = docs.select("*", langid.predictor(model)(F.col("text")).alias(name))
    return found.where((F.col(f"{name}.lang_pred") != langid.UNKNOWN)
                       & (F.col(f"{name}.score") >= MIN_LANGUAGE_SCORE)).select(*docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (similarity 0.8 or more) stays."""
    ship_package(spark)
    return neardup.drop_near_duplicates(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    ship_package(spark)
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is masked in the texts; ``n_chars`` follows the masked text."""
    ship_package(spark)
    masked = docs.withColumn("text", pii.redact(F.col("text")))
    return masked.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their bins."""
    ship_package(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("language", known_language),
    ("near_duplicates", one_of_each),
    ("decontamination", without_benchmark),
    ("personal_data", without_personal_data),
    ("packing", packed),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what passes between them lies in the shared folder."""
    ship_package(spark)
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/corpus-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k + 1 == len(STAGES):
            return out
        path = f"{base}/{k}-{name}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
