"""A corpus pipeline over `documents`: five stages, each one operator, each on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placeforge.llm import decontam, nbest, qda, simhash, weakpii
from placeforge.llm.common import durable, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    scored = qda.quality(docs, table(spark, sf_dir, "labels"), extra=COLUMNS[1:])
    return scored.filter(F.col("predicted") == 1).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (similarity 0.8 over five words): the one with the least doc_id."""
    return simhash.keep_first(docs).select(*COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that don't hold a benchmark item."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return weakpii.redact(docs).select(*COLUMNS)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The n best segmentations of each document: the best ids, and where each other path leaves them."""
    return nbest.encode_documents(docs)


STAGES = [
    ("quality classifier", quality),
    ("simhash near-duplicates", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("personal data", personal_data),
    ("sentencepiece n-best", pieces),
]

#: A trained classifier and a search over a lattice can't be said in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what each returns is written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = durable(docs, f"stage-{k}")
    return docs
