"""The corpus pipeline: quality rules, exact dedup, n-gram Jaccard join, PII, best-fit packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; its
result is written as Parquet to the shared folder and read again as the next
stage's docs. All stages but the last return the columns of ``documents``; the
last returns one row per packed piece.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerflow.llm import best_fit, exact_dedup, partenum_join, pii, quality_rules
from layerflow.llm.common import table, without, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality_rules.quality_filter(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal text up to white space, the one with the smallest doc_id."""
    return without(docs, exact_dedup.exact_dedup(docs).filter("NOT kept"))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a similarity of 0.8 of their five-word shingles, the one with the smallest doc_id."""
    return without(docs, partenum_join.similar_components(docs, words=5, percent=80).filter("doc_id <> component_id"))


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with pseudonyms in place of personal data; n_chars is that of the new text."""
    docs = pii.pseudonymise(docs)
    return docs.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in docs.columns else docs


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in bins."""
    return best_fit.best_fit(docs)


STAGES = [("quality_rules", quality), ("exact_dedup", exact), ("ngram_jaccard", near), ("pii_pseudonyms", private), ("best_fit", packed)]
#: The pseudonyms and the packing can't be told in SQL; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = written(docs, name)
    return docs
