"""A corpus pipeline: quality, near duplicates, secrets, mixture, packing; each stage reads what the last one kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.llm import best_fit, mixing, quality_knn, secret_forest, simhash_tiles
from holdfast.llm.common import table
from holdfast.llm.language_kn import folds
from holdfast.llm.queries import tokenizer_path
from holdfast.session import stage_table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the nearest labelled ones vote against."""
    labels = table(spark, sf_dir, "labels").filter(folds("doc_id", 3) != 1)
    model = quality_knn.fit(docs, labels, "quality")
    rows = docs.select("text", F.struct(*docs.columns).alias("doc"))
    return quality_knn.score(rows, model).filter("quality_score >= 0.5").select("doc.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of every group of fingerprints of three-word runs linked at 2 or fewer bits.

    The smallest ``doc_id`` of a group stays. Texts without a word, nulls among them, are one group.
    """
    return simhash_tiles.keep_one(docs, 2)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks secrets in the texts; no document goes."""
    return secret_forest.redact(docs, secret_forest.fit_on(docs))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources: a row for every pass that takes words of a document."""
    return mixing.mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their place in sequences of 2048 tokens."""
    return best_fit.pack(docs, tokenizer_path(), 2048)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality),
    ("simhash_near_dedup", near_duplicates),
    ("secret_scan", secrets),
    ("source_mixture", mixture),
    ("best_fit_packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage_table(stage(spark, docs, sf_dir), name)
    return docs
