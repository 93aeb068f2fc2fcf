"""The corpus pipeline: classify quality, remove near duplicates, redact personal data, pack.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame. ``run`` applies them in order to ``documents`` and writes
each result to the shared folder, from which the next stage reads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import neardup, packing, pii, quality
from strata.llm.common import table, written
from strata.llm.queries import tokenizer


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def neardup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return neardup.deduplicate(docs)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind in brackets; n_chars follows the new text."""
    return pii.redact(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their token ids and their places in sequences."""
    return packing.pack(docs, tokenizer())


STAGES = [
    ("quality_classifier", quality_stage),
    ("minhash_neardup", neardup_stage),
    ("pii", pii_stage),
    ("packing", packing_stage),
]

# A trained classifier, similarity components and a tokenizer: no SQL expresses them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
