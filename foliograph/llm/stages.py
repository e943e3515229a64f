"""The operators as stages of a pipeline: documents in, documents out."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from foliograph.llm import near_dup, packing, quality_classifier, quality_rules, substring_dedup


def _measured(docs: DataFrame) -> DataFrame:
    """``n_chars`` after texts have changed."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def quality_classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones of the input, calls good."""
    return quality_classifier.good_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, without the lines that too many documents of their host share."""
    return _measured(quality_rules.kept_documents(docs))


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: five-word shingles, similarity 0.8."""
    return near_dup.one_per_group(docs)


def substring_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages of 35 words or more that occur in a second place."""
    return _measured(substring_dedup.cut_documents(docs))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))
