"""The corpus pipeline: documents in, packed training sequences out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from foliograph.llm.stages import (
    near_dup_stage,
    packing_stage,
    quality_classifier_stage,
    quality_rules_stage,
    substring_dedup_stage,
)
from foliograph.session import scratch_path

STAGES = [
    ("quality_classifier", quality_classifier_stage),
    ("quality_rules", quality_rules_stage),
    ("near_dup", near_dup_stage),
    ("substring_dedup", substring_dedup_stage),
    ("packing", packing_stage),
]

# The classifier and the packing cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
