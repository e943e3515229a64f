"""Delimited snapshot to the raw table and its JSON export."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from foliograph.operators.sampling import sample_rows
from foliograph.plans.clean import DEFAULT_CATEGORIES, filter_categories, raw_papers
from foliograph.sources.delimited import read_records
from foliograph.sources.documents import write_json
from foliograph.sources.tables import RAW_TABLE, replace_table


def ingest(
    spark: SparkSession,
    path: str,
    json_path: str | None = None,
    categories: Sequence[str] | None = None,
    sample_size: int | None = None,
    sample_frac: float | None = None,
    seed: int = 42,
    multi_line: bool = True,
) -> DataFrame:
    """Read, filter by category, sample, and store; returns the raw table.

    Without ``categories`` (or with none listed) the default five are kept.
    """
    records = filter_categories(read_records(spark, path, multi_line), categories or DEFAULT_CATEGORIES)
    replace_table(raw_papers(sample_rows(records, sample_size, sample_frac, seed)), RAW_TABLE)
    raw = spark.table(RAW_TABLE)
    if json_path is not None:
        write_json(raw, json_path)
    return raw
