"""Grouping by the most frequent categories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

OTHER = "Other"


def top_categories(counts: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` largest categories of a frame of counts, ties by name.

    ``counts`` has ``primary_category`` and ``paper_count``; a category may
    come in several rows.  Result: ``category, paper_count``.
    """
    totals = counts.groupBy(F.col("primary_category").alias("category")).agg(
        F.sum("paper_count").alias("paper_count")
    )
    return totals.orderBy(F.desc("paper_count"), "category").limit(n)


def top_list(counts: DataFrame, n: int = 5) -> Column:
    """Names of the ``n`` largest categories as one array, a scalar subquery."""
    ranked = F.sort_array(
        F.collect_list(F.struct((-F.col("paper_count")).alias("neg"), F.col("category")))
    )
    return top_categories(counts, n).select(F.transform(ranked, lambda r: r["category"])).scalar()


def with_category_group(df: DataFrame, names: Column, category: str) -> DataFrame:
    """Add ``category_group``: the category when listed, else ``Other``."""
    listed = F.array_contains(names, F.col(category))
    return df.withColumn(
        "category_group", F.when(listed, F.col(category)).otherwise(F.lit(OTHER))
    )
