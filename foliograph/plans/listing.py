"""Paged listing of papers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from foliograph.functions.text import status_label
from foliograph.operators.paging import TOP_K_ROWS, page

DEFAULT_LIMIT = 20
MAX_LIMIT = 200


def list_papers(
    papers: DataFrame, limit: int = DEFAULT_LIMIT, offset: int = 0, top_k_rows: int = TOP_K_ROWS
) -> DataFrame:
    """One page, newest year first, then by id."""
    _check_limit(limit)
    if offset < 0:
        raise ValueError("offset must not be negative")
    return page(_listing(papers), "year", "arxiv_id", limit, offset, top_k_rows)


def list_papers_after(
    papers: DataFrame, year: int | None, arxiv_id: str, limit: int = DEFAULT_LIMIT
) -> DataFrame:
    """The page that follows the paper with this year and id, in the order of ``list_papers``.

    No skipped row is sorted, so a late page costs what the first one does.
    Papers without a year come last.
    """
    _check_limit(limit)
    if year is None:
        later = F.col("year").isNull() & (F.col("arxiv_id") > arxiv_id)
    else:
        same = (F.col("year") == year) & (F.col("arxiv_id") > arxiv_id)
        later = (F.col("year") < year) | same | F.col("year").isNull()
    return _listing(papers).filter(later).orderBy(*_order()).limit(limit)


def _order() -> list[Column]:
    return [F.desc("year"), F.asc("arxiv_id")]


def _check_limit(limit: int) -> None:
    if not 1 <= limit <= MAX_LIMIT:
        raise ValueError(f"limit must be between 1 and {MAX_LIMIT}")


def _listing(papers: DataFrame) -> DataFrame:
    return papers.select(
        "arxiv_id",
        "title",
        F.col("primary_category").alias("category"),
        F.col("submitted_year").alias("year"),
        status_label("pub_status").alias("pub_status"),
        "first_author",
    )


def with_page_count(listed: DataFrame) -> DataFrame:
    """Add the number of items on the page, at most 200."""
    return listed.withColumn("item_count", F.count("*").over(Window.partitionBy()))
