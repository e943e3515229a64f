"""The four statistics tables derived from ``papers``."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from foliograph.functions.text import comma_names

# Presentation order of each table.
TABLE_ORDER = {
    "category_stats": ("category",),
    "yearly_trends": ("year", "category"),
    "publication_status": ("pub_status", "category"),
    "author_stats": ("author",),
}


def category_stats(papers: DataFrame) -> DataFrame:
    published = F.count_if(F.col("pub_status") == "published")
    return papers.groupBy(F.col("primary_category").alias("category")).agg(
        F.count("*").alias("total_papers"),
        published.alias("published_count"),
        F.round(F.lit(100.0) * published / F.count("*"), 2).alias("publish_rate_pct"),
    )


def yearly_trends(papers: DataFrame) -> DataFrame:
    return papers.groupBy(
        F.col("submitted_year").alias("year"), F.col("primary_category").alias("category")
    ).agg(F.count("*").alias("paper_count"))


def publication_status(papers: DataFrame) -> DataFrame:
    return papers.groupBy("pub_status", F.col("primary_category").alias("category")).agg(
        F.count("*").alias("paper_count")
    )


def paper_authors(papers: DataFrame) -> DataFrame:
    """One row per listed name; a name listed twice on a paper gives two rows."""
    return papers.select(
        "arxiv_id",
        F.explode(comma_names("authors")).alias("author"),
        "primary_category",
        "submitted_year",
    )


def author_categories(papers: DataFrame) -> DataFrame:
    """Per author and category: count and year range.

    This is the only pass over the names; author totals and top categories are
    both read from it.
    """
    return (
        paper_authors(papers)
        .groupBy("author", F.col("primary_category").alias("category"))
        .agg(
            F.count("*").alias("category_count"),
            F.min("submitted_year").alias("first_year"),
            F.max("submitted_year").alias("last_year"),
        )
    )


# Most papers first, then name: the smallest such pair is the top category.
def _top_category():
    return F.min_by("category", F.struct(-F.col("category_count"), F.col("category")))


def author_top_category(papers: DataFrame) -> DataFrame:
    return author_categories(papers).groupBy("author").agg(_top_category().alias("top_category"))


def author_stats(papers: DataFrame) -> DataFrame:
    """Totals and top category in one aggregate over the author-category counts.

    An aggregate rather than a window and a self-join: it combines inside each
    map task, so one author with very many papers does not fill a single task.
    """
    return (
        author_categories(papers)
        .groupBy("author")
        .agg(
            F.sum("category_count").alias("paper_count"),
            F.min("first_year").alias("first_year"),
            F.max("last_year").alias("last_year"),
            _top_category().alias("top_category"),
        )
    )


STATISTICS = {
    "category_stats": category_stats,
    "yearly_trends": yearly_trends,
    "publication_status": publication_status,
    "author_stats": author_stats,
}
