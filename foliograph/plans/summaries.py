"""Frames behind the summary charts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F, types as T

from foliograph.operators.histogram import density_histogram
from foliograph.operators.topn import OTHER, top_categories, top_list, with_category_group
from foliograph.session import kept

# Publication states, in the order they are stacked and listed.
STATUSES = ("published", "unpublished")

_NEEDED = ("primary_category", "pub_status", "submitted_year", "abstract_word_count")
_NUMERIC = ("submitted_year", "abstract_word_count")


def prepare_papers(papers: DataFrame) -> DataFrame:
    """Rows with all chart fields, year and word count as whole numbers.

    Columns that hold whole numbers already are taken as they are, so that a
    count made in the same plan is not made again per conversion.
    """
    kept_rows = papers
    for name in _NUMERIC:
        if not isinstance(papers.schema[name].dataType, T.IntegralType):
            number = F.col(name).try_cast("double")
            kept_rows = kept_rows.withColumn(name, F.when(~F.isnan(number), number))
    for name in _NEEDED:
        kept_rows = kept_rows.filter(F.col(name).isNotNull())
    return kept_rows.withColumns({name: F.col(name).cast("bigint") for name in _NUMERIC})


def _counts(prepared: DataFrame, *by: str) -> DataFrame:
    """Papers per category and ``by``: all that a chart reads of the papers."""
    return prepared.groupBy("primary_category", *by).agg(F.count("*").alias("paper_count"))


def largest_categories(prepared: DataFrame, n: int = 5) -> DataFrame:
    return top_categories(_counts(prepared), n)


def category_pivot(prepared: DataFrame) -> DataFrame:
    """Category by status with totals; ``unpublished_base`` is where its bar starts."""
    wide = (
        prepared.groupBy(F.col("primary_category").alias("category"))
        .pivot("pub_status", list(STATUSES))
        .agg(F.count(F.lit(1)))
        .na.fill(0)
    )
    return wide.select(
        "category",
        "published",
        "unpublished",
        (F.col("published") + F.col("unpublished")).alias("total"),
        F.col("published").alias("unpublished_base"),
    ).orderBy(F.desc("total"), "category")


def year_trend(prepared: DataFrame, n: int = 5) -> DataFrame:
    """Papers per year for the ``n`` largest categories and the rest, gaps as zero."""
    by_year = kept(_counts(prepared, "submitted_year"))
    names = top_list(by_year, n)
    grouped = (
        with_category_group(by_year, names, "primary_category")
        .groupBy("submitted_year", "category_group")
        .agg(F.sum("paper_count").alias("paper_count"))
    )
    grid = by_year.select("submitted_year").distinct().select(
        "submitted_year", F.explode(F.concat(names, F.array(F.lit(OTHER)))).alias("category_group")
    )
    return (
        grid.join(grouped, ["submitted_year", "category_group"], "left")
        .na.fill(0, subset=["paper_count"])
        .select(F.col("submitted_year").alias("year"), "category_group", "paper_count")
    )


def status_share(prepared: DataFrame) -> DataFrame:
    """Count and percentage of the two publication states, absent ones as zero."""
    spark = prepared.sparkSession
    domain = spark.createDataFrame([(s,) for s in STATUSES], "pub_status string")
    counts = prepared.groupBy("pub_status").agg(F.count("*").alias("paper_count"))
    both = domain.join(counts, "pub_status", "left").na.fill(0, subset=["paper_count"])
    # Two rows at most, so one window over all of them is safe.
    share = F.try_divide(
        F.lit(100.0) * F.col("paper_count"), F.sum("paper_count").over(Window.partitionBy())
    )
    return both.select(
        "pub_status",
        F.initcap("pub_status").alias("label"),
        "paper_count",
        F.round(share, 1).alias("share_pct"),
    )


def length_histogram(prepared: DataFrame, n: int = 5, bins: int = 30) -> DataFrame:
    """Word-count densities of the ``n`` largest categories and the rest."""
    by_length = kept(_counts(prepared, "abstract_word_count"))
    grouped = with_category_group(by_length, top_list(by_length, n), "primary_category")
    return density_histogram(grouped, "category_group", "abstract_word_count", "paper_count", bins)
