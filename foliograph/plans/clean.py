"""Raw paper records to the cleaned ``papers`` table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from foliograph.functions.text import (
    before_first,
    comma_names,
    prefix_integer,
    py_words,
    space_tokens,
    sql_trim,
    word_count,
)

# Categories kept when the caller names none.
DEFAULT_CATEGORIES = ("cs.AI", "cs.LG", "cs.CL", "stat.ML", "cs.CV")

# Input column -> raw table column.
RAW_COLUMNS = {
    "id": "arxiv_id",
    "title": "title",
    "abstract": "abstract",
    "authors": "authors",
    "categories": "categories",
    "submitted": "submitted",
    "update_date": "updated",
    "journal-ref": "journal_ref",
    "doi": "doi",
    "comments": "comment",
}

_TRIMMED = (
    "title", "abstract", "authors", "primary_category", "submitted",
    "updated", "journal_ref", "doi", "comment",
)
_MANDATORY = ("title", "abstract", "authors", "primary_category", "submitted")


def filter_categories(df: DataFrame, categories: Sequence[str] | None = DEFAULT_CATEGORIES) -> DataFrame:
    """Keep rows with any listed category among their whitespace tokens.

    An empty list keeps every row; a null category field never matches.
    """
    if not categories:
        return df
    wanted = F.array(*[F.lit(c) for c in categories])
    return df.filter(F.arrays_overlap(py_words("categories"), wanted))


def raw_papers(records: DataFrame) -> DataFrame:
    """Ten input columns to the eleven-column raw table, all strings."""
    renamed = [
        F.col(f"`{source}`").cast("string").alias(target) for source, target in RAW_COLUMNS.items()
    ]
    at = list(RAW_COLUMNS).index("categories") + 1
    primary = F.get(py_words("categories"), F.lit(0)).alias("primary_category")
    return records.select(*renamed[:at], primary, *renamed[at:])


def trimmed(raw: DataFrame) -> DataFrame:
    """Space-trimmed columns, null as empty text; rows without an id are dropped."""
    return raw.select(
        sql_trim(F.col("arxiv_id").cast("string")).alias("arxiv_id"),
        *[sql_trim(F.coalesce(F.col(c), F.lit(""))).alias(c) for c in _TRIMMED],
    ).filter(F.col("arxiv_id") != "")


def deduplicated(raw: DataFrame, abstracts: bool = True) -> DataFrame:
    """One row per id: latest ``submitted``, then latest ``updated``, then first title.

    Dates compare as text.  Incomplete rows leave before the ranking, so they
    never shadow a complete one.  Remaining ties are settled by the other
    columns, short ones first, which makes the choice independent of
    partitioning.  ``row_number = 1`` is limited inside each map task before
    the shuffle, so an id with very many copies sends one row per task.

    The abstract is the last column to settle a tie: rows that reach it are
    equal in all others.  Without ``abstracts`` it is neither ranked by nor
    returned, so no text is shuffled, and the other columns are the same.
    """
    complete = trimmed(raw)
    for name in _MANDATORY:
        complete = complete.filter(F.col(name) != "")
    ties = ["title", "primary_category", "journal_ref", "doi", "comment", "authors"]
    if abstracts:
        ties.append("abstract")
    else:
        complete = complete.drop("abstract")
    latest = Window.partitionBy("arxiv_id").orderBy(F.desc("submitted"), F.desc("updated"), *ties)
    return complete.withColumn("rn", F.row_number().over(latest)).filter("rn = 1").drop("rn")


def with_submitted_year(unique: DataFrame) -> DataFrame:
    """Add the numeric prefix of the fourth date token; rows without one are dropped."""
    fourth = F.get(space_tokens("submitted"), F.lit(3))
    return unique.withColumn("submitted_year", prefix_integer(fourth)).filter(
        F.col("submitted_year").isNotNull()
    )


def with_author_count(unique: DataFrame) -> DataFrame:
    """Add the number of non-blank names; rows without any are dropped."""
    return unique.withColumn("author_count", F.size(comma_names("authors"))).filter("author_count > 0")


def clean_papers(raw: DataFrame, abstracts: bool = True) -> DataFrame:
    """The ``papers`` table: the only shuffle is the deduplication.

    Without ``abstracts`` the same papers come without the two columns that
    need the text, for statistics that use neither.
    """
    rows = with_author_count(with_submitted_year(deduplicated(raw, abstracts)))
    text = ["abstract", word_count("abstract").alias("abstract_word_count")] if abstracts else []
    return rows.select(
        "arxiv_id",
        "title",
        *text[:1],
        "authors",
        "primary_category",
        "submitted",
        *text[1:],
        "author_count",
        sql_trim(before_first("authors", ",")).alias("first_author"),
        "submitted_year",
        before_first("primary_category", ".").alias("subject_area"),
        F.when(F.col("journal_ref") != "", "published").otherwise("unpublished").alias("pub_status"),
    )
