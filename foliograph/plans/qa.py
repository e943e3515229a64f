"""Batch question answering over the chunk index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from foliograph.functions.text import blank_to_null, py_strip, snippet, strict_integer
from foliograph.plans.retrieval import with_hits

# Fixed values.
HITS_PER_QUESTION = 8
MAX_POINTS = 3
MAX_SOURCES = 5
NO_EVIDENCE = "No relevant evidence found for this query."


def with_query_text(questions: DataFrame) -> DataFrame:
    """Strip the question and append the filters that are given to its text."""
    question = py_strip(F.coalesce("question", F.lit("")))
    return questions.withColumn("question", question).withColumn(
        "query_text",
        F.concat(
            F.col("question"),
            F.coalesce(F.concat(F.lit(" category "), blank_to_null("category_filter")), F.lit("")),
            F.coalesce(F.concat(F.lit(" year "), blank_to_null("year_filter")), F.lit("")),
        ),
    )


def _passes(hit: Column) -> Column:
    """A hit against both filters; a filter that is absent or no year passes all."""
    category = blank_to_null("category_filter")
    year = F.col("_year_wanted")
    return (category.isNull() | (py_strip(hit["category"]) == py_strip(category))) & (
        year.isNull() | (hit["year"] == year)
    )


def with_filtered_hits(found: DataFrame) -> DataFrame:
    """Add ``kept``: the hits that pass the filters, or all of them if none does."""
    passing = F.filter("hits", _passes)
    return (
        found.withColumn("_year_wanted", strict_integer("year_filter"))
        .withColumn("_passing", passing)
        .withColumn("kept", F.when(F.size("_passing") > 0, F.col("_passing")).otherwise(F.col("hits")))
        .drop("_year_wanted", "_passing")
    )


def answer_text(kept: Column | str, max_points: int = MAX_POINTS) -> Column:
    """``title: snippet`` of the first hits, joined by spaces."""
    points = F.transform(
        F.slice(kept, 1, max_points),
        lambda hit: F.concat(py_strip(hit["title"]), F.lit(": "), snippet(hit["chunk_text"])),
    )
    return F.when(F.size(kept) > 0, F.array_join(points, " ")).otherwise(F.lit(NO_EVIDENCE))


def sources(kept: Column | str, max_sources: int = MAX_SOURCES) -> Column:
    """First hit of each paper in rank order, blank ids skipped, at most five."""
    entries = F.transform(
        kept,
        lambda hit: F.struct(
            py_strip(hit["arxiv_id"]).alias("arxiv_id"),
            py_strip(hit["title"]).alias("title"),
            py_strip(hit["category"]).alias("category"),
            hit["year"].alias("year"),
            py_strip(hit["pub_status"]).alias("pub_status"),
            hit["distance"].alias("distance"),
        ),
    )
    ids = F.transform(kept, lambda hit: py_strip(hit["arxiv_id"]))
    first = F.filter(
        entries,
        lambda entry, i: (entry["arxiv_id"] != "") & (F.array_position(ids, entry["arxiv_id"]) == i + 1),
    )
    return F.slice(first, 1, max_sources)


def questions_with_hits(
    questions: DataFrame, chunks: DataFrame, k: int = HITS_PER_QUESTION, **options
) -> DataFrame:
    """Questions with their hits and the hits kept after filtering."""
    if options.get("backend", "hashed") != "hashed":
        # One request per question, so that a failure concerns that one only.
        options = {"batch": 1, "on_error": "record", **options}
    return with_filtered_hits(with_hits(with_query_text(questions), chunks, k, **options))


def answer_questions(
    questions: DataFrame,
    chunks: DataFrame,
    k: int = HITS_PER_QUESTION,
    model: str = "hashed",
    keep: tuple[str, ...] = (),
    **options,
) -> DataFrame:
    """One answer record per question, plus the question columns named in ``keep``.

    ``questions`` needs ``id, question, category_filter, year_filter``.  A
    question whose embedding failed is answered with the failure and no
    sources.
    """
    found = questions_with_hits(questions, chunks, k, **options)
    failed = F.concat(F.lit("Query failed: "), F.col("error"))
    return found.select(
        F.col("id").alias("question_id"),
        "question",
        F.coalesce(failed, answer_text("kept")).alias("answer"),
        sources("kept").alias("sources"),
        F.lit(model).alias("model_used"),
        "category_filter",
        "year_filter",
        *keep,
    )


def source_rows(answers: DataFrame) -> DataFrame:
    """Sources of answers, one row each, with their position."""
    return answers.select("question_id", F.posexplode("sources").alias("at", "s")).select(
        "question_id", (F.col("at") + 1).alias("position"), "s.*"
    )


def grade_answers(answers: DataFrame) -> DataFrame:
    """Listed keywords found in each answer, ignoring case, against the minimum.

    ``answers`` carries the question's ``grading`` struct (see ``keep``).
    """
    answer = F.lower("answer")
    found = F.filter("grading.must_contain_any", lambda word: F.contains(answer, F.lower(word)))
    return answers.withColumn("keyword_hits", F.size(found)).select(
        "question_id",
        "keyword_hits",
        F.col("grading.min_keyword_hits").alias("min_keyword_hits"),
        (F.col("keyword_hits") >= F.col("grading.min_keyword_hits")).alias("passed"),
    )
