"""Whole runs and single requests, from stored inputs to stored or small results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from foliograph.plans.index import ensure_index
from foliograph.plans.qa import answer_questions
from foliograph.plans.retrieval import DEFAULT_TOP_K, checked_top_k, retrieve
from foliograph.sources.chunk_store import ChunkStore
from foliograph.sources.documents import read_questions, write_json
from foliograph.sources.tables import papers_table


# Columns of a stored answer.
ANSWER_SCHEMA = (
    "question_id variant, question string, answer string, sources array<struct<arxiv_id: string, "
    "title: string, category: string, year: bigint, pub_status: string, distance: double>>, "
    "model_used string, category_filter string, year_filter string"
)


def _index(spark: SparkSession, store: ChunkStore, options: dict) -> DataFrame:
    if store.is_empty():
        return ensure_index(papers_table(spark), store, **options)
    return store.read()


def semantic_query(
    spark: SparkSession, store: ChunkStore, query: str, top_k: int = DEFAULT_TOP_K, **options
) -> DataFrame:
    """Nearest chunks of one text; builds the index from ``papers`` when it is empty."""
    if not query:
        raise ValueError("query must not be empty")
    checked_top_k(top_k)
    chunks = _index(spark, store, options)
    asked = spark.createDataFrame([(query,)], "query_text string")
    return retrieve(asked, chunks, top_k, **options).drop("query_text")


def answer_file(
    spark: SparkSession,
    store: ChunkStore,
    questions_path: str,
    answers_path: str,
    model: str = "hashed",
    json_lines: bool = False,
    **options,
) -> DataFrame:
    """Answer a stored question list and store the answers; returns them."""
    chunks = _index(spark, store, options)
    questions = read_questions(spark, questions_path, json_lines)
    write_json(answer_questions(questions, chunks, model=model, **options), answers_path)
    return spark.read.schema(ANSWER_SCHEMA).json(answers_path)
