"""Nearest chunks for many query texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F, types as T

from foliograph.functions.text import py_strip
from foliograph.operators.knn import nearest
from foliograph.operators.lookup import KeyedFiles, rows_for
from foliograph.plans.embed import embed
from foliograph.session import kept

DEFAULT_TOP_K = 5
MAX_TOP_K = 50


def checked_top_k(top_k: int) -> int:
    """Bounds of a request: 1 to 50."""
    if not 1 <= top_k <= MAX_TOP_K:
        raise ValueError(f"top_k must be between 1 and {MAX_TOP_K}")
    return top_k


def _hit() -> Column:
    """A hit with defaults for absent metadata."""
    return F.struct(
        F.col("rank"),
        F.col("chunk_id"),
        F.col("chunk_text"),
        F.col("arxiv_id"),
        F.coalesce("title", F.lit("")).alias("title"),
        F.coalesce("category", F.lit("")).alias("category"),
        F.coalesce("year", F.lit(0)).alias("year"),
        F.coalesce("pub_status", F.lit("Preprint")).alias("pub_status"),
        F.coalesce("first_author", F.lit("")).alias("first_author"),
        F.col("distance"),
    )


HIT_FIELDS = (
    "rank", "chunk_id", "chunk_text", "arxiv_id", "title", "category", "year",
    "pub_status", "first_author", "distance",
)


def hits_by_text(
    texts: DataFrame,
    chunks: DataFrame,
    k: int,
    backend: str = "hashed",
    query_block: int | None = None,
    search: Callable[[DataFrame, int], DataFrame] | None = None,
    keyed: KeyedFiles | None = None,
    **options,
) -> DataFrame:
    """``query_key, hits, error`` per distinct non-blank ``query_text``.

    ``hits`` is an array of at most ``k`` structs in rank order.  Copies of a
    text are searched once.  The search reads ids and vectors only; texts and
    metadata are fetched for the winners.  A ``search`` of queries and ``k``
    takes the place of the exact scan, such as ``InvertedFile.search`` or
    ``BlockIndex.nearest`` over the same chunks.  ``keyed`` files of an
    organised store say where the winners are.
    """
    distinct = (
        texts.select(py_strip("query_text").alias("query_text"))
        .filter(F.col("query_text") != "")
        .select(F.md5("query_text").alias("query_key"), "query_text")
        .dropDuplicates(["query_key"])
    )
    asked = embed(distinct, "query_text", backend, **options)
    stored, own = (isinstance(df.schema["embedding"].dataType, T.StructType) for df in (chunks, asked))
    if stored != own:
        raise ValueError("the chunks' vectors were made by another back end than the queries'")
    if backend.lower() != "hashed":
        # The model must be asked once, not once per use of its answer.
        asked = kept(asked)
    # Kept, so that the search runs once and its size is known.
    found = kept(search(asked, k) if search else nearest(chunks, asked, k, query_block=query_block))
    wanted = [f for f in HIT_FIELDS if f not in ("rank", "distance")]
    rows = rows_for(chunks, found, "chunk_id", wanted, keyed=keyed)
    hits = (
        rows.filter(F.col("arxiv_id").isNotNull())
        .groupBy("query_key")
        .agg(F.sort_array(F.collect_list(_hit())).alias("hits"))
    )
    if backend.lower() == "hashed":
        return hits.withColumn("error", F.lit(None).cast("string"))
    failed = asked.select("query_key", "error").filter(F.col("error").isNotNull())
    return hits.join(failed, "query_key", "full")


def with_hits(queries: DataFrame, chunks: DataFrame, k: int, **options) -> DataFrame:
    """``queries`` plus ``hits`` and ``error``; no hits is an empty array.

    Each query row carries its own short list, so everything after this is
    row-local, however many rows ask the same text.
    """
    keyed = queries.withColumn("query_key", F.md5(py_strip("query_text")))
    found = hits_by_text(queries, chunks, k, **options)
    empty = F.array().cast(found.schema["hits"].dataType)
    return (
        keyed.join(found, "query_key", "left")
        .withColumn("hits", F.coalesce("hits", empty))
        .drop("query_key")
    )


def retrieve(queries: DataFrame, chunks: DataFrame, top_k: int = DEFAULT_TOP_K, **options) -> DataFrame:
    """One row per query and hit; ``top_k`` of zero or less means the default.

    ``queries`` needs ``query_text``; its other columns are kept.  A blank
    text gives no rows, a failed embedding is an error.
    """
    k = top_k if top_k > 0 else DEFAULT_TOP_K
    rows = with_hits(queries, chunks, k, **options)
    return rows.select(*queries.columns, F.inline("hits"))


# The request is also known under this older spelling.
retrive = retrieve
