"""Papers to embedded chunks."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from foliograph.functions.text import py_strip, py_words, status_label, strict_integer
from foliograph.operators.block_max import BlockIndex, build_blocks
from foliograph.operators.inverted_file import InvertedFile, build_inverted_file
from foliograph.plans.embed import embed
from foliograph.sources.chunk_store import ChunkStore

# Words per chunk and words shared with the previous chunk.
CHUNK_SIZE = 200
CHUNK_OVERLAP = 40
# Texts cut into windows at a time.
TEXTS_AT_ONCE = 200


def eligible_papers(papers: DataFrame) -> DataFrame:
    """Papers fit for the index: five non-blank texts and a whole-number year."""
    whole = isinstance(papers.schema["submitted_year"].dataType, T.IntegralType)
    rows = papers.select(
        py_strip("arxiv_id").alias("arxiv_id"),
        py_strip("title").alias("title"),
        py_strip("abstract").alias("abstract"),
        py_strip("primary_category").alias("category"),
        (F.col("submitted_year") if whole else strict_integer("submitted_year")).cast("bigint").alias("year"),
        status_label("pub_status").alias("pub_status"),
        py_strip("first_author").alias("first_author"),
    ).filter(F.col("year").isNotNull())
    for name in ("arxiv_id", "title", "abstract", "category", "first_author"):
        rows = rows.filter(F.col(name) != "")
    return rows


def _window_count(words: Column, size: int, step: int) -> Column:
    """Windows over a text of at least one word."""
    return (F.greatest(F.ceil((words - size) / F.lit(step)), F.lit(0)) + 1).cast("int")


def _windows(texts: pa.Array, size: int, step: int) -> tuple[list[int], list[int], list[str]]:
    """Text number, window number and window of each window; ``str.split`` cuts as ``py_words`` does."""
    row, number, window = [], [], []
    for at, text in enumerate(texts.to_pylist()):
        words = text.split()
        for i in range(max(-(-(len(words) - size) // step), 0) + 1):
            row.append(at)
            number.append(i)
            window.append(" ".join(words[i * step : i * step + size]))
    return row, number, window


def chunk_papers(papers: DataFrame, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> DataFrame:
    """Overlapping word windows of each abstract.

    A window starts every ``size - overlap`` words; the first one to reach the
    end of the text is the last.  Tasks cut Arrow batches of texts, each text in
    time that grows with its length.
    """
    if size <= 0:
        raise ValueError("chunk size must be positive")
    if not 0 <= overlap < size:
        raise ValueError("chunk overlap must be at least 0 and below the chunk size")
    step = size - overlap
    about = ("arxiv_id", "title", "category", "year", "pub_status", "first_author")
    texts = papers.filter(py_strip("abstract") != "").select(*about, F.make_valid_utf8("abstract").alias("abstract"))
    made = [T.StructField("chunk_idx", T.IntegerType()), T.StructField("chunk_text", T.StringType())]
    schema = T.StructType([*(texts.schema[name] for name in about), *made])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
                *kept, texts = batch.slice(at, TEXTS_AT_ONCE).columns
                row, number, window = _windows(texts, size, step)
                columns = [column.take(pa.array(row)) for column in kept]
                columns += [pa.array(number, pa.int32()), pa.array(window, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return texts.mapInArrow(cut, schema).select(
        F.concat_ws(":", "arxiv_id", "chunk_idx").alias("chunk_id"),
        "chunk_idx",
        "chunk_text",
        *about,
    )


def embedded_chunks(
    papers: DataFrame,
    size: int = CHUNK_SIZE,
    overlap: int = CHUNK_OVERLAP,
    backend: str = "hashed",
    **options,
) -> DataFrame:
    """Chunk table with vectors, ready for the store."""
    return with_vectors(chunk_papers(eligible_papers(papers), size, overlap), backend, **options)


def with_vectors(chunks: DataFrame, backend: str = "hashed", **options) -> DataFrame:
    return embed(chunks, "chunk_text", backend, **options).drop("error")


def summarize(chunks: DataFrame) -> DataFrame:
    """One row: papers and chunks held."""
    return chunks.agg(
        F.count_distinct("arxiv_id").alias("papers"), F.count("*").alias("chunks")
    )


def build_index(
    papers: DataFrame,
    store: ChunkStore,
    reset: bool = False,
    size: int = CHUNK_SIZE,
    overlap: int = CHUNK_OVERLAP,
    backend: str = "hashed",
    source: str | None = None,
    batch: int | None = None,
    **options,
) -> DataFrame:
    """Embed all eligible papers into the store; known chunk ids are kept as they are.

    Known chunks leave before the vectors are made, and a ``batch`` of a
    ``source`` that was added before is not looked at.  Returns the build
    summary: eligible papers and the chunks they give.
    """
    chunks = chunk_papers(eligible_papers(papers), size, overlap)
    if reset:
        store.replace(with_vectors(chunks, backend, **options))
    else:
        store.append(chunks, lambda new: with_vectors(new, backend, **options), source, batch)
    made = _window_count(F.size(py_words("abstract")), size, size - overlap)
    return eligible_papers(papers).agg(
        F.count("*").alias("papers"), F.coalesce(F.sum(made), F.lit(0)).alias("chunks")
    )


def ensure_index(papers: DataFrame, store: ChunkStore, **options) -> DataFrame:
    """The stored chunks, built first when the collection is empty."""
    if store.is_empty():
        build_index(papers, store, **options)
    return store.read()


def inverted_index(store: ChunkStore, path: str, **options) -> InvertedFile:
    """An inverted file of the stored chunks' vectors; its ``search`` can take the place of the exact one."""
    return build_inverted_file(store.read(), path, **options)


def block_index(store: ChunkStore, path: str, **options) -> BlockIndex:
    """Blocks of the stored chunks' hashed vectors with their largest weights; same hits as the exact search."""
    return build_blocks(store.read(), path, **options)


def index_health(spark: SparkSession, store: ChunkStore, backend: str = "hashed", model: str = "hashed") -> DataFrame:
    """One row: stored chunks, the back end that made them (the one asked for while there are none), and the model's name."""
    held = store.snapshot()
    return spark.createDataFrame(
        [("ok", store.size(), store.collection, store.path, store.backend() or backend, model, held["number"] if held else 0)],
        "status string, index_chunks long, collection string, path string, embedding_backend string, embedding_model string, snapshot long",
    )
