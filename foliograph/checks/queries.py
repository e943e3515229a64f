"""Every operator as a query over whole test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import partial

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession, functions as F

from foliograph.functions.text import py_words, word_count
from foliograph.functions.vectors import postings, unit
from foliograph.operators.approximate import approximate_nearest, candidates, with_sketch
from foliograph.operators.inverted_file import build_inverted_file
from foliograph.operators.knn import nearest
from foliograph.operators.sampling import sample_rows
from foliograph.operators.vector_cache import VectorCache
from foliograph.plans import adapter, clean, index, qa, retrieval, stats, summaries
from foliograph.plans.embed import embed
from foliograph.plans.listing import list_papers, list_papers_after, with_page_count
from foliograph.session import kept, scratch_path
from foliograph.sources.chunk_store import ChunkStore
from foliograph.sources.delimited import read_records, write_records
from foliograph.sources.documents import read_questions, write_json
from foliograph.sources.tables import CLEAN_TABLES, RAW_TABLE, ensure_clean_tables, replace_table

# Parameters of the registered queries; the SQL uses the same ones.
FILTER_CATEGORIES = ("x.1", "en.src3")
SAMPLE_SIZE = 250
SAMPLE_FRAC = 0.25
SEED = 42
PAGE_LIMIT, PAGE_OFFSET = 50, 10
DEEP_OFFSET, DEEP_ROWS = 120, 16  # a page beyond what its top-k may hold
PAGE_AFTER = (2015, "5")
NEIGHBOURS = 8
CODED_DEPTH = 32  # codes measured exactly per query
PROBED_TENTHS = 8  # cells probed, of ten; the vectors are spread evenly, without clusters
OLD_CHUNKS = (100, 20)  # size and overlap of the chunks already stored
LETTERS = "eatn"  # counted by the stand-in for an external model
REFUSED = " category en.src"  # texts with this are refused by it


def _raw(spark: SparkSession, sf: str) -> DataFrame:
    return clean.raw_papers(adapter.paper_records(spark, sf))


def _papers(spark: SparkSession, sf: str) -> DataFrame:
    return clean.clean_papers(_raw(spark, sf))


def _narrow_papers(spark: SparkSession, sf: str) -> DataFrame:
    """The papers for statistics that read no abstract."""
    return clean.clean_papers(_raw(spark, sf), abstracts=False)


def _prepared(spark: SparkSession, sf: str) -> DataFrame:
    return summaries.prepare_papers(_papers(spark, sf))


def _eligible(spark: SparkSession, sf: str) -> DataFrame:
    return index.eligible_papers(_papers(spark, sf))


def _chunks(spark: SparkSession, sf: str) -> DataFrame:
    return index.chunk_papers(_eligible(spark, sf))


def _index(spark: SparkSession, sf: str) -> DataFrame:
    """The chunk table, built into shared storage and read back."""
    store = ChunkStore(spark, scratch_path(spark, "index"))
    return index.ensure_index(_papers(spark, sf), store)


def raw_papers(spark, sf):
    return _raw(spark, sf)


def category_filter(spark, sf):
    kept = clean.filter_categories(adapter.paper_records(spark, sf), FILTER_CATEGORIES)
    return clean.raw_papers(kept).select("arxiv_id", "categories", "primary_category", "updated")


def dedup(spark, sf):
    return clean.deduplicated(_raw(spark, sf))


def submitted_year(spark, sf):
    rows = clean.with_submitted_year(clean.deduplicated(_raw(spark, sf), abstracts=False))
    return rows.select("arxiv_id", "submitted", "submitted_year")


def abstract_words(spark, sf):
    rows = clean.deduplicated(_raw(spark, sf))
    return rows.select("arxiv_id", word_count("abstract").cast("bigint").alias("abstract_word_count"))


def author_count(spark, sf):
    rows = clean.with_author_count(clean.deduplicated(_raw(spark, sf), abstracts=False))
    return rows.select("arxiv_id", F.col("author_count").cast("bigint").alias("author_count"))


def papers_clean(spark, sf):
    return _papers(spark, sf).withColumns(
        {c: F.col(c).cast("bigint") for c in ("abstract_word_count", "author_count")}
    )


def _statistic(function: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf: function(_narrow_papers(spark, sf))


def author_category(spark, sf):
    return stats.author_categories(_narrow_papers(spark, sf)).select("author", "category", "category_count")


def paper_listing(spark, sf):
    return with_page_count(list_papers(_papers(spark, sf), PAGE_LIMIT, PAGE_OFFSET))


def paper_listing_deep(spark, sf):
    return list_papers(_papers(spark, sf), PAGE_LIMIT, DEEP_OFFSET, top_k_rows=DEEP_ROWS)


def chart_prep(spark, sf):
    return _prepared(spark, sf).select(
        "arxiv_id", "primary_category", "pub_status", "submitted_year", "abstract_word_count"
    )


def length_histogram(spark, sf):
    rows = summaries.length_histogram(_prepared(spark, sf))
    return rows.select(
        "category_group",
        F.col("bin").cast("bigint").alias("bin"),
        F.round("left_edge", 6).alias("left_edge"),
        F.round("right_edge", 6).alias("right_edge"),
        F.col("row_count").cast("bigint").alias("row_count"),
        F.round("density", 6).alias("density"),
    )


def index_eligible(spark, sf):
    return _eligible(spark, sf)


def chunks(spark, sf):
    return _chunks(spark, sf).withColumn("chunk_idx", F.col("chunk_idx").cast("bigint"))


def chunk_append(spark, sf):
    """Published papers are stored with shorter chunks first; then everything is appended, twice."""
    eligible = _eligible(spark, sf)
    store = ChunkStore(spark, scratch_path(spark, "append"))
    store.replace(index.chunk_papers(eligible.filter("pub_status = 'Published'"), *OLD_CHUNKS))
    store.append(index.chunk_papers(eligible), source="papers", batch=0)
    store.append(index.chunk_papers(eligible), source="papers", batch=0)
    return store.read().select("chunk_id", "arxiv_id", "chunk_text")


def knn_organised(spark, sf):
    """The hits of ``knn_text`` from a store sorted by id, their texts read from the files that hold them."""
    store = ChunkStore(spark, scratch_path(spark, "index"))
    index.build_index(_papers(spark, sf), store)
    store.organise()
    asked = qa.with_query_text(adapter.questions(spark, sf)).select(F.col("id").alias("question_id"), "query_text")
    hits = retrieval.retrieve(asked, store.read(), NEIGHBOURS, keyed=store.keyed_files())
    return hits.drop("query_text").withColumns({"rank": F.col("rank").cast("bigint"), "distance": F.round("distance", 6)})


def index_summary(spark, sf):
    return index.summarize(_index(spark, sf))


def hashed_tf(spark, sf):
    return _postings(spark, sf).select("chunk_id", "bucket", "tf")


def embed_postings(spark, sf):
    return _postings(spark, sf).select("chunk_id", "bucket", F.round("weight", 6).alias("weight"))


def _postings(spark, sf):
    rows = postings(index.with_vectors(_chunks(spark, sf).select("chunk_id", "chunk_text")), "chunk_id")
    return rows.withColumns({c: F.col(c).cast("bigint") for c in ("bucket", "tf")})


def l2_normalize(spark, sf):
    rows = adapter.vectors(spark, sf).select("vec_id", F.posexplode(unit("embedding")).alias("i", "x"))
    return rows.select("vec_id", (F.col("i") + 1).cast("bigint").alias("position"), F.round("x", 6).alias("value"))


def _centroids(vectors: DataFrame) -> DataFrame:
    """One query per label: the mean of its vectors."""
    mean = Summarizer.mean(array_to_vector(F.col("embedding").cast("array<double>")))
    return vectors.groupBy(F.col("label").cast("string").alias("query_key")).agg(
        vector_to_array(mean).alias("embedding")
    )


def knn_vectors(spark, sf):
    vectors = adapter.vectors(spark, sf)
    found = nearest(vectors, _centroids(vectors), NEIGHBOURS, id_col="vec_id")
    return found.select(
        F.col("query_key").alias("label"),
        F.col("rank").cast("bigint").alias("rank"),
        "vec_id",
        F.round("distance", 6).alias("distance"),
    )


def ann_recall(spark, sf):
    """Recall of the approximate search and the share of all pairs it measured exactly."""
    vectors = adapter.vectors(spark, sf)
    centroids = _centroids(vectors)
    path = scratch_path(spark, "sketches")
    with_sketch(vectors.select("vec_id", "embedding")).write.parquet(path)
    sketched = spark.read.parquet(path)
    exact = nearest(vectors, centroids, NEIGHBOURS, id_col="vec_id").select("query_key", "vec_id")
    near = approximate_nearest(sketched, centroids, NEIGHBOURS, id_col="vec_id").select("query_key", "vec_id")
    found = exact.join(near, ["query_key", "vec_id"], "left_semi").agg(F.count("*")).scalar()
    searched = candidates(sketched, centroids, id_col="vec_id").agg(F.count("*")).scalar()
    pairs = vectors.agg(F.count("*")).scalar() * centroids.agg(F.count("*")).scalar()
    return exact.agg(F.count("*").alias("expected")).select(
        "expected",
        found.alias("found"),
        F.round(found / F.col("expected"), 6).alias("recall"),
        F.round(searched / pairs, 6).alias("searched_share"),
    )


def inverted_recall(spark, sf):
    """Recall of the inverted file, and what it reads per query: codes of half a byte a dimension, and vectors of four."""
    vectors = adapter.vectors(spark, sf)
    centroids = _centroids(vectors)
    built = build_inverted_file(vectors, scratch_path(spark, "inverted"), id_col="vec_id")
    probes = -(-PROBED_TENTHS * len(built.centroids) // 10)
    found = built.search(centroids, NEIGHBOURS, probes=probes, depth=CODED_DEPTH).select("query_key", "vec_id")
    exact = nearest(vectors, centroids, NEIGHBOURS, id_col="vec_id").select("query_key", "vec_id")
    hits = exact.join(found.withColumn("hit", F.lit(1)), ["query_key", "vec_id"], "left")
    hits = kept(hits.groupBy("query_key").agg(F.count("*").alias("expected"), F.count("hit").alias("found")))
    read = built.probes_of(centroids, probes).join(built.sizes(), "cell").groupBy("query_key").agg(F.sum("vectors").alias("coded"))
    total = vectors.agg(F.count("*")).scalar()
    sums = hits.join(read, "query_key").agg(
        F.sum("expected").alias("expected"),
        F.sum("found").alias("found"),
        F.sum("coded").alias("coded"),
        F.sum(F.least("coded", F.lit(CODED_DEPTH))).alias("measured"),
        (F.count("*") * total).alias("pairs"),
    )
    return sums.select(
        "expected",
        "found",
        F.round(F.col("found") / F.col("expected"), 6).alias("recall"),
        F.round(F.col("coded") / F.col("pairs"), 6).alias("coded_share"),
        F.round(F.col("measured") / F.col("pairs"), 6).alias("measured_share"),
        F.round((F.col("coded") / 8 + F.col("measured")) / F.col("pairs"), 6).alias("bytes_share"),
    )


def query_text(spark, sf):
    rows = qa.with_query_text(adapter.questions(spark, sf))
    return rows.select(F.col("id").alias("question_id"), "query_text")


def knn_text(spark, sf):
    asked = qa.with_query_text(adapter.questions(spark, sf)).select(
        F.col("id").alias("question_id"), "query_text"
    )
    hits = retrieval.retrieve(asked, _index(spark, sf), NEIGHBOURS)
    return hits.drop("query_text").withColumns(
        {"rank": F.col("rank").cast("bigint"), "distance": F.round("distance", 6)}
    )


def knn_blocks(spark, sf):
    """The hits of ``knn_text`` by the blocks' largest weights."""
    path = scratch_path(spark, "blocks")
    store = ChunkStore(spark, scratch_path(spark, "index"))
    index.build_index(_papers(spark, sf), store)
    blocks = index.block_index(store, path)
    asked = qa.with_query_text(adapter.questions(spark, sf)).select(F.col("id").alias("question_id"), "query_text")
    hits = retrieval.retrieve(asked, store.read(), NEIGHBOURS, search=blocks.nearest)
    return hits.select("question_id", F.col("rank").cast("bigint").alias("rank"), "chunk_id", F.round("distance", 6).alias("distance"))


def rag_filter(spark, sf):
    found = qa.questions_with_hits(adapter.questions(spark, sf), _index(spark, sf))
    return found.select(F.col("id").alias("question_id"), F.inline("kept")).select(
        "question_id",
        F.col("rank").cast("bigint").alias("rank"),
        "chunk_id",
        "category",
        "year",
        F.round("distance", 6).alias("distance"),
    )


def _answers(spark, sf, questions=None, **options):
    asked = adapter.questions(spark, sf) if questions is None else questions
    return qa.answer_questions(asked, _index(spark, sf), **options)


def rag_sources(spark, sf):
    return qa.source_rows(_answers(spark, sf)).withColumns(
        {"position": F.col("position").cast("bigint"), "distance": F.round("distance", 6)}
    )


def answers(spark, sf):
    return (
        _answers(spark, sf)
        .withColumn("source_count", F.size("sources").cast("bigint"))
        .drop("sources")
    )


def _graded_questions(spark, sf):
    grading = F.struct(
        F.lit("keyword_match").alias("type"),
        F.array_distinct(py_words("question")).alias("must_contain_any"),
        F.lit(2).alias("min_keyword_hits"),
    )
    return adapter.questions(spark, sf).withColumn("grading", grading)


def grade_answers(spark, sf):
    graded = qa.grade_answers(_answers(spark, sf, _graded_questions(spark, sf), keep=("grading",)))
    return graded.withColumns(
        {c: F.col(c).cast("bigint") for c in ("keyword_hits", "min_keyword_hits")}
    )


def sample_n(spark, sf):
    return sample_rows(_raw(spark, sf), size=SAMPLE_SIZE, seed=SEED)


def sample_frac(spark, sf):
    return sample_rows(_raw(spark, sf), frac=SAMPLE_FRAC, seed=SEED)


def csv_ingest(spark, sf):
    path = scratch_path(spark, "records")
    write_records(adapter.paper_records(spark, sf), path)
    return clean.raw_papers(read_records(spark, path))


def paper_listing_after(spark, sf):
    return list_papers_after(_papers(spark, sf), *PAGE_AFTER, PAGE_LIMIT)


def questions_source(spark, sf):
    """The questions with their grading, exported as JSON lines and read as a question list."""
    path = scratch_path(spark, "questions")
    write_json(_graded_questions(spark, sf), path)
    return read_questions(spark, path, json_lines=True).select(
        F.col("id").cast("bigint").alias("question_id"),
        "question",
        "category_filter",
        "year_filter",
        F.col("grading.type").alias("grading_type"),
        F.array_join("grading.must_contain_any", "|").alias("keywords"),
        F.col("grading.min_keyword_hits").cast("bigint").alias("min_keyword_hits"),
    )


def table_refresh(spark, sf):
    """Rows of all five tables after a refresh from the stored raw table, in a database of its own."""
    name = f"refresh_{uuid.uuid4().hex}"
    before = spark.catalog.currentDatabase()
    spark.sql(f"create database {name} location '{scratch_path(spark, 'tables')}'")
    spark.catalog.setCurrentDatabase(name)
    try:
        replace_table(_raw(spark, sf), RAW_TABLE)
        ensure_clean_tables(spark, rebuild=True)
    finally:
        spark.catalog.setCurrentDatabase(before)
    keys = {
        "papers": ("arxiv_id", "pub_status", "abstract_word_count"),
        "category_stats": ("category", "publish_rate_pct", "total_papers"),
        "yearly_trends": ("category", "year", "paper_count"),
        "publication_status": ("category", "pub_status", "paper_count"),
        "author_stats": ("author", "top_category", "paper_count"),
    }
    parts = [
        spark.table(f"{name}.{table}").select(
            F.lit(table).alias("table_name"),
            F.col(keys[table][0]).alias("key"),
            F.col(keys[table][1]).cast("string").alias("detail"),
            F.col(keys[table][2]).cast("bigint").alias("number"),
        )
        for table in CLEAN_TABLES
    ]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows


def collections(spark, sf):
    """Two collections under one root; a reset of the second one leaves the first as it is."""
    root = scratch_path(spark, "collections")
    # Cleaned once, for three builds; the index reads no word count.
    path = scratch_path(spark, "papers")
    _papers(spark, sf).drop("abstract_word_count").write.parquet(path)
    papers = spark.read.parquet(path)
    main, recent = ChunkStore(spark, root), ChunkStore(spark, root, "recent")
    index.build_index(papers, main)
    index.build_index(papers, recent, False, *OLD_CHUNKS)
    index.build_index(papers.filter("pub_status = 'published'"), recent, reset=True)

    def sizes(store: ChunkStore) -> DataFrame:
        held = store.read().groupBy("arxiv_id").agg(F.count("*").alias("chunks"))
        return held.select(F.lit(store.collection).alias("collection"), "arxiv_id", "chunks")

    return sizes(main).unionByName(sizes(recent))


def index_health(spark, sf):
    store = ChunkStore(spark, scratch_path(spark, "health"))
    index.ensure_index(_papers(spark, sf), store)
    return index.index_health(spark, store).select("status", "index_chunks", "collection", "embedding_backend")


def letter_model(refused: str | None = None) -> Callable:
    """A stand-in for an external model: length and letter counts, answered in reverse order."""

    def model(texts: list[str]) -> list[dict]:
        if refused and any(refused in text for text in texts):
            raise ValueError("refused")
        items = [
            {"index": i, "embedding": [float(len(t)), *(float(t.count(c)) for c in LETTERS)]}
            for i, t in enumerate(texts)
        ]
        return items[::-1]

    return model


def external_embed(spark, sf):
    return _letter_vectors(_chunks(spark, sf))


def _letter_vectors(chunks, **options):
    rows = embed(chunks, "chunk_text", "External", factory=letter_model, normalize=True, **options)
    return rows.select("chunk_id", F.posexplode("embedding").alias("i", "x")).select(
        "chunk_id", (F.col("i") + 1).cast("bigint").alias("position"), F.round("x", 6).alias("value")
    )


def external_cached(spark, sf):
    """The vectors of ``external_embed``; those of published papers come from an earlier run's cache."""
    cache = VectorCache(spark, scratch_path(spark, "vectors"), "letters")
    chunks = kept(_chunks(spark, sf))
    _letter_vectors(chunks.filter("pub_status = 'Published'"), cache=cache)
    return _letter_vectors(chunks, cache=cache)


def external_answers(spark, sf):
    """Answers with an external model that refuses some questions: the failure is their answer."""
    store = ChunkStore(spark, scratch_path(spark, "external"))
    chunks = index.ensure_index(_papers(spark, sf), store, backend="external", factory=letter_model)
    answered = qa.answer_questions(
        adapter.questions(spark, sf), chunks, model="letters", backend="external",
        factory=partial(letter_model, REFUSED), attempts=2, backoff=0.0,
    )
    failed = F.col("answer").startswith("Query failed: ")
    return answered.select(
        "question_id",
        failed.alias("failed"),
        F.when(failed, F.col("answer")).alias("failure"),
        (F.size("sources") > 0).alias("has_sources"),
        "model_used",
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "raw_papers": raw_papers,
    "category_filter": category_filter,
    "dedup": dedup,
    "submitted_year": submitted_year,
    "word_count": abstract_words,
    "author_count": author_count,
    "papers_clean": papers_clean,
    "category_stats": _statistic(stats.category_stats),
    "yearly_trends": _statistic(stats.yearly_trends),
    "publication_status": _statistic(stats.publication_status),
    "author_explode": _statistic(stats.paper_authors),
    "author_category": author_category,
    "author_top_category": _statistic(stats.author_top_category),
    "author_stats": _statistic(stats.author_stats),
    "paper_listing": paper_listing,
    "paper_listing_deep": paper_listing_deep,
    "chart_prep": chart_prep,
    "top_categories": lambda spark, sf: summaries.largest_categories(_prepared(spark, sf)),
    "category_pivot": lambda spark, sf: summaries.category_pivot(_prepared(spark, sf)),
    "year_trend_top5": lambda spark, sf: summaries.year_trend(_prepared(spark, sf)),
    "status_share": lambda spark, sf: summaries.status_share(_prepared(spark, sf)),
    "length_histogram": length_histogram,
    "index_eligible": index_eligible,
    "chunks": chunks,
    "chunk_append": chunk_append,
    "index_summary": index_summary,
    "hashed_tf": hashed_tf,
    "embed_postings": embed_postings,
    "l2_normalize": l2_normalize,
    "knn_vectors": knn_vectors,
    "ann_recall": ann_recall,
    "inverted_recall": inverted_recall,
    "query_text": query_text,
    "knn_text": knn_text,
    "knn_blocks": knn_blocks,
    "knn_organised": knn_organised,
    "rag_filter": rag_filter,
    "rag_sources": rag_sources,
    "answers": answers,
    "grade_answers": grade_answers,
    "sample_n": sample_n,
    "sample_frac": sample_frac,
    "csv_ingest": csv_ingest,
    "paper_listing_after": paper_listing_after,
    "questions_source": questions_source,
    "table_refresh": table_refresh,
    "collections": collections,
    "index_health": index_health,
    "external_embed": external_embed,
    "external_cached": external_cached,
    "external_answers": external_answers,
}
