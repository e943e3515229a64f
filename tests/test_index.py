"""Chunks, the chunk store and the streaming sink."""

import pytest
from pyspark.sql import functions as F

from foliograph.plans import adapter, clean, index
from foliograph.sources.chunk_store import ChunkStore
from foliograph.streaming.append import index_batch

PAPER = "arxiv_id string, title string, abstract string, primary_category string, " \
        "submitted_year string, pub_status string, first_author string"


def papers(spark, *rows):
    base = ("1", "T", "w0 w1", "cs.AI", "2007", "published", "A")
    return spark.createDataFrame([tuple(base if r is None else r) for r in rows], PAPER)


def paper(words, arxiv_id="1", status="published"):
    return (arxiv_id, "T", " ".join(f"w{i}" for i in range(words)), "cs.AI", "2007", status, "A")


@pytest.mark.parametrize("words, chunks", [(0, 0), (1, 1), (200, 1), (201, 2), (360, 2), (361, 3)])
def test_chunk_counts(spark, words, chunks):
    df = index.eligible_papers(papers(spark, paper(words)))
    assert index.chunk_papers(df).count() == chunks


@pytest.mark.parametrize("size, overlap", [(7, 0), (7, 3), (1, 0), (5, 4)])
def test_chunks_cover_the_text_with_overlap(spark, size, overlap):
    df = index.eligible_papers(papers(spark, *[paper(n, str(n)) for n in range(1, 30)]))
    by_paper = {}
    for row in index.chunk_papers(df, size, overlap).orderBy("arxiv_id", "chunk_idx").collect():
        assert row["chunk_id"] == f"{row['arxiv_id']}:{row['chunk_idx']}"
        by_paper.setdefault(row["arxiv_id"], []).append(row["chunk_text"].split())
    for n, chunks in by_paper.items():
        merged = chunks[0] + [w for c in chunks[1:] for w in c[overlap:]]
        assert merged == [f"w{i}" for i in range(int(n))]
        assert all(len(c) == size for c in chunks[:-1])


def test_unicode_whitespace_separates_chunk_words(spark):
    df = papers(spark, ("1", "T", " a b c\n", "cs.AI", "2007", "x", "A"))
    assert index.chunk_papers(index.eligible_papers(df)).first()["chunk_text"] == "a b c"


@pytest.mark.parametrize("size, overlap", [(0, 0), (5, 5), (5, -1), (-1, 0)])
def test_chunk_bounds(spark, size, overlap):
    with pytest.raises(ValueError):
        index.chunk_papers(index.eligible_papers(papers(spark, None)), size, overlap)


def test_eligibility(spark):
    base = ["1", "T", "text", "cs.AI", "2007", "published", "A"]
    bad = []
    for at, value in [(0, " "), (1, "\t"), (2, "\n"), (3, None), (4, "abc"), (4, None), (6, "")]:
        row = list(base)
        row[at] = value
        bad.append(row)
    good = [" 2 ", " T\n", "text", " cs.AI", " 2008 ", "PUBLISHED", "A"]
    got = index.eligible_papers(papers(spark, *bad, good, ["3", "T", "x", "c", "1", None, "B"])).collect()
    assert sorted(tuple(r) for r in got) == [
        ("2", "T", "text", "cs.AI", 2008, "Published", "A"),
        ("3", "T", "x", "c", 1, "Preprint", "B"),
    ]


def test_store_lifecycle(spark, tmp_path):
    one = ChunkStore(spark, str(tmp_path), "one")
    two = ChunkStore(spark, str(tmp_path), "two")
    assert one.is_empty() and one.size() == 0
    with pytest.raises(ValueError):
        one.read()
    first = papers(spark, paper(250, "a"), paper(10, "b"))
    summary = index.build_index(first, one).first()
    assert tuple(summary) == (2, 3) and one.size() == 3
    assert two.size() == 0  # collections are isolated

    # known ids stay as they are, new ones are added
    changed = papers(spark, ("a", "new title", "other words", "cs.AI", "2007", "x", "A"), paper(5, "c"))
    index.build_index(changed, one)
    rows = {r["chunk_id"]: r for r in one.read().collect()}
    assert set(rows) == {"a:0", "a:1", "b:0", "c:0"} and rows["a:0"]["title"] == "T"
    index.build_index(changed, one)
    assert one.size() == 4

    index.build_index(changed, one, reset=True)
    assert {r["chunk_id"] for r in one.read().collect()} == {"a:0", "c:0"}
    assert one.read().filter("title = 'new title'").count() == 1


def test_empty_build(spark, tmp_path):
    store = ChunkStore(spark, str(tmp_path), "none")
    assert tuple(index.build_index(papers(spark, paper(0)), store).first()) == (0, 0)
    assert store.is_empty()


def test_index_is_built_once(spark, tmp_path):
    store = ChunkStore(spark, str(tmp_path), "gate")
    assert index.ensure_index(papers(spark, paper(3, "a")), store).count() == 1
    # not empty any more: the second call reads what is there
    assert index.ensure_index(papers(spark, paper(3, "b")), store).first()["arxiv_id"] == "a"
    health = index.index_health(spark, store).first()
    assert (health["status"], health["index_chunks"], health["collection"]) == ("ok", 1, "gate")


@pytest.mark.parametrize("name", ["", "../x", "a/b", ".hidden"])
def test_collection_names(spark, tmp_path, name):
    with pytest.raises(ValueError):
        ChunkStore(spark, str(tmp_path), name)


def test_streamed_papers_reach_the_store(spark, sf, tmp_path):
    source = clean.clean_papers(clean.raw_papers(adapter.paper_records(spark, sf)))
    source.repartition(2).write.parquet(str(tmp_path / "papers"))
    store = ChunkStore(spark, str(tmp_path), "streamed")
    stored = spark.read.parquet(str(tmp_path / "papers"))
    stream = (
        spark.readStream.schema(stored.schema).option("maxFilesPerTrigger", 1)
        .parquet(str(tmp_path / "papers"))
    )
    for attempt in range(2):  # a fresh checkpoint replays everything
        query = (
            stream.writeStream.foreachBatch(index_batch(store))
            .option("checkpointLocation", str(tmp_path / f"progress{attempt}"))
            .trigger(availableNow=True).start()
        )
        query.awaitTermination()
    want = index.embedded_chunks(stored)
    assert store.size() == want.count()
    assert store.read().select("chunk_id").distinct().count() == want.count()
    assert store.read().exceptAll(want.select(*store.read().columns)).count() == 0


def test_summary_counts(spark):
    chunks = index.chunk_papers(index.eligible_papers(papers(spark, paper(250, "a"), paper(1, "b"))))
    assert tuple(index.summarize(chunks).first()) == (2, 3)
    assert chunks.filter(F.col("chunk_id") == "a:1").first()["chunk_idx"] == 1


def test_lookup_reads_only_the_files_that_hold_the_ids(spark, tmp_path):
    from foliograph.operators.lookup import rows_for

    spark.range(100).select("id", F.concat(F.lit("t"), "id").alias("t")).repartitionByRange(10, "id") \
        .write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    ids = spark.createDataFrame([(3, "x"), (4, "y"), (55, "z"), (999, "none")], "id bigint, tag string")
    want = [(3, "t3", "x"), (4, "t4", "y"), (55, "t55", "z")]
    for many in (1, 1000):
        found = rows_for(table, ids, "id", ["id", "t"], many_files=many)
        assert sorted(tuple(r) for r in found.select("id", "t", "tag").collect()) == want
    few = rows_for(table, ids, "id", ["id", "t"], many_files=1)
    assert few.rdd.getNumPartitions() <= 2 < table.rdd.getNumPartitions()
    derived = table.select("id", F.upper("t").alias("t"))
    assert rows_for(derived, ids, "id", ["id", "t"], many_files=1).count() == 3
    assert rows_for(table, ids.limit(0), "id", ["id", "t"], many_files=1).count() == 0


def test_windows_of_a_long_text_and_of_odd_ones(spark):
    long = " ".join(f"w{i}" for i in range(200_000))
    rows = [("long", long), ("odd", "\u2003a\x1fb\n\nc\x85 d "), ("none", None), ("blank", " \u3000"), (None, "x y")]
    df = papers(spark, *[(i, "T", x, "c", "2007", "x", "A") for i, x in rows]).withColumnRenamed("primary_category", "category")
    df = df.withColumnRenamed("submitted_year", "year")
    chunks = index.chunk_papers(df, 3, 1)
    plan = chunks._jdf.queryExecution().executedPlan().toString()
    assert "slice" not in plan and "MapInArrow" in plan  # a slice copies the whole text for each window
    got = {(r["arxiv_id"], r["chunk_idx"]): r["chunk_text"] for r in chunks.collect()}
    assert got.pop((None, 0)) == "x y" and chunks.filter("arxiv_id is null").first()["chunk_id"] == "0"
    assert [got.pop(("odd", i)) for i in (0, 1)] == ["a b c", "c d"]
    assert got == {("long", i): " ".join(f"w{j}" for j in range(2 * i, min(2 * i + 3, 200_000))) for i in range(100_000)}


def test_collections_clean_the_papers_once(spark, sf, monkeypatch):
    from foliograph.checks import queries

    seen = []
    build = index.build_index
    monkeypatch.setattr(index, "build_index", lambda papers, *a, **b: (seen.append(papers), build(papers, *a, **b))[1])
    assert queries.collections(spark, sf).count() > 0
    assert len(seen) == 3
    for given in seen:
        assert "Window" not in given._jdf.queryExecution().executedPlan().toString()


def test_no_function_runs_word_by_word_while_the_index_is_built(spark):
    built = index.embedded_chunks(papers(spark, paper(250, "a")))
    plan = built._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 2 and "lambda" not in plan and "Exchange" not in plan
    assert [len(r["embedding"]["idx"]) > 0 for r in built.collect()] == [True, True]
