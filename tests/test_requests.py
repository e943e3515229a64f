"""Whole runs from tables and files."""

import json

import pytest
from pyspark.sql import functions as F

from foliograph.plans import adapter, clean
from foliograph.plans.requests import answer_file, semantic_query
from foliograph.sources.chunk_store import ChunkStore, only_new
from foliograph.sources.tables import replace_table


def test_query_and_question_file(spark, sf, tmp_path):
    store = ChunkStore(spark, str(tmp_path), "fresh")
    spark.sql("drop table if exists papers")
    with pytest.raises(RuntimeError):
        semantic_query(spark, store, "text")
    replace_table(clean.clean_papers(clean.raw_papers(adapter.paper_records(spark, sf))), "papers")
    hits = semantic_query(spark, store, "the of and", top_k=3).collect()
    assert len(hits) == 3 and store.size() > 0
    assert [h["rank"] for h in sorted(hits, key=lambda h: h["distance"])] == [1, 2, 3]
    size = store.size()
    for bad in ({"query": ""}, {"query": "x", "top_k": 0}, {"query": "x", "top_k": 51}):
        with pytest.raises(ValueError):
            semantic_query(spark, store, **bad)

    questions = [
        {"id": 1, "question": " the of ", "category_filter": None, "year_filter": None},
        {"id": 2, "question": "", "category_filter": None, "year_filter": "n/a"},
    ]
    (tmp_path / "q.json").write_text(json.dumps(questions))
    answers = answer_file(spark, store, str(tmp_path / "q.json"), str(tmp_path / "a"), model="m")
    rows = {r["question_id"]: r for r in answers.withColumn("question_id", F.col("question_id").cast("int")).collect()}
    assert rows[1]["question"] == "the of" and 1 <= len(rows[1]["sources"]) <= 5
    # the year text alone is still a query
    assert rows[2]["sources"] and rows[2]["model_used"] == "m" and rows[2]["category_filter"] is None
    lines = [json.loads(x) for p in (tmp_path / "a").glob("*.json") for x in p.read_text().splitlines()]
    assert all(set(x) == {
        "question_id", "question", "answer", "sources", "model_used", "category_filter", "year_filter",
    } for x in lines)
    assert store.size() == size


def test_new_ids_both_ways(spark):
    stored = spark.createDataFrame([(str(i % 50),) for i in range(100)], "chunk_id string")
    chunks = spark.createDataFrame([(str(i), i) for i in range(40, 80)], "chunk_id string, v int")
    for bound in (1000, 5):
        got = only_new(chunks, stored, broadcast_ids=bound)
        assert got.columns == ["chunk_id", "v"]
        assert sorted(r["v"] for r in got.collect()) == list(range(50, 80))
    few = only_new(chunks, stored)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in few and "BroadcastHashJoin" in few


def test_copies_of_an_id_in_one_batch_are_stored_once(spark):
    chunks = spark.createDataFrame([("a:0", "y"), ("a:0", "x"), ("b:0", "z"), ("c:0", "w")], "chunk_id string, chunk_text string")
    stored = chunks.filter("chunk_id = 'c:0'")
    got = sorted(map(tuple, only_new(chunks, stored).collect()))
    assert got == [("a:0", "x"), ("b:0", "z")]
