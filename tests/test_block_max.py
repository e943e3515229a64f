"""Block-max search: equal to the exact search, with blocks left unopened."""

import random

import pytest
from pyspark.sql import functions as F

from foliograph.functions.vectors import with_hashed_vector
from foliograph.operators.block_max import build_blocks
from foliograph.operators.knn import nearest

TOPICS = [[f"t{t}w{i}" for i in range(12)] for t in range(25)]


def hashed(spark, rows, name):
    df = spark.createDataFrame([(f"{name}{i:05d}", t) for i, t in enumerate(rows)], f"{name} string, t string")
    return with_hashed_vector(df, "t")


def topical(n, seed, words):
    rng = random.Random(seed)
    return [" ".join(rng.choice(TOPICS[i % 25]) for _ in range(words)) for i in range(n)]


def hits(df):
    return [tuple(r) for r in df.select("query_key", "rank", "id", "distance").orderBy("query_key", "rank").collect()]


@pytest.fixture(scope="module")
def vectors(spark, tmp_path_factory):
    texts = topical(2500, 1, 15) + ["t3w1 t3w2"] * 130 + ["", "only one of these"]
    path = str(tmp_path_factory.mktemp("hashed"))
    hashed(spark, texts, "id").repartition(5).select("id", "embedding").write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def queries(spark):
    return hashed(spark, topical(40, 2, 6) + ["t3w1 t3w2", "nothing shared here", ""], "query_key")


@pytest.mark.parametrize("k, block_rows, query_block", [(1, 8, 16_384), (10, 8, 16_384), (200, 16, 16_384), (5, 3, 11), (4000, 50, 16_384)])
def test_equal_to_the_exact_search(vectors, queries, tmp_path, k, block_rows, query_block):
    built = build_blocks(vectors, str(tmp_path / "b"), block_rows=block_rows, id_col="id")
    found, counts = built.search(queries, k, query_block=query_block)
    assert hits(found) == hits(nearest(vectors, queries, k, id_col="id"))
    held = built.blocks()
    assert held.select(F.explode("ids").alias("id")).exceptAll(vectors.select("id")).isEmpty()
    assert held.agg(F.sum(F.size("ids"))).first()[0] == vectors.count()
    assert held.filter(F.size("ids") > block_rows).isEmpty()
    counted = counts.collect()
    assert {r["blocks"] for r in counted} == {held.count()} and len(counted) == queries.count()
    if k <= 10:  # topics do not share words: most blocks stay unopened
        assert sum(r["skipped"] for r in counted) >= 0.6 * sum(r["blocks"] for r in counted)


def test_no_pairs_and_no_vectors_are_shuffled(vectors, queries, tmp_path):
    built = build_blocks(vectors, str(tmp_path / "b"), id_col="id")
    found, _ = built.search(queries, 3)
    plan = found._jdf.queryExecution().executedPlan().toString()
    for line in plan.splitlines():
        if "Exchange" in line:
            assert "buckets" not in line and "most" not in line
    assert "Join" not in plan


def test_no_queries_and_bad_arguments(vectors, queries, tmp_path):
    built = build_blocks(vectors, str(tmp_path / "b"), id_col="id")
    found, counts = built.search(queries.limit(0), 3)
    assert found.isEmpty() and counts.isEmpty()
    with pytest.raises(ValueError):
        built.search(queries, 0)
    with pytest.raises(ValueError):
        build_blocks(vectors, str(tmp_path / "c"), block_rows=0, id_col="id")
    with pytest.raises(ValueError, match="no vectors"):
        build_blocks(vectors.limit(0), str(tmp_path / "d"), id_col="id")
