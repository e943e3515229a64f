"""Nearest neighbours against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from foliograph.functions.vectors import dense_vector, postings, with_hashed_vector
from foliograph.operators.approximate import approximate_nearest, candidates, with_sketch
from foliograph.operators.knn import nearest

WORDS = "alpha beta gamma delta eps zeta eta theta iota kappa the the the of".split()


def texts(n, seed, copies=0):
    rng = random.Random(seed)
    rows = [" ".join(rng.choice(WORDS) for _ in range(rng.randrange(1, 12))) for _ in range(n)]
    return rows + ["the of alpha"] * copies


def hashed(spark, rows, name):
    df = spark.createDataFrame([(f"{name}{i:04d}", t) for i, t in enumerate(rows)], f"{name} string, t string")
    return with_hashed_vector(df, "t")


def brute(vectors, queries, k):
    """Distances from integer counts, ranked by distance and id."""
    def counts(row):
        return dict(zip(row["embedding"]["idx"], row["embedding"]["tf"]))

    out = {}
    side = [(r["id"], counts(r)) for r in vectors.collect()]
    for q in queries.collect():
        want = counts(q)
        scored = []
        for key, have in side:
            dot = sum(n * have.get(b, 0) for b, n in want.items())
            squares = sum(n * n for n in want.values()) * sum(n * n for n in have.values())
            scored.append((max(1 - dot / squares**0.5, 0.0), key))
        out[q["query_key"]] = sorted(scored)[:k]
    return out


def collected(result, id_col="id"):
    out = {}
    for row in result.orderBy("query_key", "rank").collect():
        out.setdefault(row["query_key"], []).append((row["distance"], row[id_col]))
        assert row["rank"] == len(out[row["query_key"]])
    return out


@pytest.mark.parametrize("k", [1, 5, 400])
def test_hashed_search_is_exact(spark, k):
    vectors = hashed(spark, texts(250, 1, copies=120), "id").repartition(5)
    queries = hashed(spark, texts(12, 2) + ["nothing-shared"], "query_key")
    assert collected(nearest(vectors, queries, k, id_col="id")) == brute(vectors, queries, k)


def test_blocks_of_queries_move_no_vector(spark, tmp_path):
    hashed(spark, texts(150, 3, copies=70), "id").select("id", "embedding").write.parquet(str(tmp_path / "v"))
    vectors = spark.read.parquet(str(tmp_path / "v"))
    queries = hashed(spark, texts(40, 4), "query_key")
    blocks = nearest(vectors, queries, 6, id_col="id", query_block=7)
    assert collected(blocks) == brute(vectors, queries, 6)
    plan = blocks._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") >= 6
    for line in plan.splitlines():
        if "Exchange" in line:
            assert "embedding" not in line and "hashpartitioning(query_key" in line


def test_ties_do_not_depend_on_partitioning(spark):
    vectors = hashed(spark, ["same text"] * 300, "id")
    queries = hashed(spark, ["same text", "other"], "query_key")
    for parts in (1, 6):
        found = collected(nearest(vectors.repartition(parts), queries, 4, id_col="id"))
        for hits in found.values():
            assert [key for _, key in hits] == ["id0000", "id0001", "id0002", "id0003"]
    assert found["query_key0000"][0][0] == 0.0 and found["query_key0001"][0][0] == 1.0


def test_no_queries_and_no_vectors(spark):
    vectors = hashed(spark, texts(5, 1), "id")
    queries = hashed(spark, texts(2, 1), "query_key")
    assert nearest(vectors, queries.limit(0), 3, id_col="id").count() == 0
    assert nearest(vectors.limit(0), queries, 3, id_col="id").count() == 0
    with pytest.raises(ValueError):
        nearest(vectors, queries, 0, id_col="id")


def dense(spark, matrix, name, kind="array<double>"):
    rows = [(i if name == "id" else f"q{i}", [float(x) for x in v]) for i, v in enumerate(matrix)]
    return spark.createDataFrame(rows, f"{name} {'bigint' if name == 'id' else 'string'}, embedding {kind}")


def test_dense_search_with_copies(spark):
    rng = np.random.default_rng(7)
    base = rng.normal(size=(120, 33))
    matrix = np.concatenate([base, np.tile(base[5], (60, 1)), np.zeros((1, 33))])
    queries = np.concatenate([rng.normal(size=(6, 33)), base[5:6]])
    vectors = dense(spark, matrix, "id").repartition(4)
    for options in ({}, {"query_block": 2}):
        found = collected(nearest(vectors, dense(spark, queries, "query_key"), 10, id_col="id", **options))
        for i, q in enumerate(queries):
            norms = np.linalg.norm(matrix, axis=1) * np.linalg.norm(q)
            cosine = np.divide(matrix @ q, norms, out=np.zeros(len(matrix)), where=norms > 0)
            want = np.lexsort((np.arange(len(matrix)), np.round(np.maximum(1 - cosine, 0), 9)))[:10]
            assert [key for _, key in found[f"q{i}"]] == want.tolist()
    # exact copies rank by id
    assert [key for _, key in found["q6"]][:4] == [5, 120, 121, 122]


def test_float_vectors(spark):
    vectors = dense(spark, np.eye(4), "id", "array<float>")
    queries = dense(spark, np.eye(4)[:1], "query_key", "array<float>")
    assert collected(nearest(vectors, queries, 2, id_col="id")) == {"q0": [(0.0, 0), (1.0, 1)]}


def test_postings_and_dense_form_agree(spark):
    rows = hashed(spark, texts(30, 8), "id")
    dense_rows = {r["id"]: r["d"] for r in rows.select("id", dense_vector("embedding").alias("d")).collect()}
    for p in postings(rows, "id").collect():
        assert abs(dense_rows[p["id"]][p["bucket"]] - p["weight"]) < 1e-15
    found = nearest(
        rows.withColumn("embedding", dense_vector("embedding")),
        rows.limit(5).select(F.col("id").alias("query_key"), dense_vector("embedding").alias("embedding")),
        3, id_col="id",
    )
    want = brute(rows, rows.select(F.col("id").alias("query_key"), "embedding").limit(5), 3)
    for key, hits in collected(found).items():
        assert np.allclose([d for d, _ in hits], [d for d, _ in want[key]], atol=1e-9)


def test_approximate_search_returns_true_distances(spark):
    rng = np.random.default_rng(3)
    vectors = dense(spark, rng.normal(size=(300, 16)), "id")
    queries = dense(spark, rng.normal(size=(3, 16)), "query_key")
    exact = {k: dict((i, d) for d, i in v) for k, v in collected(nearest(vectors, queries, 300, id_col="id")).items()}
    near = collected(approximate_nearest(vectors, queries, 5, id_col="id"))
    for key, hits in near.items():
        assert all(exact[key][i] == d for d, i in hits)


@pytest.mark.parametrize("vectors", [[[1.0, 2.0], [1.0]], [[1.0, None]]])
def test_uneven_vectors_are_an_error(vectors):
    import pyarrow as pa

    from foliograph.operators.knn import _matrix

    with pytest.raises(ValueError):
        _matrix(pa.array(vectors, pa.list_(pa.float64())))


def test_sketches_find_the_nearest_whatever_the_number_of_queries(spark, tmp_path):
    rng = np.random.default_rng(5)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(1500, 32)))]
    with_sketch(spark.createDataFrame(rows, "id long, embedding array<double>")).write.parquet(str(tmp_path / "s"))
    stored = spark.read.parquet(str(tmp_path / "s"))
    asked = spark.createDataFrame([(str(i), rows[i][1]) for i in range(40)], "query_key string, embedding array<double>")
    true = {(r["query_key"], r["id"]) for r in nearest(stored, asked, 5, id_col="id").collect()}
    got = {(r["query_key"], r["id"]) for r in approximate_nearest(stored, asked, 5, id_col="id").collect()}
    assert len(true & got) >= 0.95 * len(true) == 190
    one = approximate_nearest(stored, asked.filter("query_key = '7'"), 5, id_col="id").collect()
    assert {("7", r["id"]) for r in one} == {p for p in got if p[0] == "7"}
    whole = approximate_nearest(stored, asked, 5, depth=1500, id_col="id").collect()
    assert {(r["query_key"], r["id"]) for r in whole} == true
    # The first pass reads ids and sketches only.
    plan = candidates(stored, asked, id_col="id")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:bigint,sketch:binary>" in plan and "LSH" not in plan


def test_sketches_of_empty_zero_and_bad_vectors(spark):
    schema = "id long, embedding array<double>"
    asked = spark.createDataFrame([("q", [1.0, 0.0])], "query_key string, embedding array<double>")
    assert approximate_nearest(spark.createDataFrame([], schema), asked, 3, id_col="id").isEmpty()
    few = spark.createDataFrame([(1, [0.0, 0.0]), (2, [1.0, 0.1]), (3, None)], schema)
    assert [r["id"] for r in approximate_nearest(few, asked, 3, id_col="id").orderBy("rank").collect()] == [2, 1]
    assert approximate_nearest(few, asked.limit(0), 3, id_col="id").isEmpty()
    with pytest.raises(Exception, match="widths"):
        with_sketch(spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], schema).coalesce(1)).collect()
    with pytest.raises(ValueError):
        approximate_nearest(few, asked, 5, depth=4, id_col="id")
