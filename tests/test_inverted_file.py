"""The inverted file: coding, pruning by cell, recall, and equality with the exact search."""

from functools import partial

import numpy as np
import pytest
from pyspark.sql import functions as F

from foliograph.operators import inverted_file
from foliograph.operators.inverted_file import InvertedFile, build_inverted_file
from foliograph.operators.knn import nearest
from foliograph.plans import adapter, clean, index, retrieval
from foliograph.sources.chunk_store import ChunkStore


def dense(spark, matrix, name):
    rows = [(i if name == "id" else f"q{i:03d}", [float(x) for x in v]) for i, v in enumerate(matrix)]
    return spark.createDataFrame(rows, f"{name} {'bigint' if name == 'id' else 'string'}, embedding array<double>")


def hits(df):
    return [tuple(r) for r in df.select("query_key", "rank", "id", "distance").orderBy("query_key", "rank").collect()]


@pytest.fixture(scope="module")
def clustered(spark, tmp_path_factory):
    """6,000 vectors around 60 centres, and 20 queries near some of them."""
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(60, 32))
    matrix = centres[rng.integers(0, 60, 6000)] + 0.25 * rng.normal(size=(6000, 32))
    queries = centres[rng.integers(0, 60, 20)] + 0.25 * rng.normal(size=(20, 32))
    path = str(tmp_path_factory.mktemp("vectors"))
    dense(spark, matrix, "id").repartition(6).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path), dense(spark, queries, "query_key")


@pytest.fixture(scope="module")
def built(clustered, tmp_path_factory):
    return build_inverted_file(clustered[0], str(tmp_path_factory.mktemp("inverted") / "file"), cells=64, id_col="id")


def files_read(df, column):
    """Files that the scan of ``column`` opened, and those it could have."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    pending, found = [plan], []
    while pending:
        node = pending.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            node = node.executedPlan()
        if "Scan parquet" in node.nodeName():
            found.append((column in node.requiredSchema().simpleString(), node.metrics().apply("numFiles").value()))
        children = node.children()
        pending += [children.apply(i) for i in range(children.size())]
        if "QueryStage" in node.nodeName():
            pending.append(node.plan())
    return sum(n for wanted, n in found if wanted)


def test_codes_keep_a_residual_within_half_a_step():
    rng = np.random.default_rng(1)
    for width, radius in ((6, 5), (7, 300), (1, 0)):
        residual = rng.integers(-radius, radius + 1, (50, width))
        codes = inverted_file._codes(residual, np.full(50, radius))
        assert codes.shape == (50, (width + 1) // 2)
        error = np.abs(inverted_file._decoded(codes, radius, width) - residual)
        assert error.max() <= (2 * radius + 1) / (2 * inverted_file.STEPS) + 1


def test_recall_and_files_read(spark, clustered, built):
    """One query opens a tenth of the files; all queries find nearly all neighbours."""
    vectors, queries = clustered
    exact = {(q, i) for q, _, i, _ in hits(nearest(vectors, queries, 10, id_col="id"))}
    found = hits(built.search(queries, 10, probes=6))
    assert len(exact & {(q, i) for q, _, i, _ in found}) >= 0.95 * len(exact)
    true = {(q, i): d for q, _, i, d in hits(nearest(vectors, queries, 6000, id_col="id"))}
    assert all(true[q, i] == d for q, _, i, d in found)

    stored = spark.read.parquet(f"{built.path}/cells")
    files = len(stored.inputFiles())
    one = queries.limit(1)
    probed = [r["cell"] for r in built.probes_of(one, 6).collect()]
    codes = built.cells(probed).select("id", "code")
    assert "vector" not in codes._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1]
    assert files_read(codes, "code") == len(probed) == 6 <= 0.2 * files
    answered = built.search(one, 10, probes=6)
    assert files_read(answered, "vector") <= 6
    # Codes of the probed cells, half a byte a dimension, and vectors of four bytes of the cells holding candidates.
    share = stored.groupBy("cell").count().filter(F.col("cell").isin(probed)).agg(F.sum("count")).first()[0] / 6000
    assert share * (1 + 1 / 8) <= 0.2


def test_everything_probed_is_the_exact_search(spark, clustered, built):
    vectors, queries = clustered
    for block in (4096, 7):
        assert hits(built.search(queries, 5, probes=64, depth=6000, query_block=block)) == hits(nearest(vectors, queries, 5, id_col="id"))


def test_no_vector_is_shuffled_by_a_search(clustered, built):
    plan = built.search(clustered[1], 5)._jdf.queryExecution().executedPlan().toString()
    for line in plan.splitlines():
        if "Exchange" in line and "Broadcast" not in line:
            assert "vector" not in line and "hashpartitioning(query_key" in line


def test_results_do_not_depend_on_partitioning(spark, clustered, built, tmp_path):
    vectors, queries = clustered
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        again = build_inverted_file(vectors.repartition(11, F.rand(1)), str(tmp_path / "i"), cells=64, id_col="id", cell_rows=20)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert (again.centroids == built.centroids).all() and (again.radius == built.radius).all()
    assert sorted(map(tuple, again.sizes().collect())) == sorted(map(tuple, built.sizes().collect()))
    # Large cells are written as several files, each file of one cell.
    assert len(spark.read.parquet(f"{again.path}/cells").inputFiles()) > 2 * len(again.centroids)
    assert hits(again.search(queries, 5)) == hits(built.search(queries, 5))


def test_centroids_from_a_bounded_sample(clustered, tmp_path):
    few = build_inverted_file(clustered[0], str(tmp_path / "i"), cells=20, id_col="id", train_rows=500)
    assert few.sizes().agg(F.sum("vectors")).first()[0] == 6000  # all rows are stored


def test_copies_zero_vectors_and_nulls(spark, tmp_path):
    rows = [(i, [1.0, 2.0, 2.0]) for i in range(40)] + [(50, [0.0, 0.0, 0.0]), (51, None), (52, [2.0, -1.0, 0.0])]
    vectors = spark.createDataFrame(rows, "id bigint, embedding array<double>")
    queries = spark.createDataFrame([("a", [1.0, 2.0, 2.0]), ("b", [0.0, 0.0, 0.0]), ("n", None)], "query_key string, embedding array<double>")
    built = build_inverted_file(vectors, str(tmp_path / "i"), id_col="id")
    found = hits(built.search(queries, 3, probes=99, depth=50))
    assert [(q, r, i) for q, r, i, _ in found] == [("a", 1, 0), ("a", 2, 1), ("a", 3, 2), ("b", 1, 0), ("b", 2, 1), ("b", 3, 2)]
    assert hits(built.search(queries.limit(0), 3)) == []
    for bad in ({"k": 0}, {"k": 9, "depth": 8}):
        with pytest.raises(ValueError):
            built.search(queries, **bad)
    with pytest.raises(ValueError, match="no vectors"):
        build_inverted_file(vectors.limit(0), str(tmp_path / "none"), id_col="id")
    with pytest.raises(Exception, match="widths|width"):
        built.add(spark.createDataFrame([(60, [1.0])], "id bigint, embedding array<double>"))


def test_added_vectors_are_found(spark, clustered, tmp_path):
    vectors, queries = clustered
    built = build_inverted_file(vectors.filter("id % 3 > 0"), str(tmp_path / "i"), cells=30, id_col="id")
    built.add(vectors.filter("id % 3 = 0"))
    assert hits(built.search(queries, 5, probes=30, depth=6000)) == hits(nearest(vectors, queries, 5, id_col="id"))
    again = InvertedFile(spark, built.path)
    assert hits(again.search(queries, 5)) == hits(built.search(queries, 5))


def test_chunks_are_retrieved_through_an_inverted_file(spark, sf, tmp_path):
    store = ChunkStore(spark, str(tmp_path))
    chunks = index.ensure_index(clean.clean_papers(clean.raw_papers(adapter.paper_records(spark, sf))), store)
    built = index.inverted_index(store, str(tmp_path / "inverted"))
    asked = adapter.questions(spark, sf).select(F.col("question").alias("query_text"), "id")
    whole = retrieval.retrieve(asked, chunks, 3, search=partial(built.search, probes=10_000))
    want = retrieval.retrieve(asked, chunks, 3)
    assert whole.columns == want.columns
    key = ["id", "rank", "chunk_id"]
    got, want = ({tuple(r) for r in df.select(key).collect()} for df in (whole, want))
    assert len(got & want) >= 0.98 * len(want) > 0  # codes may leave out one of several at nearly one distance


def test_cells_of_narrow_floats_are_the_exact_ones():
    from foliograph.operators.inverted_file import _cells_by_distance, _on_grid

    rng = np.random.default_rng(5)
    for scale in (1, 7.0):  # beyond unit length sums of four bytes would not be exact
        points, centroids = (np.rint(_on_grid(rng.normal(size=(n, 384))) * scale) for n in (400, 90))
        distance = (centroids * centroids).sum(axis=1)[None, :] - 2 * (points @ centroids.T)
        want = np.argsort(distance, axis=1, kind="stable")
        for keep in (1, 5):
            assert (np.concatenate(list(_cells_by_distance(points, centroids, keep))) == want[:, :keep]).all()


def test_training_sends_a_row_per_cell_and_batch(spark, monkeypatch):
    from foliograph.operators import inverted_file

    rng = np.random.default_rng(6)
    rows = [(i, [float(x) for x in rng.normal(size=6)]) for i in range(900)]
    df = spark.createDataFrame(rows, "id bigint, vector array<double>").coalesce(1)
    sent = []
    mapped = inverted_file._map
    monkeypatch.setattr(inverted_file, "_map", lambda *a: (sent.append(mapped(*a)), sent[-1])[1])
    centroids = inverted_file._train(df, "id", 5, 900, 10_000, 2)
    assert centroids.shape == (5, 6) and len(sent) == 3
    points = np.rint(inverted_file._on_grid(np.array([v for _, v in rows])))
    for found in sent[1:]:
        assert found.count() <= 5 * 4 and found.agg(F.sum("n")).first()[0] == 900
    assert (centroids == _plain_training(rows, points)).all()


def _plain_training(rows, points):
    import hashlib

    order = sorted(range(len(rows)), key=lambda i: hashlib.md5(str(rows[i][0]).encode()).hexdigest())
    centroids = points[order[:5]]
    for _ in range(2):
        near = ((centroids**2).sum(axis=1)[None, :] - 2 * points @ centroids.T).argmin(axis=1)
        centroids = np.array([np.floor((2 * points[near == c].sum(axis=0) + (near == c).sum()) / (2 * (near == c).sum())) for c in range(5)])
    return centroids
