"""An inverted file of vectors: coarse cells on storage, short residual codes, exact distances last.

Vectors are scaled to unit length and rounded to a grid of whole numbers, so
training, coding and ranking are exact sums that do not depend on partitioning.

* A few rounds of k-means over a bounded sample give the centroids; every
  vector belongs to its nearest one.  The table is partitioned by that cell,
  so a search opens the files of the cells it probes and no others.
* A vector's code holds its distance from the centroid in 16 steps per
  dimension, two dimensions a byte; the steps' width is that of the cell.  The first pass reads codes only, turns
  bytes into step centres by a table, and keeps the best ``depth`` per query.
* Vectors are read, in the cells that hold a candidate, for those alone.

No pair of query and vector becomes a row; a task sends ``depth`` short rows
per query.  What is broadcast is one block of queries and its probes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from foliograph.operators.knn import QUERY_BLOCK, _cosine, _matrix, _squares, _storage, query_blocks
from foliograph.session import kept, scratch_path

# The grid: a component of a unit vector in 1/1024.
SCALE = 1024
STEPS = 16
# Vectors that the centroids are fitted on, at most; codes cover all vectors.
TRAIN_ROWS = 200_000
ROUNDS = 4
MAX_CELLS = 65_536
# Rows of one cell that go to one file.
CELL_ROWS = 1_000_000
DEPTH = 64
# Distances held at a time while cells are chosen.
CELLS_AT_ONCE = 4_000_000


def _on_grid(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors in whole numbers; a zero vector stays zero."""
    norm = np.sqrt(_squares(vectors))[:, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.floor(np.where(norm > 0, vectors / norm, 0.0) * SCALE + 0.5)


def _cells_by_distance(points: np.ndarray, centroids: np.ndarray, keep: int) -> Iterator[np.ndarray]:
    """The ``keep`` nearest cells of each point, in blocks of points; equal distances by cell number.

    On the grid all sums are whole numbers, mostly far below 2**24, where floats of four bytes
    give them exactly as well.
    """
    squares = _squares(centroids)
    reach = max(_squares(x).max(initial=0) for x in (points, centroids))
    if 3 * reach < 2**24:
        points, centroids, squares = (x.astype(np.float32) for x in (points, centroids, squares))
    step = max(1, CELLS_AT_ONCE // max(len(centroids), 1))
    for at in range(0, len(points), step):
        distance = points[at : at + step] @ centroids.T
        distance *= -2
        distance += squares
        if keep == 1:
            yield distance.argmin(axis=1)[:, None]
        else:
            yield np.argsort(distance, axis=1, kind="stable")[:, :keep]


def _map(df: DataFrame, schema: str | T.StructType, make) -> DataFrame:
    """Rows of ``make(batch)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield make(batch)

    return df.mapInArrow(run, schema)


def _train(rows: DataFrame, id_col: str, cells: int, total: int, train_rows: int, rounds: int) -> np.ndarray:
    """Centroids on the grid: the vectors with the smallest id digests, then ``rounds`` of k-means."""
    spark = rows.sparkSession
    digest = F.md5(F.col(id_col).cast("string"))
    share = min(1.0, train_rows / total)
    head = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    sample = rows.withColumn("digest", digest).filter(head < F.lit(math.ceil(share * 2**32)))
    path = scratch_path(spark, "train")

    def on_grid(batch: pa.RecordBatch) -> pa.RecordBatch:
        points = _on_grid(_matrix(batch.column(1)))
        lists = pa.FixedSizeListArray.from_arrays(pa.array(points.ravel()), points.shape[1]).cast(pa.list_(pa.float64()))
        return pa.RecordBatch.from_arrays([batch.column(0), lists], names=["digest", "z"])

    _map(sample.select("digest", "vector"), "digest string, z array<double>", on_grid).write.parquet(path)
    stored = spark.read.parquet(path)
    first = stored.orderBy("digest", "z").limit(cells).select("z").toArrow()
    centroids = _matrix(first.column("z").combine_chunks())
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(centroids)

        def assigned(batch: pa.RecordBatch, shared=shared) -> pa.RecordBatch:
            """The batch's vectors per cell, and their sum."""
            points = _matrix(batch.column(0))
            near = np.concatenate(list(_cells_by_distance(points, shared.value, 1)))[:, 0]
            order = np.argsort(near, kind="stable")
            cell, first, n = np.unique(near[order], return_index=True, return_counts=True)
            total = np.add.reduceat(points[order], first, axis=0)
            lists = pa.FixedSizeListArray.from_arrays(pa.array(total.ravel()), total.shape[1]).cast(pa.list_(pa.float64()))
            return pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int32)), pa.array(n), lists], names=["cell", "n", "z"])

        sums = (
            _map(stored.select("z"), "cell int, n bigint, z array<double>", assigned)
            .groupBy("cell")
            .agg(F.sum("n").alias("n"), vector_to_array(Summarizer.sum(array_to_vector("z"))).alias("total"))
            .toArrow()  # a row per cell
        )
        cell, n = sums.column("cell").to_numpy(), sums.column("n").to_numpy()
        centroids = centroids.copy()
        total = np.rint(_matrix(sums.column("total").combine_chunks()))  # the summary keeps means
        centroids[cell] = np.floor((2 * total + n[:, None]) / (2 * n[:, None]))
        shared.unpersist()
    return centroids


def _centres(radius: int) -> np.ndarray:
    """The middle of each step of a residual."""
    step = np.arange(STEPS)
    return -radius + (2 * step + 1) * (2 * radius + 1) // (2 * STEPS)


def _codes(residual: np.ndarray, radius: np.ndarray) -> np.ndarray:
    radius = radius[:, None]
    step = (residual.astype(np.int64) + radius) * STEPS // (2 * radius + 1)
    step = np.clip(step, 0, STEPS - 1).astype(np.uint8)  # vectors added later may lie farther out
    if step.shape[1] % 2:
        step = np.concatenate([step, np.zeros((len(step), 1), np.uint8)], axis=1)
    return step[:, ::2] << 4 | step[:, 1::2]


def _decoded(codes: np.ndarray, radius: int, width: int) -> np.ndarray:
    centre = _centres(radius).astype(np.float64)
    byte = np.arange(256)
    pairs = np.stack([centre[byte >> 4], centre[byte & 15]], axis=1)
    return pairs[codes].reshape(len(codes), -1)[:, :width]


def build_inverted_file(
    vectors: DataFrame,
    path: str,
    *,
    cells: int | None = None,
    train_rows: int = TRAIN_ROWS,
    rounds: int = ROUNDS,
    cell_rows: int = CELL_ROWS,
    id_col: str = "chunk_id",
    vector_col: str = "embedding",
) -> InvertedFile:
    """Write the inverted file of all vectors to ``path``; ids are unique.

    ``cells`` defaults to the square root of the number of vectors.  The
    centroids come from at most about ``train_rows`` vectors, drawn by their
    ids' digests; every vector is coded and stored.  Rows without a vector are
    left out; vectors of different widths are an error.
    """
    spark = vectors.sparkSession
    rows = _present(vectors, id_col, vector_col)
    total = rows.count()
    if total == 0:
        raise ValueError("there are no vectors")
    if cells is None:
        cells = math.floor(math.sqrt(total) + 0.5)
    cells = max(1, min(cells, total, MAX_CELLS))
    centroids = _train(rows, id_col, cells, total, train_rows, rounds)
    placed, sizes = _placed(rows, centroids)
    filled = sorted(sizes)  # cells without vectors leave, so that no probe is spent on them
    number = np.zeros(cells, np.int32)
    number[filled] = np.arange(len(filled))
    centroids, radius = centroids[filled], np.array([sizes[c][1] for c in filled], np.int64)
    parts = {i: -(-sizes[c][0] // cell_rows) for i, c in enumerate(filled)}
    _write(placed, number, parts, centroids, radius, path)
    table = [(c, int(radius[c]), id_col, [int(x) for x in centroids[c]]) for c in range(len(filled))]
    spark.createDataFrame(table, "cell int, radius int, id_col string, centroid array<int>").coalesce(1).write.parquet(
        f"{path}/centroids"
    )
    return InvertedFile(spark, path)


def _present(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    return vectors.filter(F.col(vector_col).isNotNull()).select(id_col, _storage(vectors, vector_col).alias("vector"))


def _placed(rows: DataFrame, centroids: np.ndarray) -> tuple[DataFrame, dict[int, tuple[int, int]]]:
    """``id, vector, cell`` (stored), and per cell its vectors and their largest residual."""
    spark, id_col = rows.sparkSession, rows.columns[0]
    shared = spark.sparkContext.broadcast(centroids)

    def place(batch: pa.RecordBatch) -> pa.RecordBatch:
        points = _on_grid(_matrix(batch.column(1)))
        if points.shape[1] != shared.value.shape[1]:
            raise ValueError(f"vectors of width {points.shape[1]} among others of {shared.value.shape[1]}")
        near = np.concatenate(list(_cells_by_distance(points, shared.value, 1)))[:, 0]
        reach = np.abs(points - shared.value[near]).max(axis=1)
        columns = [*batch.columns, pa.array(near.astype(np.int32)), pa.array(reach.astype(np.int32))]
        return pa.RecordBatch.from_arrays(columns, names=[id_col, "vector", "cell", "reach"])

    numbers = [T.StructField(name, T.IntegerType()) for name in ("cell", "reach")]
    scratch = scratch_path(spark, "placed")
    _map(rows, T.StructType([*rows.schema.fields, *numbers]), place).write.parquet(scratch)
    placed = spark.read.parquet(scratch)
    sizes = placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("reach").alias("reach")).collect()
    return placed.drop("reach"), {r["cell"]: (r["n"], r["reach"]) for r in sizes}


def _write(
    placed: DataFrame, number: np.ndarray, parts: dict[int, int], centroids: np.ndarray, radius: np.ndarray, path: str
) -> None:
    """Add the placed vectors and their codes to the files of their cells, numbered anew."""
    spark, id_col = placed.sparkSession, placed.columns[0]
    shared = spark.sparkContext.broadcast((centroids, radius, number))

    def coded(batch: pa.RecordBatch) -> pa.RecordBatch:
        centroids, radius, number = shared.value
        cell = number[batch.column(2).to_numpy()]
        codes = _codes(_on_grid(_matrix(batch.column(1))) - centroids[cell], radius[cell])
        packed = pa.array([row.tobytes() for row in codes], pa.binary())
        return pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(cell), packed], names=[id_col, "vector", "cell", "code"])

    rows = _map(placed, T.StructType([*placed.schema.fields, T.StructField("code", T.BinaryType())]), coded)
    table = spark.createDataFrame(list(parts.items()), "cell int, parts int")
    part = F.pmod(F.xxhash64(id_col), F.col("parts"))  # a large cell is written by several tasks
    dealt = rows.join(F.broadcast(table), "cell").repartition("cell", part)  # one row per cell is broadcast
    dealt.select(id_col, "vector", "code", "cell").write.mode("append").partitionBy("cell").parquet(f"{path}/cells")


class InvertedFile:
    """A stored inverted file."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        held = spark.read.parquet(f"{path}/centroids").orderBy("cell").toArrow()
        self.radius = held.column("radius").to_numpy()
        self.id_col = held.column("id_col")[0].as_py()
        self.centroids = _matrix(held.column("centroid").combine_chunks())

    def add(self, vectors: DataFrame, *, vector_col: str = "embedding", cell_rows: int = CELL_ROWS) -> None:
        """Store further vectors, of ids not stored yet, in the cells there are."""
        rows = _present(vectors, self.id_col, vector_col)
        placed, sizes = _placed(rows, self.centroids)
        parts = {cell: -(-n // cell_rows) for cell, (n, _) in sizes.items()}
        number = np.arange(len(self.centroids), dtype=np.int32)
        if parts:
            _write(placed, number, parts, self.centroids, self.radius, self.path)

    def sizes(self) -> DataFrame:
        """``cell, vectors``."""
        return self.spark.read.parquet(f"{self.path}/cells").groupBy("cell").agg(F.count("*").alias("vectors"))

    def default_probes(self) -> int:
        """A tenth of the cells, eight at least."""
        return max(8, -(-len(self.centroids) // 10))

    def cells(self, numbers: list[int]) -> DataFrame:
        """The vectors of these cells; no other file is opened."""
        return self.spark.read.parquet(f"{self.path}/cells").filter(F.col("cell").isin(numbers))

    def probes_of(self, queries: DataFrame, probes: int, *, vector_col: str = "embedding", query_block: int = QUERY_BLOCK) -> DataFrame:
        """``query_key, cell``: the cells a search opens for each query."""
        asked = queries.filter(F.col(vector_col).isNotNull()).select("query_key", _storage(queries, vector_col).alias("vector"))
        rows = [
            (key, int(cell))
            for block in query_blocks(asked, query_block)
            for key, cells in zip(block.column("query_key").to_pylist(), self.probed(block, probes))
            for cell in cells
        ]
        return self.spark.createDataFrame(rows, "query_key string, cell int")

    def probed(self, queries: pa.Table, probes: int) -> np.ndarray:
        """The ``probes`` nearest cells of each query."""
        points = _on_grid(_matrix(queries.column("vector").combine_chunks()))
        probes = max(1, min(probes, len(self.centroids)))
        return np.concatenate([np.empty((0, probes), np.int64), *_cells_by_distance(points, self.centroids, probes)])

    def search(
        self,
        queries: DataFrame,
        k: int,
        *,
        probes: int | None = None,
        depth: int = DEPTH,
        vector_col: str = "embedding",
        query_block: int = QUERY_BLOCK,
    ) -> DataFrame:
        """``query_key, <id>, distance, rank`` of the nearest among the candidates, as ``nearest`` gives them.

        The ``depth`` best codes of the ``probes`` nearest cells are measured
        exactly; equal distances rank by id.  With all cells and a depth of
        all vectors the result is that of ``nearest``.
        """
        if not 1 <= k <= depth:
            raise ValueError("k must be positive and at most depth")
        asked = queries.filter(F.col(vector_col).isNotNull()).select("query_key", _storage(queries, vector_col).alias("vector"))
        schema = T.StructType(
            [
                T.StructField("query_key", T.StringType()),
                T.StructField(self.id_col, self.spark.read.parquet(f"{self.path}/cells").schema[self.id_col].dataType),
                T.StructField("distance", T.DoubleType()),
            ]
        )
        blocks = query_blocks(asked, query_block)
        scans = [self._block(block, probes or self.default_probes(), depth, schema) for block in blocks]
        found = reduce(DataFrame.unionByName, scans) if scans else self.spark.createDataFrame([], schema)
        order = Window.partitionBy("query_key").orderBy("distance", self.id_col)
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    def _block(self, queries: pa.Table, probes: int, depth: int, schema: T.StructType) -> DataFrame:
        probed = self.probed(queries, probes)
        shared = self.spark.sparkContext.broadcast(
            (queries.column("query_key").to_pylist(), _matrix(queries.column("vector").combine_chunks()), probed)
        )
        radius, centroids, id_col = self.radius, self.spark.sparkContext.broadcast(self.centroids), self.id_col

        def ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            _, vectors, probed = shared.value
            best = _BestCodes(_on_grid(vectors), probed, centroids.value, radius, depth)
            for batch in batches:
                best.add(batch)
            yield from best.batches()

        wide = T.StructType(
            [T.StructField("query", T.IntegerType()), schema[id_col], T.StructField("cell", T.IntegerType()), T.StructField("score", T.LongType())]
        )
        codes = self.cells(np.unique(probed).tolist()).select(id_col, "cell", "code")
        order = Window.partitionBy("query").orderBy(F.desc("score"), id_col)
        near = codes.mapInArrow(ranked, wide).withColumn("place", F.row_number().over(order)).filter(F.col("place") <= depth)
        near = kept(near.select("query", id_col, "cell"))  # a block's queries times the depth, at most
        holding = [r["cell"] for r in near.select("cell").distinct().collect()]
        pairs = self.cells(holding).select(id_col, "vector").join(F.broadcast(near.drop("cell")), id_col)

        def measured(batch: pa.RecordBatch) -> pa.RecordBatch:
            keys, asked, _ = shared.value
            query, vectors = batch.column(2).to_numpy(), _matrix(batch.column(1))
            distance = _cosine((asked[query] * vectors).sum(axis=1), _squares(asked)[query] * _squares(vectors))
            names = pa.array([keys[q] for q in query.tolist()], pa.string())
            return pa.RecordBatch.from_arrays([names, batch.column(0), pa.array(distance)], names=schema.names)

        return _map(pairs.select(id_col, "vector", "query"), schema, measured)


class _BestCodes:
    """The ``depth`` best codes seen so far of each query."""

    def __init__(self, points: np.ndarray, probed: np.ndarray, centroids: np.ndarray, radius: np.ndarray, depth: int):
        self.points, self.centroids, self.radius, self.depth = points, centroids, radius, depth
        self.of_cell: dict[int, list[int]] = {}
        for query, cells in enumerate(probed.tolist()):
            for cell in cells:
                self.of_cell.setdefault(cell, []).append(query)
        self.limit = np.full(len(points), -np.inf)
        self.held: list[tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]] = []
        self.rows = 0

    def add(self, batch: pa.RecordBatch) -> None:
        cell = batch.column(1).to_numpy()
        edge = np.concatenate([[0], np.flatnonzero(np.diff(cell)) + 1, [len(cell)]]).tolist()
        for a, b in zip(edge[:-1], edge[1:]):
            if b > a and int(cell[a]) in self.of_cell:
                self._add_cell(batch.slice(a, b - a), int(cell[a]))
        if self.rows > 4 * self.depth * max(len(self.points), 64):
            self._cut()

    def _add_cell(self, rows: pa.RecordBatch, cell: int) -> None:
        codes = np.frombuffer(b"".join(rows.column(2).to_pylist()), np.uint8).reshape(rows.num_rows, -1)
        vectors = self.centroids[cell] + _decoded(codes, int(self.radius[cell]), self.points.shape[1])
        queries = np.array(self.of_cell[cell])
        step = max(1, CELLS_AT_ONCE // len(queries))
        for at in range(0, len(vectors), step):
            score = self.points[queries] @ vectors[at : at + step].T
            low = self.limit[queries]
            if score.shape[1] > self.depth:
                low = np.maximum(low, np.partition(score, -self.depth, axis=1)[:, -self.depth])
            q, r = np.nonzero(score >= low[:, None])
            ids = rows.column(0).take(pa.array(r + at))
            self.held.append((queries[q], ids, np.full(len(q), cell), score[q, r].astype(np.int64)))
            self.rows += len(q)

    def _cut(self) -> None:
        """Keep the best ``depth`` of each query; equal scores by id."""
        if not self.held:
            return
        query, cell, score = (np.concatenate([h[i] for h in self.held]) for i in (0, 2, 3))
        ids = pa.concat_arrays([h[1] for h in self.held])
        place = np.empty(len(ids), np.int64)
        place[pc.sort_indices(ids).to_numpy()] = np.arange(len(ids))
        order = np.lexsort((place, -score, query))
        first = np.searchsorted(query[order], query[order])
        number = np.arange(len(order)) - first
        last = order[number == self.depth - 1]
        self.limit[query[last]] = score[last]
        order = order[number < self.depth]
        self.held = [(query[order], ids.take(pa.array(order)), cell[order], score[order])]
        self.rows = len(order)

    def batches(self) -> Iterator[pa.RecordBatch]:
        self._cut()
        for query, ids, cell, score in self.held:
            columns = [pa.array(query.astype(np.int32)), ids, pa.array(cell.astype(np.int32)), pa.array(score)]
            yield pa.RecordBatch.from_arrays(columns, names=["query", "id", "cell", "score"])
