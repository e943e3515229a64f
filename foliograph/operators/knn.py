"""Exact nearest neighbours by cosine distance, many queries at once.

Every query is measured against every vector, but no pair ever becomes a row:
tasks multiply blocks of vectors with a block of queries and keep the ``k``
best per query.  What is shuffled afterwards is ``k`` short rows per query and
task.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from foliograph.functions.vectors import HASH_DIM
from foliograph.session import scratch_path

# Queries one task holds at a time: the bound under which they are broadcast.
# Hashed vectors have a fixed small width, others may be several times wider.
QUERY_BLOCK = 4096
HASHED_QUERY_BLOCK = 16_384
# Entries of one distance matrix.
CELLS = 2_000_000
# Slack under which a matrix product may differ from the exact dot product.
SLACK = 1e-9


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int,
    *,
    id_col: str = "chunk_id",
    vector_col: str = "embedding",
    query_block: int | None = None,
) -> DataFrame:
    """``query_key, <id_col>, distance, rank`` for the ``k`` nearest vectors.

    ``queries`` holds distinct ``query_key`` strings with vectors of the same
    form: hashed structs, arrays of numbers or packed bits.  Equal distances rank by id.

    The query side is counted first.  Blocks of about ``query_block`` queries go
    to all tasks one after the other; vectors are read once per block, where
    they lie, and never shuffled.
    """
    if k < 1:
        raise ValueError("k must be positive")
    if query_block is None:
        hashed = isinstance(vectors.schema[vector_col].dataType, T.StructType)
        query_block = HASHED_QUERY_BLOCK if hashed else QUERY_BLOCK
    id_type = vectors.schema[id_col].dataType
    side = vectors.select(id_col, _storage(vectors, vector_col)).filter(F.col(vector_col).isNotNull())
    asked = queries.select("query_key", _storage(queries, vector_col)).filter(
        F.col(vector_col).isNotNull()
    )
    schema = T.StructType(
        [
            T.StructField("query_key", T.StringType()),
            T.StructField(id_col, id_type),
            T.StructField("distance", T.DoubleType()),
        ]
    )
    scans = [_broadcast_scan(side, block, k, schema, vector_col) for block in query_blocks(asked, query_block)]
    found = reduce(DataFrame.unionByName, scans) if scans else side.sparkSession.createDataFrame([], schema)
    order = Window.partitionBy("query_key").orderBy("distance", id_col)
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _storage(df: DataFrame, name: str) -> Column:
    """Numeric arrays as doubles; hashed vectors stay integer."""
    kind = df.schema[name].dataType
    return F.col(name).cast("array<double>").alias(name) if isinstance(kind, T.ArrayType) else F.col(name)


def query_blocks(asked: DataFrame, query_block: int) -> Iterator[pa.Table]:
    """``asked`` in blocks of about ``query_block`` rows, dealt by key; none if it has no rows.

    Several blocks are taken from a stored copy, so the queries are made once.
    """
    count = asked.count()
    if not count:
        return
    if count <= query_block:
        yield asked.toArrow().combine_chunks()
        return
    path = scratch_path(asked.sparkSession, "queries")
    blocks = -(-count // query_block)
    block = F.pmod(F.xxhash64("query_key"), F.lit(blocks)).cast("int")
    asked.withColumn("_block", block).repartition("_block").write.partitionBy("_block").parquet(path)
    stored = asked.sparkSession.read.parquet(path)
    for number in range(blocks):
        held = stored.filter(F.col("_block") == number).drop("_block").toArrow()
        if held.num_rows:
            yield held.combine_chunks()


def _broadcast_scan(
    side: DataFrame, queries: pa.Table, k: int, schema: T.StructType, vector_col: str
) -> DataFrame:
    shared = side.sparkSession.sparkContext.broadcast(queries)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(shared.value, vector_col, k)
        for batch in batches:
            best.add(batch)
        yield from best.batches()

    return side.mapInArrow(scan, schema)


class Best:
    """The ``k`` nearest vectors seen so far for each query of a block."""

    def __init__(self, queries: pa.Table, vector_col: str, k: int) -> None:
        self.vector_col = vector_col
        self.k = k
        self.keys = queries.column("query_key").to_pylist()
        column = queries.column(vector_col)
        chunk = column.chunk(0) if column.num_chunks else pa.array([], column.type)
        self.whole_numbers = not pa.types.is_list(column.type)
        self.matrix = _matrix(chunk)
        self.squares = _squares(self.matrix)
        self.distance = np.full((len(self.keys), k), np.inf)
        self.ids = None
        self.id_field = None

    def add(self, batch: pa.RecordBatch) -> None:
        if not self.keys:
            return
        step = max(1, CELLS // max(len(self.keys), self.matrix.shape[1], 1))
        for at in range(0, batch.num_rows, step):
            self._add_slice(batch.slice(at, step))

    def _add_slice(self, batch: pa.RecordBatch) -> None:
        ids = batch.column(0)
        if self.ids is None:
            self.id_field = batch.schema.field(0)
            text = pa.types.is_string(ids.type) or pa.types.is_large_string(ids.type)
            self.ids = np.full(self.distance.shape, "" if text else 0, dtype=object)
        block = _matrix(batch.column(batch.schema.get_field_index(self.vector_col)))
        squares = _squares(block)
        distance = _cosine(self.matrix @ block.T, self.squares[:, None] * squares[None, :])
        limit = self.distance[:, -1]
        if np.isinf(limit).any() and len(block) > self.k:
            limit = np.minimum(limit, np.partition(distance, self.k - 1, axis=1)[:, self.k - 1])
        slack = 0.0 if self.whole_numbers else SLACK
        query, row = np.nonzero(distance <= limit[:, None] + slack)
        if not len(query):
            return
        exact = distance[query, row]
        if not self.whole_numbers:
            # A matrix product may sum in another order per position, so that
            # equal vectors would differ in the last bit; settle candidates
            # with one fixed order.
            for at in range(0, len(query), 16_384):
                q, r = query[at : at + 16_384], row[at : at + 16_384]
                dots = (self.matrix[q] * block[r]).sum(axis=1)
                exact[at : at + 16_384] = _cosine(dots, self.squares[q] * squares[r])
        seen, at = np.unique(row, return_inverse=True)
        names = np.array(ids.take(pa.array(seen)).to_pylist(), dtype=object)
        self._merge(query, exact, names[at])

    def _merge(self, query: np.ndarray, distance: np.ndarray, ids: np.ndarray) -> None:
        touched = np.unique(query)
        query = np.concatenate([np.repeat(touched, self.k), query])
        distance = np.concatenate([self.distance[touched].ravel(), distance])
        ids = np.concatenate([self.ids[touched].ravel(), ids])
        _, id_order = np.unique(ids, return_inverse=True)
        order = np.lexsort((id_order, distance, query))
        starts = np.searchsorted(query[order], touched)
        kept = order[starts[:, None] + np.arange(self.k)]
        self.distance[touched] = distance[kept]
        self.ids[touched] = ids[kept]

    def batches(self) -> Iterator[pa.RecordBatch]:
        if self.ids is None:
            return
        query, at = np.nonzero(np.isfinite(self.distance))
        for start in range(0, len(query), 10_000):
            q, a = query[start : start + 10_000], at[start : start + 10_000]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([self.keys[i] for i in q], pa.string()),
                    pa.array(self.ids[q, a].tolist(), self.id_field.type),
                    pa.array(self.distance[q, a]),
                ],
                names=["query_key", self.id_field.name, "distance"],
            )


def _matrix(vectors: pa.Array) -> np.ndarray:
    """Arrow vectors as rows of a matrix of doubles; a packed bit counts as 1 or -1."""
    n = len(vectors)
    if pa.types.is_binary(vectors.type):
        packed = np.frombuffer(b"".join(vectors.to_pylist()), np.uint8)
        bits = np.unpackbits(packed.reshape(n, -1), axis=1) if n else np.zeros((0, 0))
        return bits * 2.0 - 1.0
    if pa.types.is_struct(vectors.type):
        idx, tf = vectors.flatten()
        row = np.repeat(np.arange(n), np.diff(idx.offsets.to_numpy()))
        cell = row * HASH_DIM + idx.flatten().to_numpy()
        return np.bincount(cell, weights=tf.flatten().to_numpy(), minlength=n * HASH_DIM).reshape(n, HASH_DIM)
    widths = np.unique(vectors.value_lengths().to_numpy(zero_copy_only=False))
    flat = vectors.flatten()
    if len(widths) > 1 or flat.null_count:
        raise ValueError(f"vectors of widths {widths.tolist()} with {flat.null_count} null components")
    values = flat.to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return values.reshape(n, -1) if n else values.reshape(0, 0)


def _squares(matrix: np.ndarray) -> np.ndarray:
    return (matrix * matrix).sum(axis=1)


def _cosine(dots: np.ndarray, squares: np.ndarray) -> np.ndarray:
    """Cosine distance; a zero vector is at distance one from everything."""
    with np.errstate(divide="ignore", invalid="ignore"):
        cosine = np.where(squares > 0, dots / np.sqrt(squares), 0.0)
    return np.maximum(1.0 - cosine, 0.0)
