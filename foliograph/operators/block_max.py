"""Exact search of hashed vectors by blocks that carry the largest weight of each bucket.

A block holds a few chunks that lie close together.  For a query the sum over
its buckets of its own weight times the block's largest one bounds the cosine
of every chunk in the block, so blocks below the ``k``-th score found so far
are skipped without a look at their chunks.

* Building: chunks go to coarse cells, and within a cell to blocks of
  ``BLOCK_ROWS`` in order of id.  A block is one row: its largest weights, and
  its chunks' ids and counts one after the other.
* Searching: the largest weights alone are read first; each query's best blocks
  by bound are measured, which gives a ``k``-th score to start from.  Then all
  blocks stream by, and each task measures those that its queries' bounds do
  not exclude, with the score rising as it goes.

Results are those of ``nearest``.  No pair of query and chunk becomes a row.
How much is skipped depends on the data: weights spread over all buckets bound
loosely, sparse ones tightly.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from foliograph.functions.vectors import HASH_DIM
from foliograph.operators.inverted_file import CELL_ROWS, MAX_CELLS, ROUNDS, TRAIN_ROWS, _placed, _train
from foliograph.operators.knn import HASHED_QUERY_BLOCK, Best, _cosine, _matrix, _squares, query_blocks
from foliograph.session import kept

BLOCK_ROWS = 8
# Bounds are sums of doubles: what rounding may take from them.
SLACK = 1e-9
# Candidates collected before they are merged into the best ones.
BUFFER = 4096


def build_blocks(
    chunks: DataFrame,
    path: str,
    *,
    block_rows: int = BLOCK_ROWS,
    cells: int | None = None,
    id_col: str = "chunk_id",
    vector_col: str = "embedding",
) -> BlockIndex:
    """Write the blocks of all hashed vectors to ``path``; ids are unique, null vectors are left out.

    Cells (the square root of the number of vectors by default) only decide
    which chunks share a block.
    """
    if block_rows < 1:
        raise ValueError("a block holds at least one row")
    spark = chunks.sparkSession
    rows = chunks.filter(F.col(vector_col).isNotNull()).select(id_col, F.col(vector_col).alias("vector"))
    total = rows.count()
    if total == 0:
        raise ValueError("there are no vectors")
    if cells is None:
        cells = max(1, min(round(total**0.5), total, MAX_CELLS))
    placed, sizes = _placed(rows, _train(rows, id_col, cells, total, TRAIN_ROWS, ROUNDS))
    table = spark.createDataFrame([(c, -(-n // CELL_ROWS)) for c, (n, _) in sizes.items()], "cell int, parts int")
    part = F.pmod(F.xxhash64(id_col), F.col("parts")).cast("int").alias("part")  # a large cell fills several tasks
    dealt = placed.join(F.broadcast(table), "cell").select(id_col, "cell", part, "vector")
    ordered = dealt.repartition("cell", "part").sortWithinPartitions("cell", "part", id_col)
    kind = chunks.schema[id_col].dataType
    schema = T.StructType(
        [
            T.StructField("ids", T.ArrayType(kind)),
            T.StructField("most", T.BinaryType()),
            T.StructField("sizes", T.ArrayType(T.IntegerType())),
            T.StructField("buckets", T.ArrayType(T.IntegerType())),
            T.StructField("counts", T.ArrayType(T.IntegerType())),
        ]
    )

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            held = rows if held is None else pa.concat_tables([held, rows])
            if held.num_rows >= 4 * block_rows:
                yield from _blocks(held.slice(0, last := _whole(held, block_rows)), block_rows, schema.names)
                held = held.slice(last)
        if held is not None and held.num_rows:
            yield from _blocks(held, block_rows, schema.names)

    ordered.mapInArrow(blocks, schema).withColumn(
        "block", F.monotonically_increasing_id()
    ).write.parquet(path)
    return BlockIndex(spark, path, id_col)


def _edges(table: pa.Table, block_rows: int) -> np.ndarray:
    """Where blocks begin: at each new cell or part, and every ``block_rows`` rows within one."""
    cell, part = table.column("cell").to_numpy(), table.column("part").to_numpy()
    new = np.concatenate([[True], (cell[1:] != cell[:-1]) | (part[1:] != part[:-1])])
    head = np.flatnonzero(new)
    place = np.arange(len(cell)) - head[np.cumsum(new) - 1]
    return np.flatnonzero(place % block_rows == 0)


def _whole(table: pa.Table, block_rows: int) -> int:
    """Rows before the last block, which may go on in the next batch."""
    return int(_edges(table, block_rows)[-1])


def _blocks(table: pa.Table, block_rows: int, names: list[str]) -> Iterator[pa.RecordBatch]:
    if not table.num_rows:
        return
    table = table.combine_chunks()
    edge = np.concatenate([_edges(table, block_rows), [table.num_rows]])
    ids, hashed = table.column(0).chunk(0), table.column("vector").chunk(0)
    matrix = _matrix(hashed)
    with np.errstate(divide="ignore", invalid="ignore"):
        weight = np.where(matrix > 0, matrix / np.sqrt(_squares(matrix))[:, None], 0.0)
    most = np.maximum.reduceat(weight, edge[:-1], axis=0)
    buckets, counts = (c.flatten() for c in hashed.flatten())
    sizes = hashed.flatten()[0].value_lengths().to_numpy()
    inside = np.concatenate([[0], np.cumsum(sizes)])

    def lists(offsets: np.ndarray, values: pa.Array) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), values)

    yield pa.RecordBatch.from_arrays(
        [
            lists(edge, ids),
            pa.array([row.tobytes() for row in most], pa.binary()),
            lists(edge, pa.array(sizes.astype(np.int32))),
            lists(inside[edge], buckets.cast(pa.int32())),
            lists(inside[edge], counts.cast(pa.int32())),
        ],
        names=names,
    )


class BlockIndex:
    """Stored blocks of hashed vectors."""

    def __init__(self, spark: SparkSession, path: str, id_col: str = "chunk_id"):
        self.spark, self.path, self.id_col = spark, path, id_col

    def blocks(self) -> DataFrame:
        return self.spark.read.parquet(self.path)

    def nearest(self, queries: DataFrame, k: int, **options) -> DataFrame:
        """``query_key, <id>, distance, rank`` as ``knn.nearest`` gives them."""
        return self.search(queries, k, **options)[0]

    def search(
        self, queries: DataFrame, k: int, *, vector_col: str = "embedding", query_block: int = HASHED_QUERY_BLOCK
    ) -> tuple[DataFrame, DataFrame]:
        """The nearest chunks, and ``query_key, blocks, skipped``."""
        if k < 1:
            raise ValueError("k must be positive")
        kind = self.blocks().schema["ids"].dataType.elementType
        schema = T.StructType(
            [
                T.StructField("query_key", T.StringType()),
                T.StructField(self.id_col, kind),
                T.StructField("distance", T.DoubleType()),
                T.StructField("blocks", T.LongType()),
                T.StructField("skipped", T.LongType()),
            ]
        )
        asked = queries.filter(F.col(vector_col).isNotNull()).select("query_key", F.col(vector_col).alias("embedding"))
        scans = [self._scan(block, k, schema) for block in query_blocks(asked, query_block)]
        rows = kept(reduce(DataFrame.unionByName, scans)) if scans else self.spark.createDataFrame([], schema)
        order = Window.partitionBy("query_key").orderBy("distance", self.id_col)
        found = rows.filter(F.col("blocks").isNull()).select("query_key", self.id_col, "distance")
        found = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        counts = rows.filter(F.col("blocks").isNotNull()).groupBy("query_key")
        return found, counts.agg(F.sum("blocks").alias("blocks"), F.sum("skipped").alias("skipped"))

    def _scan(self, queries: pa.Table, k: int, schema: T.StructType) -> DataFrame:
        shared = self.spark.sparkContext.broadcast((queries, self._start(queries, k)))

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            asked, start = shared.value
            best = _BlockBest(asked, k, start)
            for batch in batches:
                best.add_blocks(batch)
            yield from best.rows(schema.names)

        columns = ["ids", "most", "sizes", "buckets", "counts"]
        return self.blocks().select(*columns).mapInArrow(scan, schema)

    def _start(self, queries: pa.Table, k: int) -> np.ndarray:
        """A distance per query within which ``k`` chunks lie, infinite where none is known.

        The first blocks by bound are measured: as many as hold ``k`` chunks,
        and one more.
        """
        spark = self.spark
        shared = spark.sparkContext.broadcast(_weights(queries))
        rows = self.blocks().agg(F.min(F.size("ids"))).first()[0]
        take = -(-k // max(rows or 1, 1)) + 1

        def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            weights = shared.value
            bound, block = np.full((len(weights), take), -1.0), np.zeros((len(weights), take), np.int64)
            for batch in batches:
                own = np.minimum(weights @ _most(batch.column(1)).T, 1.0)
                bound = np.concatenate([bound, own], axis=1)
                block = np.concatenate([block, np.broadcast_to(batch.column(0).to_numpy(), own.shape)], axis=1)
                order = np.lexsort((block, -bound), axis=1)[:, :take]
                bound, block = np.take_along_axis(bound, order, 1), np.take_along_axis(block, order, 1)
            query, at = np.nonzero(bound >= 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(query), pa.array(block[query, at]), pa.array(bound[query, at])], names=["query", "block", "bound"]
            )

        best = self.blocks().select("block", "most").mapInArrow(first, "query bigint, block bigint, bound double")
        order = Window.partitionBy("query").orderBy(F.desc("bound"), "block")
        best = best.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= take)
        wanted = F.broadcast(best.select("block").distinct())  # at most ``take`` per query of the block
        held = self.blocks().join(wanted, "block", "left_semi").select("ids", "most", "sizes", "buckets", "counts")
        query = spark.sparkContext.broadcast(queries)

        def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best = _BlockBest(query.value, k, np.full(query.value.num_rows, np.inf))
            for batch in batches:
                best.add_blocks(batch)
            best.flush()
            number, at = np.nonzero(np.isfinite(best.distance))
            yield pa.RecordBatch.from_arrays([pa.array(number), pa.array(best.distance[number, at])], names=["query", "distance"])

        order = Window.partitionBy("query").orderBy("distance")
        near = held.mapInArrow(measured, "query bigint, distance double").withColumn("n", F.row_number().over(order))
        limits = near.filter(F.col("n") == k).select("query", "distance").toArrow()  # one row per query of the block
        start = np.full(queries.num_rows, np.inf)
        start[limits.column("query").to_numpy()] = limits.column("distance").to_numpy()
        return start


def _weights(queries: pa.Table) -> np.ndarray:
    matrix = _matrix(queries.column("embedding").combine_chunks())
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(matrix > 0, matrix / np.sqrt(_squares(matrix))[:, None], 0.0)


def _most(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, HASH_DIM)


class _BlockBest(Best):
    """The best chunks so far, fed with blocks."""

    def __init__(self, queries: pa.Table, k: int, start: np.ndarray) -> None:
        super().__init__(queries, "embedding", k)
        self.weights, self.start = _weights(queries), start
        self.held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.size = self.blocks = 0
        self.skipped = np.zeros(len(self.keys), np.int64)

    def limit(self) -> np.ndarray:
        return np.minimum(self.distance[:, -1], self.start)

    def add_blocks(self, batch: pa.RecordBatch) -> None:
        ids, most, sizes, buckets, counts = batch.columns
        if self.ids is None and batch.num_rows:
            self.id_field = pa.field("id", ids.type.value_type)
            text = pa.types.is_string(ids.type.value_type) or pa.types.is_large_string(ids.type.value_type)
            self.ids = np.full(self.distance.shape, "" if text else 0, dtype=object)
        bound = self.weights @ _most(most).T
        self.blocks += batch.num_rows
        first = np.argsort(-bound.sum(axis=0), kind="stable")  # blocks that promise most
        for i in first.tolist():
            open_ = 1.0 - bound[:, i] <= self.limit() + SLACK
            self.skipped += ~open_
            active = np.flatnonzero(open_)
            if len(active):
                size = sizes[i].values.to_numpy()
                cell = np.repeat(np.arange(len(size)), size) * HASH_DIM + buckets[i].values.to_numpy()
                block = np.bincount(cell, weights=counts[i].values.to_numpy(), minlength=len(size) * HASH_DIM)
                self._measure(ids[i].values, block.reshape(len(size), HASH_DIM), active)

    def _measure(self, ids: pa.Array, block: np.ndarray, active: np.ndarray) -> None:
        distance = _cosine(self.matrix[active] @ block.T, self.squares[active, None] * _squares(block)[None, :])
        query, row = np.nonzero(distance <= self.limit()[active, None])
        if len(query):
            names = np.array(ids.to_pylist(), dtype=object)
            self.held.append((active[query], distance[query, row], names[row]))
            self.size += len(query)
        if self.size > BUFFER:
            self.flush()

    def flush(self) -> None:
        if self.held:
            self._merge(*(np.concatenate(part) for part in zip(*self.held)))
        self.held, self.size = [], 0

    def rows(self, names: list[str]) -> Iterator[pa.RecordBatch]:
        """The best chunks, then per query how many blocks went by and how many of them unopened."""
        self.flush()
        for batch in self.batches():
            none = pa.nulls(batch.num_rows, pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, none, none], names=names)
        if self.id_field is not None:
            n = len(self.keys)
            columns = [
                pa.array(self.keys, pa.string()),
                pa.nulls(n, self.id_field.type),
                pa.nulls(n, pa.float64()),
                pa.array(np.full(n, self.blocks)),
                pa.array(self.skipped),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)
