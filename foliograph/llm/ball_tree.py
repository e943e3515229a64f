"""Exact top-k inner products by branch and bound over one ball tree per shard.

Queries go to the shards in blocks of bounded size.  A task collects vectors
up to ``SHARD_ROWS``, builds a tree of balls and walks it for the whole block,
the child with the larger upper bound ``q . centre + |q| radius`` first; a
query leaves a branch whose bound is below its k-th score so far.  That score
is shared: the driver finds a first one per query on a bounded set of vectors,
and a task carries it on from shard to shard.  Only hits that reach it leave a
task; the last step ranks at most ``k`` hits per query and task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from foliograph.session import scratch_path

SHARD_ROWS = 20_000
QUERY_ROWS = 4_096
SEED_ROWS = 4_096
LEAF = 128
_OUT = -np.inf


class Best:
    """The ``k`` best (score, id) of every query so far, best first; equal scores by id."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.ids, self.vectors, self.k = ids, vectors, k
        self.norms = np.sqrt((vectors**2).sum(axis=1))
        self.scores = np.full((len(ids), k), _OUT)
        self.hits = np.full((len(ids), k), np.iinfo(np.int64).max)
        self.floor = np.full(len(ids), _OUT)  # known from elsewhere

    def bound(self) -> np.ndarray:
        return np.maximum(self.scores[:, -1], self.floor)

    def offer(self, rows: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> None:
        scores = self.vectors[rows] @ vectors.T
        scores[self.ids[rows][:, None] == ids[None, :]] = _OUT
        useful = (scores >= self.bound()[rows][:, None]).any(axis=1)
        rows, scores = rows[useful], scores[useful]
        if not len(rows):
            return
        all_scores = np.concatenate([self.scores[rows], scores], axis=1)
        all_hits = np.concatenate([self.hits[rows], np.broadcast_to(ids, scores.shape)], axis=1)
        order = np.lexsort((all_hits, -all_scores), axis=1)[:, : self.k]
        self.scores[rows] = np.take_along_axis(all_scores, order, axis=1)
        self.hits[rows] = np.take_along_axis(all_hits, order, axis=1)


def search_shard(ids: np.ndarray, vectors: np.ndarray, best: Best) -> None:
    """Offers a shard's vectors to all queries that they could matter to."""
    if len(ids):
        _visit(ids, vectors, best, np.arange(len(best.ids)))


def _ball(vectors: np.ndarray) -> tuple[np.ndarray, float]:
    centre = vectors.mean(axis=0)
    # A little wider than the distances, so that rounding never hides a hit.
    return centre, float(np.sqrt(((vectors - centre) ** 2).sum(axis=1).max())) * (1 + 1e-9) + 1e-6


def _visit(ids: np.ndarray, vectors: np.ndarray, best: Best, rows: np.ndarray) -> None:
    # Nodes wait with their upper bounds; the one with the largest comes first.
    waiting = [(ids, vectors, rows, None)]
    while waiting:
        ids, vectors, rows, upper = waiting.pop()
        if upper is not None:
            rows = rows[upper >= best.bound()[rows]]
        if not len(rows):
            continue
        if len(ids) <= LEAF:
            best.offer(rows, ids, vectors)
            continue
        children = []
        for part in _halves(vectors):
            centre, radius = _ball(vectors[part])
            bound = best.vectors[rows] @ centre + best.norms[rows] * radius
            children.append((ids[part], vectors[part], rows, bound))
        children.sort(key=lambda child: float(child[3].mean()))
        waiting += children


def _halves(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two halves along the line between two far vectors."""
    a = vectors[((vectors - vectors[0]) ** 2).sum(axis=1).argmax()]
    b = vectors[((vectors - a) ** 2).sum(axis=1).argmax()]
    order = np.argsort(vectors @ (a - b), kind="stable")
    return order[: len(order) // 2], order[len(order) // 2 :]


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), width)


def _scan(batches: Iterator[pa.RecordBatch], best: Best, width: int) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []

    def search() -> None:
        shard = pa.concat_batches(held)
        search_shard(shard.column(0).to_numpy(), _matrix(shard.column(1), width), best)
        held.clear()

    for batch in batches:
        for at in range(0, len(batch), SHARD_ROWS):
            held.append(batch.slice(at, SHARD_ROWS))
            if sum(map(len, held)) >= SHARD_ROWS:
                search()
    if held:
        search()
    query, place = np.nonzero((best.scores > _OUT) & (best.scores >= best.floor[:, None]))
    yield pa.RecordBatch.from_arrays(
        [pa.array(best.ids[query]), pa.array(best.hits[query, place]), pa.array(best.scores[query, place].astype(np.int64))],
        names=["query_id", "vec_id", "score"],
    )


def top_inner_products(
    vectors: DataFrame, queries: DataFrame, k: int = 5, *, id_col: str = "vec_id", vector_col: str = "v"
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` highest inner products of every query.

    Vectors are arrays of whole numbers whose products stay below 2^53.  Ties
    go to smaller ids; rows with the query's own id do not count.  Only vectors
    of the query's width are candidates.  Null vectors or ids, and vectors with
    null components, take no part.  Equal rows of queries are one query, equal
    rows of vectors are several hits; empty tables give no rows.
    """
    spark = vectors.sparkSession
    path = scratch_path(spark, "ball-tree")
    whole = lambda df: df.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{vector_col}`").alias("v")).filter(
        F.col("id").isNotNull() & F.col("v").isNotNull() & ~F.exists("v", lambda x: x.isNull())
    )
    whole(vectors).write.parquet(f"{path}/vectors")
    stored = spark.read.parquet(f"{path}/vectors")
    asked = whole(queries).dropDuplicates(["id", "v"]).withColumn("width", F.size("v"))
    counts = asked.groupBy("width").agg(F.count("*").alias("n")).collect()  # one row per width
    results = []
    for width, n in [(r["width"], r["n"]) for r in counts if r["width"]]:
        rounds = -(-n // QUERY_ROWS)
        same = stored.filter(F.size("v") == width)
        seed = same.limit(SEED_ROWS).toArrow()
        for number in range(rounds):
            block = asked.filter((F.col("width") == width) & (F.pmod(F.xxhash64("id"), F.lit(rounds)) == number)).select("id", "v").toArrow()
            if not len(block):
                continue
            ids, matrix = block.column("id").to_numpy(), _matrix(block.column("v").combine_chunks(), width)
            first = Best(ids, matrix, k)
            search_shard(seed.column("id").to_numpy(), _matrix(seed.column("v").combine_chunks(), width), first)
            floor = first.scores[:, -1]

            def run(batches, ids=ids, matrix=matrix, floor=floor, width=width):
                best = Best(ids, matrix, k)
                best.floor = floor
                return _scan(batches, best, width)

            hits = same.mapInArrow(run, "query_id bigint, vec_id bigint, score bigint")
            order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
            ranked = hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            out = f"{path}/hits-{width}-{number}"
            ranked.select("query_id", "rank", "vec_id", "score").write.parquet(out)
            results.append(out)
    if not results:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    return spark.read.parquet(*results)


def scaled(vectors: DataFrame, factor: int, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, v``: components times ``factor``, rounded down; rows with null or non-finite components go."""
    value = F.col(f"`{vector_col}`")
    fine = value.isNotNull() & F.forall(
        value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    )
    return vectors.filter(fine).select(
        F.col(f"`{id_col}`").alias("vec_id"), F.transform(value, lambda x: F.floor(factor * x.cast("double"))).alias("v")
    )
