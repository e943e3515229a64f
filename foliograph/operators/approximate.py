"""Approximate search: rank short sign sketches, measure the best exactly.

A sketch keeps one bit per fixed plane, the side a vector lies on; the share of
differing bits estimates the angle.  Sketches are stored next to the vectors:
the first pass reads that column only, a small part of the vectors' bytes, and
keeps ``depth`` ids per query; only their vectors are read and measured.  Work
and recall depend on ``bits`` and ``depth``, never on how many queries there are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from foliograph.operators.knn import _cosine, _matrix, _squares, nearest

BITS = 512
DEPTH = 128


@lru_cache(maxsize=4)
def planes(bits: int, width: int) -> np.ndarray:
    """``bits`` planes of components 1 and -1: the top bit of ``md5("plane:dimension")``."""
    tops = [[hashlib.md5(b"%d:%d" % (p, i)).digest()[0] for i in range(width)] for p in range(bits)]
    return np.where(np.array(tops) < 128, 1.0, -1.0).reshape(bits, width)


def with_sketch(df: DataFrame, *, vector_col: str = "embedding", bits: int = BITS, out: str = "sketch") -> DataFrame:
    """Add the sketch of every vector; rows without a vector are dropped.

    Vectors of different widths and null components are errors.  A zero vector
    lies on no side of any plane and gets zero bits.
    """
    if bits % 8:
        raise ValueError("bits must be a multiple of 8")
    present = df.filter(F.col(vector_col).isNotNull()).withColumn(vector_col, F.col(vector_col).cast("array<double>"))
    schema = T.StructType([*present.schema.fields, T.StructField(out, T.BinaryType())])

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _matrix(batch.column(batch.schema.get_field_index(vector_col)))
            sides = vectors @ planes(bits, vectors.shape[1]).T > 0
            packed = [row.tobytes() for row in np.packbits(sides, axis=1)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(packed, pa.binary())], names=[*batch.schema.names, out]
            )

    return present.mapInArrow(sketch, schema)


def _sketched(vectors: DataFrame, vector_col: str) -> DataFrame:
    return vectors if "sketch" in vectors.columns else with_sketch(vectors, vector_col=vector_col)


def candidates(
    sketched: DataFrame, queries: DataFrame, depth: int = DEPTH, *, id_col: str = "chunk_id", vector_col: str = "embedding"
) -> DataFrame:
    """``query_key, <id_col>``: the ``depth`` ids whose sketches differ least from each query's."""
    sketched = _sketched(sketched, vector_col)
    stored = sketched.select((F.octet_length("sketch") * 8).alias("bits")).first()
    asked = with_sketch(
        queries.select("query_key", vector_col), vector_col=vector_col, bits=stored["bits"] if stored else BITS
    )
    found = nearest(sketched.select(id_col, "sketch"), asked.select("query_key", "sketch"), depth, id_col=id_col, vector_col="sketch")
    return found.select("query_key", id_col)


def approximate_nearest(
    sketched: DataFrame,
    queries: DataFrame,
    k: int,
    *,
    depth: int = DEPTH,
    id_col: str = "chunk_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``query_key, <id_col>, distance, rank`` of the nearest among ``depth`` candidates per query.

    ``sketched`` has one row per id and is a stored result of ``with_sketch``;
    vectors without sketches get them on the way.  ``queries`` as in ``nearest``.  Equal distances rank by id.
    With ``depth`` at the number of vectors the result is that of ``nearest``.
    """
    if not 1 <= k <= depth:
        raise ValueError("k must be positive and at most depth")
    sketched = _sketched(sketched, vector_col)
    near = candidates(sketched, queries, depth, id_col=id_col, vector_col=vector_col)
    vectors = sketched.select(id_col, F.col(vector_col).alias("_v"))
    asked = queries.select("query_key", F.col(vector_col).cast("array<double>").alias("_q"))

    pairs = near.join(vectors, id_col).join(asked, "query_key").select("query_key", id_col, "_q", "_v")
    schema = T.StructType([*pairs.schema.fields[:2], T.StructField("distance", T.DoubleType())])

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            asked_for, found = _matrix(batch.column(2)), _matrix(batch.column(3))
            distance = _cosine((asked_for * found).sum(axis=1), _squares(asked_for) * _squares(found))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(distance)], names=schema.names)

    order = Window.partitionBy("query_key").orderBy("distance", id_col)
    ranked = pairs.mapInArrow(measured, schema).withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= k)
