"""Embedding back ends by name."""

from __future__ import annotations

import warnings
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from foliograph.functions.vectors import unit, with_hashed_vector
from foliograph.operators.batch_infer import batch_infer
from foliograph.operators.vector_cache import VectorCache


def hashed(df: DataFrame, text_col: str, out: str = "embedding") -> DataFrame:
    """Hashed bag of words: built-in expressions, never fails."""
    return with_hashed_vector(df, text_col, out).withColumn("error", F.lit(None).cast("string"))


def _problem(spark: SparkSession, factory: Callable[[], Callable]) -> str | None:
    """Why a worker cannot create the model, or None; nothing is loaded on the driver."""

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _ in batches:
            problem = None
            try:
                factory()
            except Exception as exc:
                problem = repr(exc)
            yield pa.RecordBatch.from_arrays([pa.array([problem], pa.string())], names=["problem"])

    return spark.range(1, numPartitions=1).mapInArrow(probe, "problem string").first()["problem"]


def external(
    df: DataFrame,
    text_col: str,
    out: str = "embedding",
    *,
    factory: Callable[[], Callable],
    normalize: bool = False,
    fallback: str | None = None,
    cache: VectorCache | None = None,
    **options,
) -> DataFrame:
    """Vectors of an injected model, optionally scaled to unit length.

    With a ``cache`` the model is asked for texts only that it has not seen,
    each once; the call does its work at once.

    ``fallback="hashed"`` switches to the hashed back end, with a warning, when
    a worker cannot create the model; without it that is an error.
    """
    if fallback not in (None, "hashed"):
        raise ValueError("fallback must be 'hashed' or None")
    if fallback == "hashed":
        problem = _problem(df.sparkSession, factory)
        if problem is not None:
            warnings.warn(f"hashed vectors are used, the model cannot be created: {problem}", stacklevel=2)
            return hashed(df, text_col, out)
    infer = cache.infer if cache else batch_infer
    rows = infer(df, text_col, factory, out=out, **options)
    return rows.withColumn(out, unit(out)) if normalize else rows


BACKENDS = {"hashed": hashed, "external": external}


def embed(df: DataFrame, text_col: str, backend: str = "hashed", out: str = "embedding", **options) -> DataFrame:
    """Add ``out`` and ``error`` with the named back end."""
    name = backend.lower()
    if name not in BACKENDS:
        raise ValueError(f"backend must be one of {sorted(BACKENDS)}")
    return BACKENDS[name](df, text_col, out, **options)
