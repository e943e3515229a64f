"""Vectors from an external model: batched, retried, checked."""

from __future__ import annotations

import sys
import time
import types
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, types as T

# One model handle per worker process and name; a plain module outlives a task.
_CACHE = "_foliograph_model_handles"


def _handle(name: str | None, factory: Callable) -> Callable:
    if name is None:
        return factory()
    handles = sys.modules.setdefault(_CACHE, types.ModuleType(_CACHE)).__dict__
    if name not in handles:
        handles[name] = factory()
    return handles[name]


def call_with_retry(
    model: Callable, texts: list[str], attempts: int = 4, backoff: float = 1.5
) -> list[list[float]]:
    """One request; failures wait ``backoff``, twice, three times that, then raise.

    The model returns one ``{"index": i, "embedding": [...]}`` per text, in any
    order, or no index at all for answers in the order of the texts.  Anything
    else is an error and is not retried.
    """
    for attempt in range(1, attempts + 1):
        try:
            items = model(texts)
            break
        except Exception as exc:
            if attempt == attempts:
                raise RuntimeError(f"embedding request failed after {attempts} attempts: {exc}") from exc
            time.sleep(backoff * attempt)
    if len(items) != len(texts):
        raise RuntimeError(f"model returned {len(items)} embeddings for {len(texts)} texts")
    if not any("index" in item for item in items):
        return [item["embedding"] for item in items]
    placed = {item.get("index"): item["embedding"] for item in items}
    if placed.keys() != set(range(len(texts))):
        raise RuntimeError(f"model returned wrong indexes for {len(texts)} texts")
    return [placed[i] for i in range(len(texts))]


def batch_infer(
    df: DataFrame,
    text_col: str,
    factory: Callable[[], Callable],
    *,
    out: str = "embedding",
    batch: int = 32,
    attempts: int = 4,
    backoff: float = 1.5,
    on_error: str = "raise",
    handle_name: str | None = None,
) -> DataFrame:
    """Add ``out: array<double>`` and ``error: string``.

    ``factory`` makes the model handle on the worker, when the first batch
    needs it.  ``on_error="record"`` keeps failed rows with a null vector and
    the message.  A task may run twice, so the model call must be repeatable.
    """
    if on_error not in ("raise", "record"):
        raise ValueError("on_error must be 'raise' or 'record'")
    if batch < 1 or attempts < 1:
        raise ValueError("batch and attempts must be positive")
    schema = T.StructType(
        df.schema.fields + [T.StructField(out, T.ArrayType(T.DoubleType())), T.StructField("error", T.StringType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = None
        for rows in batches:
            for at in range(0, rows.num_rows, batch):
                part = rows.slice(at, batch)
                texts = part.column(part.schema.get_field_index(text_col)).to_pylist()
                vectors, error = [None] * len(texts), None
                try:
                    if model is None:
                        model = _handle(handle_name, factory)
                    vectors = [
                        [float(v) for v in vector]
                        for vector in call_with_retry(model, texts, attempts, backoff)
                    ]
                except Exception as exc:
                    if on_error == "raise":
                        raise
                    error = str(exc)
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.columns,
                        pa.array(vectors, pa.list_(pa.float64())),
                        pa.array([error] * len(texts), pa.string()),
                    ],
                    names=[*part.schema.names, out, "error"],
                )

    return df.mapInArrow(run, schema)
