"""Chunk-store append as the sink of a micro-batch stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from foliograph.plans.index import build_index
from foliograph.sources.chunk_store import ChunkStore


def index_batch(store: ChunkStore, source: str | None = None, **options) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: embeds cleaned papers and appends new chunks.

    A replayed batch finds its ids stored and adds nothing.  With ``source``, a
    name that goes with the query's checkpoint folder, it is not even read.
    """

    def write(papers: DataFrame, batch: int) -> None:
        build_index(papers, store, source=source, batch=batch, **options)

    return write
