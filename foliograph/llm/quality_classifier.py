"""Regularised quadratic discriminant over transformed document statistics.

Each class has a mean and a covariance that is shrunk towards the pooled one
and towards its own diagonal; the score is the logistic of the difference of
the two Gaussian log densities, with Mahalanobis terms from Cholesky factors
computed once.  Fitting takes one pass over all labelled rows: tasks send sums,
sums of products and counts per class, a few hundred numbers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from foliograph.llm.doc_statistics import NAMES, statistic_batches, statistics
from foliograph.llm.textbytes import text_slices
from foliograph.session import scratch_path

D = len(NAMES)


@dataclass(frozen=True)
class Discriminant:
    """Means, inverse Cholesky factors and log determinants of classes 0 and 1."""

    shift: np.ndarray
    scale: np.ndarray
    means: tuple[np.ndarray, ...]
    roots: tuple[np.ndarray, ...]
    logdets: tuple[float, ...]
    log_odds: float
    temper: float

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Probability of class 1."""
        x = np.clip((rows - self.shift) / self.scale, -12, 12)
        density = [
            -0.5 * (((x - m) @ r.T) ** 2).sum(axis=1) - 0.5 * d for m, r, d in zip(self.means, self.roots, self.logdets)
        ]
        margin = self.temper * (density[1] - density[0]) + self.log_odds
        return 1 / (1 + np.exp(-np.clip(margin, -60, 60)))


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((2, 1 + D + D * D))
    for batch in batches:
        label = batch.column(0).to_numpy()
        rows = batch.column(1).flatten().to_numpy().reshape(-1, D)
        for k in (0, 1):
            own = rows[label == k]
            total[k] += np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).ravel()])
    k, i = np.divmod(np.arange(total.size), total.shape[1])
    yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(i), pa.array(total.ravel())], names=["k", "i", "v"])


def fit(labelled: DataFrame, shrink_pooled: float = 0.1, shrink_diagonal: float = 0.1, temper: float = 0.5) -> Discriminant:
    """``labelled`` has ``label`` (0 or 1) and ``statistics``.

    A class without rows gets the pooled mean and covariance, so that without
    labels every score is one half.
    """
    sums = np.zeros((2, 1 + D + D * D))
    grouped = labelled.select(F.col("label").cast("int"), "statistics").mapInArrow(_moments, "k bigint, i bigint, v double")
    for row in grouped.groupBy("k", "i").agg(F.sum("v").alias("v")).collect():  # at most 2 * (1 + D + D * D) rows
        sums[row["k"], row["i"]] = row["v"]
    count, first, second = sums[:, 0], sums[:, 1 : 1 + D], sums[:, 1 + D :].reshape(2, D, D)
    n = max(count.sum(), 1.0)
    shift = first.sum(axis=0) / n
    scale = np.sqrt(np.maximum(np.diag(second.sum(axis=0)) / n - shift**2, 1e-6))

    means, scatter = [], []
    for k in (0, 1):
        mean = first[k] / count[k] if count[k] else shift
        around = second[k] - np.outer(first[k], first[k]) / max(count[k], 1.0)
        means.append((mean - shift) / scale)
        scatter.append(around / np.outer(scale, scale))
    pooled = (scatter[0] + scatter[1]) / n
    roots, logdets = [], []
    for k in (0, 1):
        own = scatter[k] / count[k] if count[k] > D else pooled
        mixed = (1 - shrink_pooled) * own + shrink_pooled * pooled
        mixed = (1 - shrink_diagonal) * mixed + shrink_diagonal * np.diag(np.diag(mixed)) + 1e-3 * np.eye(D)
        low = np.linalg.cholesky(mixed)
        roots.append(np.linalg.inv(low))
        logdets.append(2 * float(np.log(np.diag(low)).sum()))
    odds = float(np.log((count[1] + 1) / (count[0] + 1))) if count.all() else 0.0
    if not count.all():  # nothing tells the classes apart
        means, roots, logdets = [means[0]] * 2, [roots[0]] * 2, [0.0, 0.0]
    return Discriminant(shift, scale, tuple(means), tuple(roots), tuple(logdets), odds, temper)


def statistics_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, statistics`` per row, kept in the shared folder."""
    path = scratch_path(docs.sparkSession, "quality-statistics")
    kind = docs.schema[id_col].dataType.simpleString()
    docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")).mapInArrow(
        statistic_batches, f"id {kind}, statistics array<double>"
    ).write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def _fitted(docs: DataFrame, labels: DataFrame, label_col: str, folds: int, id_col: str, text_col: str):
    rows = statistics_of(docs, id_col, text_col)
    held_out = F.coalesce(F.crc32(F.col("id").cast("string")) % folds == 0, F.lit(False))
    known = labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").alias("label")).filter("label in (0, 1)")
    return rows, held_out, fit(rows.filter(~held_out).join(known, "id"))


def good_documents(
    docs: DataFrame,
    labels: DataFrame,
    *,
    label_col: str = "quality",
    folds: int = 5,
    threshold: float = 0.3,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs`` that are predicted to be good, with all their columns."""
    _, _, model = _fitted(docs, labels, label_col, folds, id_col, text_col)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in text_slices(batch.column(at)):
                good = model.score(statistics(data, offsets)) >= threshold
                yield batch.slice(first, last - first).filter(pa.array(good))

    return docs.mapInArrow(run, docs.schema)


def classified(
    docs: DataFrame,
    labels: DataFrame,
    *,
    label_col: str = "quality",
    folds: int = 5,
    threshold: float = 0.3,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``<id_col>, held_out, score, predicted`` per row.

    Labels of rows whose id, as text, has a CRC-32 divisible by ``folds`` are
    held out.  Null labels and ids teach nothing; a null text is scored as an
    empty one; a null id is not held out; repeated rows are scored alike and
    count as often in fitting; an empty table gives none.
    """
    rows, held_out, model = _fitted(docs, labels, label_col, folds, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(2).flatten().to_numpy().reshape(-1, D)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(model.score(x))], names=["id", "held_out", "score"]
            )

    kind = docs.schema[id_col].dataType.simpleString()
    scored = rows.select("id", held_out.alias("held_out"), "statistics").mapInArrow(
        run, f"id {kind}, held_out boolean, score double"
    )
    return scored.select(
        F.col("id").alias(id_col), "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
