"""Connected components by alternating large and small stars, or in one task where links are few."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from foliograph.session import scratch_path

# Links that one task follows, 16 bytes each.
FEW_LINKS = 1_000_000


def _stored(df: DataFrame) -> DataFrame:
    path = scratch_path(df.sparkSession, "components")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first()
    return tuple(row)


def least_reachable(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of the links, and the smallest node each one is connected with."""
    nodes, number = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = number[: len(u)], number[len(u) :]
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[a], label[b])
        new = label.copy()
        # Both ends, and the nodes their labels name, take the smaller label.
        for at in (a, b, label[a], label[b]):
            np.minimum.at(new, at, least)
        while (new[new] != new).any():
            new = new[new]
        if (new == label).all():
            return nodes, nodes[label]
        label = new


def _in_one_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    u, v = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for batch in batches:
        u.append(batch.column(0).to_numpy())
        v.append(batch.column(1).to_numpy())
    nodes, least = least_reachable(np.concatenate(u), np.concatenate(v))
    yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(least)], names=["node", "component"])


def components(links: DataFrame, a: str, b: str, few_links: int = FEW_LINKS) -> DataFrame:
    """``node, component`` for every node of a link; a component is named by its smallest node.

    The distinct links are stored and counted.  Up to ``few_links`` of them are
    followed in one task.  With more, each round points neighbours at the
    smallest one they can see, so long chains halve; all steps are aggregates
    with map-side combining and joins.  Links to itself are allowed.
    """
    low, high = F.least(a, b), F.greatest(a, b)
    edges = _stored(links.select(high.alias("u"), low.alias("v")).filter("u <> v").distinct())
    if edges.count() <= few_links:
        return edges.coalesce(1).mapInArrow(_in_one_task, "node bigint, component bigint")
    before = _state(edges)
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # Stored, so that the joins meet plain shuffles, whose hot keys are split.
        large = _stored(
            both.join(_stored(least), "u")
            .filter("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .filter("u <> v")
            .distinct()
        )
        # Small star: every neighbour below a node, and the node, point at the least of them.
        down = _stored(large.groupBy("u").agg(F.min("v").alias("m")))
        edges = _stored(
            large.join(down, "u")
            .select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
            .filter("u <> v")
            .distinct()
        )
        after = _state(edges)
        if after == before:
            break
        before = after
    return edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
