"""Rows of a large stored table for some ids, without moving the table.

The files that hold the ids are found first, from a small table of the ids each
file holds or from the table's id column alone.  Wide columns are then read
from those files only.  Up to ``BROADCAST_ROWS`` ids go to the scan at once;
more are dealt to groups of files, each group with at most that many ids, which
are read one group after the other.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, functions as F, types as T

from foliograph.session import scratch_path

# Files from which on it pays to find out which ones hold the ids.
MANY_FILES = 64
# Ids a scan is given at once.
BROADCAST_ROWS = 200_000
# Ids that are written into the scan's filter, to be held against statistics and Bloom filters.
FEW_IDS = 500


def key_ranges(table: DataFrame, id_col: str) -> DataFrame:
    """``file, low, high``: the smallest and largest id of each file."""
    placed = table.select(id_col, F.col("_metadata.file_path").alias("file"))
    return placed.groupBy("file").agg(F.min(id_col).alias("low"), F.max(id_col).alias("high"))


class KeyedFiles:
    """A stored table with the id range of each of its files."""

    def __init__(self, table: DataFrame, id_col: str, ranges: DataFrame):
        self.table, self.id_col, self.ranges = table, id_col, ranges

    def located(self, ids: DataFrame) -> DataFrame:
        """``id, file`` for every file whose range holds the id; the table is not read."""
        held = self.ranges.orderBy("low", "high", "file").collect()  # a row per file
        low, high = np.array([r["low"] for r in held]), np.array([r["high"] for r in held])
        top = np.array(list(accumulate((r["high"] for r in held), max)))  # an earlier range may reach farther
        shared = self.table.sparkSession.sparkContext.broadcast((low, high, top, [r["file"] for r in held]))
        id_col = self.id_col

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            low, high, top, files = shared.value
            for batch in batches:
                if not batch.num_rows:
                    continue
                keys = np.array(batch.column(0).to_pylist())
                first, last = np.searchsorted(top, keys, "left"), np.searchsorted(low, keys, "right")
                pairs = [(i, f) for i, (a, b) in enumerate(zip(first, last)) for f in range(a, b) if high[f] >= keys[i]]
                rows = pa.array([i for i, _ in pairs], pa.int64())
                names = pa.array([files[f] for _, f in pairs], pa.string())
                yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), names], names=[id_col, "file"])

        schema = T.StructType([ids.schema[id_col], T.StructField("file", T.StringType())])
        wanted = ids.select(id_col).filter(F.col(id_col).isNotNull())
        return wanted.mapInArrow(place, schema) if held else self.table.sparkSession.createDataFrame([], schema)


def _located(table: DataFrame, ids: DataFrame, id_col: str) -> DataFrame | None:
    """``id, file`` by the table's id column, or None if its rows have no file of their own."""
    try:
        placed = table.select(id_col, F.col("_metadata.file_path").alias("file"))
        return placed.join(ids.select(id_col).distinct(), id_col, "left_semi").distinct()
    except AnalysisException:
        return None  # derived or cached


def fetch(
    table: DataFrame,
    ids: DataFrame,
    id_col: str,
    columns: list[str],
    *,
    keyed: KeyedFiles | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
    many_files: int = MANY_FILES,
) -> DataFrame:
    """``columns``, with ``id_col`` among them, of the rows whose id is in ``ids``.

    ``ids`` should be stored, since it is read several times; ids may repeat
    there.  The table is never shuffled, unless it is a derived one.
    """
    distinct = ids.select(id_col).distinct()
    if distinct.count() <= broadcast_rows:
        rows = _narrowed(table, distinct, id_col, keyed, many_files).select(*columns)
        return rows.join(F.broadcast(distinct), id_col, "left_semi").select(*columns)
    placed = keyed.located(distinct) if keyed else _located(table, distinct, id_col)
    if placed is None:
        return table.select(*columns).join(distinct, id_col, "left_semi").select(*columns)
    return _by_groups(table, placed, id_col, columns, broadcast_rows)


def _narrowed(table: DataFrame, distinct: DataFrame, id_col: str, keyed: KeyedFiles | None, many_files: int) -> DataFrame:
    """The files of ``table`` that may hold the ids; a few ids are held against their statistics too."""
    wide = table
    if keyed is not None or len(table.inputFiles()) >= many_files:
        placed = keyed.located(distinct) if keyed else _located(table, F.broadcast(distinct), id_col)
        if placed is not None:
            files = [r["file"] for r in placed.select("file").distinct().collect()]  # at most one per id and folder
            wide = table.filter(F.col("_metadata.file_path").isin(files))
    few = distinct.limit(FEW_IDS + 1).collect()
    return wide.filter(F.col(id_col).isin([r[0] for r in few])) if len(few) <= FEW_IDS else wide


def _by_groups(table: DataFrame, placed: DataFrame, id_col: str, columns: list[str], broadcast_rows: int) -> DataFrame:
    """The located rows, group of files after group of files."""
    spark = table.sparkSession
    path = scratch_path(spark, "located")
    placed.write.parquet(f"{path}/ids")
    stored = spark.read.parquet(f"{path}/ids")
    counts = stored.groupBy("file").agg(F.count("*").alias("n")).orderBy("file").collect()  # a row per file
    groups, room = [], 0
    for row in counts:
        if row["n"] > room or not groups:
            groups.append([])
            room = broadcast_rows
        groups[-1].append(row["file"])
        room -= row["n"]
    number = spark.createDataFrame([(f, g) for g, files in enumerate(groups) for f in files], "file string, part int")
    dealt = stored.join(F.broadcast(number), "file").select(id_col, "part").distinct()
    dealt.repartition("part").write.partitionBy("part").parquet(f"{path}/dealt")
    dealt = spark.read.parquet(f"{path}/dealt")
    for part, files in enumerate(groups):
        wanted = dealt.filter(F.col("part") == part).select(id_col)
        rows = table.filter(F.col("_metadata.file_path").isin(files)).select(*columns)
        rows.join(F.broadcast(wanted), id_col, "left_semi").select(*columns).write.mode("append").parquet(f"{path}/rows")
    return spark.read.parquet(f"{path}/rows")


def rows_for(
    table: DataFrame,
    ids: DataFrame,
    id_col: str,
    columns: list[str],
    *,
    keyed: KeyedFiles | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
    many_files: int = MANY_FILES,
) -> DataFrame:
    """``columns`` of ``table`` joined with the rows of ``ids``, which should be stored."""
    if ids.count() <= broadcast_rows:
        rows = _narrowed(table, ids.select(id_col).distinct(), id_col, keyed, many_files).select(*columns)
        return rows.join(F.broadcast(ids), id_col)
    found = fetch(table, ids, id_col, columns, keyed=keyed, broadcast_rows=broadcast_rows, many_files=many_files)
    return found.join(ids, id_col)
