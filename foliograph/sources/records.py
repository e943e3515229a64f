"""Records of large delimited files with line breaks inside quotes, split over many tasks.

A line begins a record if an even number of quotes stands before it in its
file.  Two passes find that without reading a file in one piece: the first
counts quotes and lines per block (the byte range of one scan task), and prefix
sums over the blocks, one small row each, give the state in which each block
begins; the second cuts every block on its own.  A record that goes on in the
next block leaves a piece in both; these few pieces are joined afterwards.

An opening quote must be closed and a quote inside a text doubled; a file with
an odd number of quotes is an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

# A whole record, the end of one from an earlier block, and the beginning of one that goes on.
_WHOLE, _END, _BEGIN = 0, 1, 2
_PIECES = "file string, block bigint, line bigint, kind int, text string"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, block, text``: the lines in order within each block."""
    rows = spark.read.option("lineSep", "\n").text(path)
    return rows.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("text")
    )


def _quotes(text: Column | str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit('"'), F.lit("")))


def _block_states(lines: DataFrame, multi_line: bool) -> dict[tuple[str, int], tuple[int, int]]:
    """Per block whether it begins inside quotes, and the number of its first line."""
    quotes = F.sum(_quotes("text")) if multi_line else F.lit(0)
    sums = lines.groupBy("file", "block").agg(quotes.alias("quotes"), F.count("*").alias("lines"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file")
    rows = sums.select(
        "file",
        "block",
        (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2).alias("open"),
        (F.coalesce(F.sum("lines").over(before), F.lit(0)) + 1).alias("line"),
        (F.sum("quotes").over(whole) % 2).alias("odd"),
    ).collect()  # one short row per block
    odd = sorted({r["file"] for r in rows if r["odd"]})
    if odd:
        raise ValueError(f"a quote is never closed in {odd[:5]}")
    return {(r["file"], r["block"]): (r["open"], r["line"]) for r in rows}


class _Cutter:
    """Cuts the lines of successive blocks into records and pieces of records."""

    def __init__(self, states: dict[tuple[str, int], tuple[int, int]], multi_line: bool):
        self.states, self.multi_line = states, multi_line
        self.place: tuple[str, int] | None = None
        self.held: list[str] = []  # lines of the record that is open
        self.held_line = self.line = self.open = 0
        self.begun = False  # whether the held lines begin a record in this block

    def add(self, place: tuple[str, int], text: pa.Array) -> Iterator[tuple[list[int], list[int], list[str]]]:
        """``line, kind, text`` of what is complete after these lines of a block."""
        quotes = pc.count_substring(text, '"').to_numpy(zero_copy_only=False) if self.multi_line else np.zeros(len(text), np.int64)
        after = (self.open + np.cumsum(quotes)) % 2
        starts = np.concatenate([[self.open], after[:-1]]) == 0
        self.open = int(after[-1]) if len(after) else self.open
        edge = np.flatnonzero(starts)
        lines, kinds, texts = [], [], []
        head = int(edge[0]) if len(edge) else len(text)
        self.held += text.slice(0, head).to_pylist()
        if len(edge):
            if self.held:
                lines.append(self.held_line)
                kinds.append(_WHOLE if self.begun else _END)
                texts.append("\n".join(self.held))
            last = int(edge[-1])
            single = edge[:-1][np.diff(edge) == 1]
            many = edge[:-1][np.diff(edge) > 1]
            lines += (single + self.line).tolist()
            texts += text.take(pa.array(single)).to_pylist()
            for a, b in zip(many.tolist(), edge[1:][np.diff(edge) > 1].tolist()):
                lines.append(a + self.line)
                texts.append("\n".join(text.slice(a, b - a).to_pylist()))
            kinds += [_WHOLE] * (len(texts) - len(kinds))
            self.held, self.held_line, self.begun = text.slice(last).to_pylist(), self.line + last, True
        self.line += len(text)
        yield lines, kinds, texts

    def begin(self, place: tuple[str, int]) -> None:
        self.place, (self.open, self.line) = place, self.states[place]
        self.held, self.held_line, self.begun = [], self.line, False

    def end(self) -> Iterator[tuple[list[int], list[int], list[str]]]:
        """What the block leaves."""
        if self.held:
            kind = (_BEGIN if self.open else _WHOLE) if self.begun else _END
            yield [self.held_line], [kind], ["\n".join(self.held)]


def _pieces(batches: Iterator[pa.RecordBatch], states: dict, multi_line: bool) -> Iterator[pa.RecordBatch]:
    cutter = _Cutter(states, multi_line)

    def rows(place: tuple[str, int], made) -> Iterator[pa.RecordBatch]:
        for lines, kinds, texts in made:
            if lines:
                columns = [
                    pa.array([place[0]] * len(lines), pa.string()),
                    pa.array([place[1]] * len(lines), pa.int64()),
                    pa.array(lines, pa.int64()),
                    pa.array(kinds, pa.int32()),
                    pa.array(texts, pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["file", "block", "line", "kind", "text"])

    for batch in batches:
        files, blocks = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        at = 0
        while at < len(files):
            place, to = (files[at], blocks[at]), at
            while to < len(files) and blocks[to] == place[1] and files[to] == place[0]:
                to += 1
            if place != cutter.place:
                if cutter.place is not None:
                    yield from rows(cutter.place, cutter.end())
                cutter.begin(place)
            yield from rows(place, cutter.add(place, batch.column(2).slice(at, to - at)))
            at = to
    if cutter.place is not None:
        yield from rows(cutter.place, cutter.end())


def split_records(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """``file, line, text``: every record with the number of the line it begins in, from 1; empty lines are no records."""
    lines = _lines(spark, path)
    states = spark.sparkContext.broadcast(_block_states(lines, multi_line))
    pieces = lines.mapInArrow(lambda b: _pieces(b, states.value, multi_line), _PIECES)
    whole = pieces.filter(F.col("kind") == _WHOLE).select("file", "line", "text")
    # At most two pieces a block: a beginning opens a record, and ends that follow belong to it.
    order = Window.partitionBy("file").orderBy("block", "kind")
    opened = F.sum(F.when(F.col("kind") == _BEGIN, 1).otherwise(0)).over(order)
    parts = pieces.filter(F.col("kind") != _WHOLE).withColumn("record", opened)
    texts = F.sort_array(F.collect_list(F.struct("block", "kind", "text")))
    joined = parts.groupBy("file", "record").agg(
        F.min("line").alias("line"), F.array_join(F.transform(texts, lambda p: p["text"]), "\n").alias("text")
    )
    rows = whole.unionByName(joined.select("file", "line", "text")) if multi_line else whole
    text = F.when(F.endswith("text", F.lit("\r")), F.expr("substring(text, 1, length(text) - 1)")).otherwise(F.col("text"))
    return rows.withColumn("text", text).filter(F.col("text") != "")
