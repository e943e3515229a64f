"""Objects of large JSON arrays, split over many tasks.

A file holds an array of objects, or objects one after the other.  It is read
in pieces that end with a closing brace, which Spark can start to read
anywhere.  Two passes find the objects without reading a file in one piece: the
first learns, for each block (the byte range of one scan task) and for either
state it may begin in (inside a string or not), the state it ends in and how
the bracket depth changes; composed over the blocks, one small row each, this
gives the state in which each block begins.  The second pass cuts every block on
its own; an object that goes on in the next block leaves a part in both, and
these few parts are joined afterwards.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

_WHOLE, _END, _BEGIN = 0, 1, 2
# What may change the state: an escaped character (in strings only), a quote, a bracket.
_MARK = re.compile(r'\\.|["{}\[\]]', re.DOTALL)
_BETWEEN = re.compile(r"[\s,\[\]\ufeff]*")


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """``file, block, text, size`` (of the file): the pieces in order within each block, each but perhaps a file's last one ended by a brace."""
    rows = spark.read.option("lineSep", "}").text(path)
    return rows.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("value").alias("text"),
        F.col("_metadata.file_size").alias("size"),
    )


def _by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], list[str]]]:
    """Successive pieces of one block."""
    for batch in batches:
        files, blocks, texts = (batch.column(i).to_pylist() for i in range(3))
        at = 0
        while at < len(files):
            to = at
            while to < len(files) and (files[to], blocks[to]) == (files[at], blocks[at]):
                to += 1
            yield (files[at], blocks[at]), texts[at:to]
            at = to


def _walk(text: str, quoted: bool) -> tuple[bool, int]:
    """State after a piece, and the change of depth."""
    depth = 0
    for mark in _MARK.finditer(text):
        char = mark[0]
        if char == '"':
            quoted = not quoted
        elif not quoted and len(char) == 1:
            depth += 1 if char in "{[" else -1
    return quoted, depth


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block and state it may begin in: the state it ends in, and the change of depth; its bytes with a brace per piece."""
    held: dict[tuple[str, int], list] = {}
    for place, texts in _by_block(batches):
        own = held.setdefault(place, [[False, 0], [True, 0], "", 0])
        for text in texts:
            own[3] += len(text.encode()) + 1
            if not own[2]:
                own[2] = text.lstrip("\ufeff \t\r\n")[:1]
            for state in own[:2]:
                state[0], change = _walk(text + "}", state[0])
                state[1] += change
    rows = [(f, b, *own[0], *own[1], *own[2:]) for (f, b), own in held.items()]
    columns = list(zip(*rows)) if rows else [[]] * 8
    kinds = (pa.string(), pa.int64(), pa.bool_(), pa.int64(), pa.bool_(), pa.int64(), pa.string(), pa.int64())
    names = ["file", "block", "quoted0", "depth0", "quoted1", "depth1", "first", "bytes"]
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def _block_states(pieces: DataFrame) -> dict[tuple[str, int], tuple[bool, int, int]]:
    """Per block whether it begins in a string, its depth, and the depth between objects in its file."""
    schema = "file string, block bigint, quoted0 boolean, depth0 bigint, quoted1 boolean, depth1 bigint, first string, bytes bigint"
    found = pieces.select("file", "block", "text").mapInArrow(_summaries, schema)
    sizes = pieces.groupBy("file").agg(F.max("size").alias("size"))
    rows = found.join(sizes, "file").orderBy("file", "block").collect()  # one short row per block
    states: dict[tuple[str, int], tuple[bool, int, int]] = {}
    ends: dict[str, list] = {}
    for row in rows:
        base = int(row["first"] == "[")
        quoted, depth, base, _, read = ends.get(row["file"], [False, 0, base, 0, 0])
        states[row["file"], row["block"]] = (quoted, depth, base)
        depth += row["depth1"] if quoted else row["depth0"]
        quoted = row["quoted1"] if quoted else row["quoted0"]
        ends[row["file"]] = [quoted, depth, base, row["size"], read + row["bytes"]]
    # A brace too many was counted where a file does not end with one; a byte order mark is not read.
    bad = sorted(
        f for f, (quoted, depth, _, size, read) in ends.items() if quoted or depth != (-1 if read - size in (1, -2) else 0)
    )
    if bad:
        raise ValueError(f"brackets or quotes do not match in {bad[:5]}")
    return states


class _Cutter:
    def __init__(self, place: tuple[str, int], state: tuple[bool, int, int]):
        self.place = place
        self.quoted, self.depth, self.base = state
        self.held: list[str] = []
        self.inside, self.begun, self.number = self.depth > self.base, False, 0
        self.made: list[tuple[str, int, int, int, str]] = []

    def _emit(self, kind: int) -> None:
        self.made.append((*self.place, self.number, kind, "".join(self.held)))
        self.number += 1
        self.held = []

    def add(self, text: str) -> None:
        text += "}"
        at = 0
        for mark in _MARK.finditer(text):
            char = mark[0]
            if char == '"':
                if not self.inside:
                    raise ValueError(f"{self.place[0]} holds something else than objects")
                self.quoted = not self.quoted
            elif not self.quoted and len(char) == 1:
                if char == "{" and not self.inside:
                    self._between(text[at : mark.start()])
                    at, self.inside, self.begun = mark.start(), True, True
                self.depth += 1 if char in "{[" else -1
                if char == "}" and self.inside and self.depth == self.base:
                    self.held.append(text[at : mark.end()])
                    self._emit(_WHOLE if self.begun else _END)
                    at, self.inside = mark.end(), False
        if self.inside:
            self.held.append(text[at:])
        else:
            self._between(text[at:].removesuffix("}"))

    def _between(self, text: str) -> None:
        if not _BETWEEN.fullmatch(text):
            raise ValueError(f"{self.place[0]} holds something else than objects")

    def end(self) -> list[tuple[str, int, int, int, str]]:
        if self.held:
            self._emit(_BEGIN if self.begun else _END)
        return self.made


def _cut(batches: Iterator[pa.RecordBatch], states: dict) -> Iterator[pa.RecordBatch]:
    def rows(made: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*made)) if made else [[]] * 5
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["file", "block", "number", "kind", "text"])

    cutter = None
    for place, texts in _by_block(batches):
        if cutter is None or cutter.place != place:
            if cutter is not None:
                yield rows(cutter.end())
            cutter = _Cutter(place, states[place])
        for text in texts:
            cutter.add(text)
        made, cutter.made = cutter.made, []
        yield rows(made)
    if cutter is not None:
        yield rows(cutter.end())


def split_objects(spark: SparkSession, path: str) -> DataFrame:
    """``file, text``: every object of the files' arrays; objects may hold anything."""
    pieces = _pieces(spark, path)
    states = spark.sparkContext.broadcast(_block_states(pieces))
    schema = "file string, block bigint, number bigint, kind int, text string"
    found = pieces.select("file", "block", "text").mapInArrow(lambda b: _cut(b, states.value), schema)
    whole = found.filter(F.col("kind") == _WHOLE).select("file", "text")
    # At most two parts a block: a beginning opens an object, and ends that follow belong to it.
    order = Window.partitionBy("file").orderBy("block", "kind")
    opened = F.sum(F.when(F.col("kind") == _BEGIN, 1).otherwise(0)).over(order)
    texts = F.sort_array(F.collect_list(F.struct("block", "kind", "text")))
    joined = (
        found.filter(F.col("kind") != _WHOLE).withColumn("object", opened).groupBy("file", "object")
        .agg(F.array_join(F.transform(texts, lambda p: p["text"]), "").alias("text"))
    )
    return whole.unionByName(joined.select("file", "text"))
