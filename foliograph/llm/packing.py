"""Mixture-controlled packing by deficit round-robin over source queues.

Every window of ``window`` tokens is filled from the queues of all sources so
that each source's share of tokens follows its share of the corpus.

* Texts become ids once, written with a key per row to the shared folder.
* A source's queue is the sequence of its documents.  Where a document lies in
  its queue is a prefix sum in two levels (per task that encoded it, then
  inside that task), so no source meets in one task.
* The windows are dealt to parts of ``part_windows`` windows.  Up to the end of
  part c a source is due the share of all tokens that lie before that end,
  rounded cumulatively over the sources: every part holds whole windows
  exactly, and what rounding holds back from a source in one part (its deficit,
  below one token) is carried to the next, without any order of execution.
* Inside a part the round-robin runs: a visit adds a source's quantum to its
  deficit and the source sends packets of at most ``packet`` tokens while its
  deficit lasts; deficits go on from window to window.

Only the last window of all can be short.  Null or empty texts are one end id;
a null source is a queue of its own; repeated rows are packed as often as they
occur; an empty table gives no pieces; other columns are not looked at.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from foliograph.llm.word_bpe import word_bpe
from foliograph.session import scratch_path

_ROW_BITS = 33


def with_ids(
    docs: DataFrame, tokenizer_path: str, end_id: int, id_col: str, text_col: str, source_col: str
) -> DataFrame:
    """``row_key, doc, queue, n_tokens, ids``: ids as little-endian unsigned 16 or 32 bit numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from foliograph.llm.textbytes import text_slices

        bpe = word_bpe(tokenizer_path)
        width = np.dtype("<u2" if bpe.library.get_vocab_size() < 65_536 and end_id < 65_536 else "<u4")
        key = TaskContext.get().partitionId() << _ROW_BITS
        for batch in batches:
            for first, last, data, offsets in text_slices(batch.column(2)):
                ids, counts = bpe.encode(data, offsets)
                n = counts + 1
                stop = np.cumsum(n)
                whole = np.full(int(stop[-1]), end_id, width)
                text = np.ones(len(whole), np.bool_)
                text[stop - 1] = False
                whole[text] = ids
                edges = np.concatenate([[0], stop * width.itemsize]).astype(np.int32)
                keys = np.arange(key, key + len(n))
                key += len(n)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys),
                        batch.column(0).slice(first, last - first),
                        batch.column(1).slice(first, last - first),
                        pa.array(n),
                        pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(edges), pa.py_buffer(whole)]),
                    ],
                    names=["row_key", "doc", "queue", "n_tokens", "ids"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    queue = F.coalesce(F.concat(F.lit("s"), F.col(f"`{source_col}`").cast("string")), F.lit(""))
    return docs.select(F.col(f"`{id_col}`").alias("doc"), queue.alias("queue"), F.col(f"`{text_col}`").alias("text")).mapInArrow(
        run, f"row_key bigint, doc {kind}, queue string, n_tokens bigint, ids binary"
    )


def queue_positions(rows: DataFrame) -> DataFrame:
    """Add ``at``: tokens of the same queue before the row, in the order of ``row_key``."""
    keyed = rows.withColumn("task", F.shiftright("row_key", _ROW_BITS))
    before = Window.partitionBy("queue").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    base = (
        keyed.groupBy("queue", "task")
        .agg(F.sum("n_tokens").alias("n"))
        .select("queue", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    )
    inside = Window.partitionBy("queue", "task").orderBy("row_key").rowsBetween(Window.unboundedPreceding, -1)
    return (
        keyed.join(base, ["queue", "task"])
        .withColumn("at", F.col("base") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
        .drop("base", "task")
    )


def _due(share: str, part: Column, part_tokens: int, total: int) -> Column:
    """Tokens due before a part to the sources up to ``share`` in the cumulative order."""
    end = F.least(part * part_tokens, F.lit(total)).cast("decimal(18,0)")
    due = F.call_function("div", end * F.col(share).cast("decimal(18,0)"), F.lit(max(total, 1)).cast("decimal(18,0)"))
    return due.cast("bigint")


def dealt_to_parts(rows: DataFrame, part_tokens: int, total: int) -> DataFrame:
    """``part, queue, at, row_key, doc, start, length``: documents cut where parts end."""
    queues = rows.groupBy("queue").agg(F.sum("n_tokens").alias("own"))
    upto = Window.orderBy("queue")  # one short row per source
    shares = queues.select("queue", "own", F.sum("own").over(upto).alias("upto")).withColumn(
        "below", F.col("upto") - F.col("own")
    )

    def begin(part: Column) -> Column:
        return _due("upto", part, part_tokens, total) - _due("below", part, part_tokens, total)

    def near(at: Column) -> Column:
        return F.floor(at * (total / part_tokens) / F.col("own")).cast("bigint")

    parts = F.sequence(
        F.greatest(near(F.col("at")) - 1, F.lit(0)), near(F.col("at") + F.col("n_tokens")) + 1
    )
    cut = (
        queue_positions(rows)
        .join(shares, "queue")
        .withColumn("part", F.explode(parts))
        .withColumn("from", F.greatest("at", begin(F.col("part"))))
        .withColumn("to", F.least(F.col("at") + F.col("n_tokens"), begin(F.col("part") + 1)))
        .filter(F.col("to") > F.col("from"))
    )
    return cut.select(
        "part", "queue", F.col("from").alias("at"), "row_key",
        (F.col("from") - F.col("at")).alias("start"), (F.col("to") - F.col("from")).alias("length"),
    )


def round_robin(
    queues: list[deque], window: int, packet: int
) -> Iterator[tuple[int, int, int, int, int]]:
    """Pieces ``(row, start, length, window number, offset)`` of one part.

    Each queue holds ``[row, start, length]``.  Its quantum is its share of a
    window; a queue sends while its deficit covers the next packet.
    """
    share = [sum(p[2] for p in q) for q in queues]
    total = sum(share)
    deficit = [0.0] * len(queues)
    ring = deque(i for i, n in enumerate(share) if n)
    room, number = window, 0
    while ring:
        i = ring.popleft()
        queue = queues[i]
        deficit[i] += window * share[i] / total
        while queue:
            head = queue[0]
            send = min(head[2], packet)
            if deficit[i] < send and len(ring):
                break
            deficit[i] -= send
            while send:  # a packet may run over the end of a window
                take = min(send, room)
                yield head[0], head[1], take, number, window - room
                head[1] += take
                head[2] -= take
                send -= take
                room -= take
                if not room:
                    room, number = window, number + 1
            if not head[2]:
                queue.popleft()
        if queue:
            ring.append(i)


_PIECES = "row_key bigint, start bigint, length bigint, sequence_id bigint, offset bigint"


def _packed_part(part_windows: int, window: int, packet: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["queue", "at"], kind="stable")
        keys = rows["row_key"].to_numpy()
        queues: list[deque] = []
        heads = rows["queue"].ne(rows["queue"].shift()).to_numpy()
        for i, (new, start, length) in enumerate(zip(heads.tolist(), rows["start"].tolist(), rows["length"].tolist())):
            if new:
                queues.append(deque())
            queues[-1].append([i, start, length])
        made = np.array(list(round_robin(queues, window, packet)), np.int64).reshape(-1, 5)
        # Neighbouring packets of one document in one window are one piece.
        same = np.zeros(len(made), np.bool_)
        same[1:] = (made[1:, 0] == made[:-1, 0]) & (made[1:, 3] == made[:-1, 3])
        first = np.flatnonzero(~same)
        length = np.add.reduceat(made[:, 2], first)
        made = made[first]
        return pd.DataFrame(
            {
                "row_key": keys[made[:, 0]],
                "start": made[:, 1],
                "length": length,
                "sequence_id": int(rows["part"].iloc[0]) * part_windows + made[:, 3],
                "offset": made[:, 4],
            }
        )

    return pack


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    *,
    end_id: int = 1,
    window: int = 2048,
    packet: int = 512,
    part_windows: int = 256,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """One row per piece: ``<id_col>, start, length, ids_crc32, doc_tokens, sequence_id, offset``."""
    spark = docs.sparkSession
    path = scratch_path(spark, "packing-ids")
    with_ids(docs, tokenizer_path, end_id, id_col, text_col, source_col).write.option("compression", "zstd").parquet(path)
    stored = spark.read.parquet(path)
    rows = stored.select("row_key", "queue", "n_tokens")
    total = rows.agg(F.coalesce(F.sum("n_tokens"), F.lit(0))).first()[0]
    parts = dealt_to_parts(rows, window * part_windows, total)
    pieces = parts.groupBy("part").applyInPandas(_packed_part(part_windows, window, packet), _PIECES)
    per_row = pieces.groupBy("row_key").agg(
        F.collect_list(F.struct("start", "length", "sequence_id", "offset")).alias("pieces")
    )
    whole = stored.select("row_key", "doc", "n_tokens", "ids").join(per_row.hint("shuffle_hash"), "row_key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column(1).to_numpy()
            lists = batch.column(3)
            pieces = lists.flatten()
            count = lists.value_lengths().to_numpy()
            row = np.repeat(np.arange(len(n)), count)
            fields = {f: pieces.field(f) for f in ("start", "length", "sequence_id", "offset")}
            crc = np.empty(len(row), np.int64)
            start, length = fields["start"].to_pylist(), fields["length"].to_pylist()
            at = 0
            for i, ids in enumerate(batch.column(2)):
                raw = ids.as_buffer()
                own = np.frombuffer(raw, f"<u{raw.size // int(n[i])}").astype("<u4")
                for j in range(at, at + int(count[i])):
                    crc[j] = zlib.crc32(own[start[j] : start[j] + length[j]])
                at += int(count[i])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(row)),
                    fields["start"],
                    fields["length"],
                    pa.array(crc),
                    pa.array(n[row]),
                    fields["sequence_id"],
                    fields["offset"],
                ],
                names=[id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return whole.select("doc", "n_tokens", "ids", "pieces").mapInArrow(
        run,
        f"`{id_col}` {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
        "sequence_id bigint, offset bigint",
    )
