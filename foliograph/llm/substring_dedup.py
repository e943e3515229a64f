"""Removal of repeated passages by sharded FM-indexes.

A window of ``length`` words is repeated if its word sequence starts anywhere
else too.  Windows are routed by content, so that a shard holds all that could
equal its windows and no text is searched in every shard:

* The anchor of a window is the leftmost of its smallest ``GRAM``-word hashes.
  Equal windows have equal anchors.  Successive windows with one anchor are one
  stretch (at most 28 windows).
* Anchors that occur once in the corpus (nearly all of natural text) cannot
  belong to a repeated window and leave after one count.
* Equal stretches are counted, not copied: a stretch that occurs twice is
  repeated as a whole, whatever the size of its group.
* Anchors with several different stretches go to shards: a task collects whole
  anchors up to ``SHARD_WORDS`` words, builds a compressed FM-index over them
  and streams the stretches through it backwards; windows whose matching
  statistic reaches ``length`` are repeated.
* An anchor with more than ``WIDE`` different stretches would be too large for
  one index.  Its windows are dealt one by one by their own content and counted.

Stretches and intervals are short rows of numbers; each text is read three
times and moved twice: to where its stretches are wanted, and to its removals.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from foliograph.llm.fm_index import FmIndex, matching_statistics
from foliograph.llm.shingles import windows
from foliograph.llm.textbytes import gather_ranges, hash_spans, mix, split_words, text_slices
from foliograph.session import scratch_path

GRAM = 8
SHARD_WORDS = 400_000
WIDE = 10_000
_COUNT_BITS = 6


def _stored(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _anchors(words: np.ndarray, first: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Stretches of all texts: anchor hash, text, first word (in ``words``) and number of windows."""
    none = np.empty(0, np.int64)
    width = length - GRAM + 1
    starts = gather_ranges(first[:-1], np.maximum(np.diff(first) - length + 1, 0))
    if not len(starts):
        return np.empty(0, np.uint64), none, none, none
    value = windows(words, GRAM)
    place = np.arange(len(value))
    reach = 1
    while reach < width:
        step = min(reach, width - reach)
        n = len(value) - step
        right = value[step:] < value[:n]
        place = np.where(right, place[step:], place[:n])
        value = np.where(right, value[step:], value[:n])
        reach += step
    at = place[starts]
    text = np.searchsorted(first, starts, "right") - 1
    new = np.ones(len(starts), np.bool_)
    new[1:] = (at[1:] != at[:-1]) | (text[1:] != text[:-1])
    head = np.flatnonzero(new)
    count = np.diff(np.concatenate([head, [len(starts)]]))
    return value[starts[head]], text[head], starts[head], count


def _range_hashes(words: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    base = 0xD1342543DE82EF95
    power = np.full(len(words) + 1, np.uint64(base))
    power[0] = 1
    power = np.multiply.accumulate(power)
    inverse = np.full(len(words) + 1, np.uint64(pow(base, -1, 1 << 64)))
    inverse[0] = 1
    inverse = np.multiply.accumulate(inverse)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * power[:-1])])
    return mix((total[start + size] - total[start]) * inverse[start] + size.astype(np.uint64))


def _word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, first = split_words(data, offsets)
    return hash_spans(data, starts, ends), first


def _anchor_counts(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, _, data, offsets in text_slices(batch.column(0)):
            anchor, _, _, _ = _anchors(*_word_hashes(data, offsets), length)
            distinct, count = np.unique(anchor, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(distinct.view(np.int64)), pa.array(count)], names=["anchor", "n"]
            )


def _stretches(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """k1, k2, text -> anchor, content, k1, k2, place (first word and number of windows in one number)."""
    for batch in batches:
        for begin, last, data, offsets in text_slices(batch.column(2)):
            words, first = _word_hashes(data, offsets)
            anchor, text, start, count = _anchors(words, first, length)
            content = _range_hashes(words, start, count + length - 1)
            place = (start - first[text]) << _COUNT_BITS | count
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(anchor.view(np.int64)),
                    pa.array(content.view(np.int64)),
                    batch.column(0).slice(begin, last - begin).take(pa.array(text)),
                    batch.column(1).slice(begin, last - begin).take(pa.array(text)),
                    pa.array(place),
                ],
                names=["anchor", "content", "k1", "k2", "place"],
            )


def _stretch_words(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """text, stretches -> anchor, content, words (hashes of the stretch as bytes)."""
    for batch in batches:
        lists = batch.column(1)
        size = lists.value_lengths().to_numpy()
        rows, at = lists.flatten(), np.concatenate([[0], np.cumsum(size)])
        anchor, content = rows.field("anchor"), rows.field("content")
        start = rows.field("start").to_numpy()
        count = rows.field("count").to_numpy()
        for begin, last, data, offsets in text_slices(batch.column(0)):
            words, first = _word_hashes(data, offsets)
            own = slice(int(at[begin]), int(at[last]))
            from_ = start[own] + np.repeat(first[:-1], size[begin:last])
            n = count[own] + length - 1
            edges = (np.concatenate([[0], np.cumsum(n)]) * 8).astype(np.int32)
            values = words[gather_ranges(from_, n)]
            yield pa.RecordBatch.from_arrays(
                [
                    anchor.slice(own.start, own.stop - own.start),
                    content.slice(own.start, own.stop - own.start),
                    pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(edges), pa.py_buffer(values)]),
                ],
                names=["anchor", "content", "words"],
            )


def _shard_masks(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """anchor, content, words, in order of anchors -> anchor, content, mask of repeated windows."""
    held, size = [], 0
    for batch in batches:
        # One Arrow batch at a time joins the shard; a shard ends with an anchor.
        held.append(batch)
        size += batch.column(2).nbytes // 8
        if size < SHARD_WORDS:
            continue
        joined = pa.concat_batches(held)
        anchor = joined.column(0).to_numpy()
        edges = np.flatnonzero(anchor[1:] != anchor[:-1]) + 1
        begin = 0
        ends = np.cumsum([len(w) // 8 for w in joined.column(2).to_pylist()])
        for edge in edges.tolist():
            if ends[edge - 1] - (ends[begin - 1] if begin else 0) >= SHARD_WORDS or edge == edges[-1]:
                yield _masks(joined.slice(begin, edge - begin), length)
                begin = edge
        rest = joined.slice(begin)
        held, size = [rest], sum(len(w) for w in rest.column(2).to_pylist()) // 8
    if held:
        yield _masks(pa.concat_batches(held), length)


def _masks(shard: pa.RecordBatch, length: int) -> pa.RecordBatch:
    raw = shard.column(2).to_pylist()
    size = np.array([len(w) // 8 for w in raw], np.int64)
    words = np.frombuffer(b"".join(raw), np.uint64)
    # Stretches stand one after the other, each behind a separator.
    begin = np.cumsum(size + 1) - size
    symbols = np.zeros(int((size + 1).sum()), np.int64)
    _, numbers = np.unique(words, return_inverse=True)
    symbols[gather_ranges(begin, size)] = numbers + 1
    count = size - length + 1
    window = gather_ranges(np.zeros(len(size), np.int64), count)
    ends = np.repeat(begin, count) + window + length
    mask = np.zeros(len(size), np.int64)
    if len(symbols):
        found = matching_statistics(FmIndex(symbols, length + 1), symbols, ends, length) >= length
        np.bitwise_or.at(mask, np.repeat(np.arange(len(size)), count)[found], 1 << window[found])
    return pa.RecordBatch.from_arrays([shard.column(0), shard.column(1), pa.array(mask)], names=["anchor", "content", "mask"])


def _single_windows(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """anchor, content, words -> anchor, content, bit, and two hashes of each window."""
    for batch in batches:
        for row in range(len(batch)):
            words = np.frombuffer(batch.column(2)[row].as_buffer(), np.uint64)
            own = windows(words, length)
            again = windows(mix(words), length)
            n = len(own)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(batch.column(0)[row].as_py(), n)),
                    pa.array(np.repeat(batch.column(1)[row].as_py(), n)),
                    pa.array(1 << np.arange(n)),
                    pa.array(own.view(np.int64)),
                    pa.array(again.view(np.int64)),
                ],
                names=["anchor", "content", "bit", "w1", "w2"],
            )


def _keyed(docs: DataFrame, id_col: str, text_col: str, *carried: Column) -> DataFrame:
    """``k1, k2, text``: two 64-bit hashes of id and text, so rows share a key only if both are equal."""
    text = F.col(f"`{text_col}`")
    ids = F.col(f"`{id_col}`").cast("bigint")
    return docs.select(
        F.xxhash64(ids, text).alias("k1"),
        # A hash is the seed of the next column's: the number comes first.
        F.xxhash64(F.lit(1), ids, text).alias("k2"),
        text.alias("text"),
        *carried,
    )


def repeated_windows(keyed: DataFrame, length: int, wide: int = WIDE) -> DataFrame:
    """``k1, k2, runs``: per document with repeated windows the (first word, mask) of its stretches."""
    counts = keyed.select("text").mapInArrow(lambda b: _anchor_counts(b, length), "anchor bigint, n bigint")
    # Stored, so that the joins meet plain shuffles, whose hot keys are split.
    again = _stored(counts.groupBy("anchor").agg(F.sum("n").alias("n")).filter("n > 1").select("anchor"), "substring-anchors")
    stretches = _stored(
        keyed.mapInArrow(
            lambda b: _stretches(b, length), "anchor bigint, content bigint, k1 bigint, k2 bigint, place bigint"
        ).join(again, "anchor", "left_semi"),
        "substring-stretches",
    )
    distinct = _stored(
        stretches.groupBy("anchor", "content").agg(
            F.count("*").alias("n"), F.min(F.struct("k1", "k2", "place")).alias("seen")
        ),
        "substring-distinct",
    )
    kinds = distinct.groupBy("anchor").agg(F.count("*").alias("kinds"))
    windows_of = F.col("seen.place").bitwiseAND((1 << _COUNT_BITS) - 1).cast("int")
    full = F.expr(f"shiftleft(1L, cast(seen.place & {(1 << _COUNT_BITS) - 1} as int)) - 1")
    whole = distinct.filter("n > 1").select("anchor", "content", full.alias("mask"))
    several = kinds.filter("kinds > 1")
    search = distinct.join(several, "anchor").select(
        "anchor", "content", "kinds", "n",
        "seen.k1", "seen.k2",
        F.shiftright("seen.place", _COUNT_BITS).alias("start"),
        windows_of.cast("bigint").alias("count"),
    )
    wanted = _stored(
        search.groupBy("k1", "k2").agg(F.collect_list(F.struct("anchor", "content", "start", "count")).alias("stretches")),
        "substring-wanted",
    )
    # Equal rows (id and text) give their stretches more than once.
    content = (
        keyed.join(wanted.hint("shuffle_hash"), ["k1", "k2"])
        .select("text", "stretches")
        .mapInArrow(lambda b: _stretch_words(b, length), "anchor bigint, content bigint, words binary")
    )
    narrow = content.join(several.filter(f"kinds <= {wide}"), "anchor", "left_semi")
    masks = (
        narrow.repartition("anchor").dropDuplicates(["anchor", "content"]).sortWithinPartitions("anchor")
        .mapInArrow(lambda b: _shard_masks(b, length), "anchor bigint, content bigint, mask bigint")
    )
    single = content.join(several.filter(f"kinds > {wide}"), "anchor", "left_semi").mapInArrow(
        lambda b: _single_windows(b, length), "anchor bigint, content bigint, bit bigint, w1 bigint, w2 bigint"
    ).distinct()
    twice = single.groupBy("w1", "w2").agg(F.count("*").alias("n")).filter("n > 1").select("w1", "w2")
    dealt = single.join(twice, ["w1", "w2"], "left_semi").select("anchor", "content", F.col("bit").alias("mask"))
    found = _stored(
        whole.unionByName(masks).unionByName(dealt)
        .groupBy("anchor", "content").agg(F.bit_or("mask").alias("mask")).filter("mask <> 0"),
        "substring-found",
    )
    return (
        stretches.join(found, ["anchor", "content"])
        .select(
            "k1", "k2",
            F.shiftright("place", _COUNT_BITS).alias("start"),
            "mask",
        )
        .groupBy("k1", "k2")
        # Equal rows have the same runs: a set holds them once.
        .agg(F.collect_set(F.struct("start", "mask")).alias("runs"))
    )


def _cut(batches: Iterator[pa.RecordBatch], length: int, with_text: bool) -> Iterator[pa.RecordBatch]:
    """id or carried columns, text, runs -> the first, n_words, n_removed, and the kept text or its digest.

    A text that loses nothing is kept as it is.
    """
    for batch in batches:
        runs = batch.column(2)
        size = np.nan_to_num(runs.value_lengths().to_numpy(zero_copy_only=False).astype(np.float64)).astype(np.int64)
        rows, at = runs.flatten(), np.concatenate([[0], np.cumsum(size)])
        start, mask = rows.field("start").to_numpy(), rows.field("mask").to_numpy()
        for begin, last, data, offsets in text_slices(batch.column(1)):
            from_, to, first = split_words(data, offsets)
            own = slice(int(at[begin]), int(at[last]))
            keep = _kept_words(len(from_), start[own] + np.repeat(first[:-1], size[begin:last]), mask[own], length)
            n_words = np.diff(first)
            kept_before = np.concatenate([[0], np.cumsum(keep)])[first]
            n_removed = n_words - np.diff(kept_before)
            joined = _joined(data, from_[keep], to[keep], kept_before)
            if with_text:
                out = pc.if_else(
                    pa.array(n_removed > 0),
                    pa.array([x.decode() for x in joined], pa.string()),
                    batch.column(1).slice(begin, last - begin),
                )
            else:
                out = pa.array([sha256(x).hexdigest() for x in joined], pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(begin, last - begin), pa.array(n_words), pa.array(n_removed), out],
                names=["id", "n_words", "n_removed", "kept"],
            )


def _kept_words(n: int, base: np.ndarray, mask: np.ndarray, length: int) -> np.ndarray:
    gone = np.zeros(n + 1, np.int64)
    for bit in range(1 << _COUNT_BITS):
        left = mask >> bit
        if not left.any():
            break
        hit = base[left & 1 == 1] + bit
        np.add.at(gone, hit, 1)
        np.add.at(gone, hit + length, -1)
    return np.cumsum(gone)[:-1] == 0


def _joined(data: np.ndarray, from_: np.ndarray, to: np.ndarray, edges: np.ndarray) -> list[bytes]:
    """Kept words of each text with one space between them."""
    size = to - from_ + 1
    text = np.full(int(size.sum()), 0x20, np.uint8)
    put = np.cumsum(size) - size
    text[gather_ranges(put, size - 1)] = data[gather_ranges(from_, size - 1)]
    cut = np.concatenate([[0], np.cumsum(size)])[edges].tolist()
    raw = text.tobytes()
    return [raw[a : max(a, b - 1)] for a, b in zip(cut[:-1], cut[1:])]


def _with_runs(docs: DataFrame, length: int, id_col: str, text_col: str, wide: int, *carried: Column) -> DataFrame:
    """``id, text, runs`` and what is carried, per row."""
    if not GRAM < length < GRAM + (1 << _COUNT_BITS) - 2:
        raise ValueError(f"windows of {GRAM + 1} to {GRAM + (1 << _COUNT_BITS) - 3} words can be searched")
    runs = _stored(repeated_windows(_keyed(docs, id_col, text_col), length, wide), "substring-runs")
    return _keyed(docs, id_col, text_col, *carried).join(runs.hint("shuffle_hash"), ["k1", "k2"], "left")


def without_repeats(
    docs: DataFrame, length: int = 35, *, id_col: str = "doc_id", text_col: str = "text", wide: int = WIDE
) -> DataFrame:
    """``<id_col>, n_words, n_removed, kept_sha256`` (kept words joined by one space) per row.

    Every word inside a window of ``length`` words that starts in a second
    place goes, in all its places; windows are judged on the input.  Null and
    short texts lose nothing (null has no words).  Repeated rows are further
    places of their windows.  Ids are integers; a null id stays null.  Tables
    without rows give none; other columns are not looked at.
    """
    ids = F.col(f"`{id_col}`").cast("bigint").alias("id")
    rows = _with_runs(docs, length, id_col, text_col, wide, ids).select("id", "text", "runs")
    cut = rows.mapInArrow(
        lambda b: _cut(b, length, False), "id bigint, n_words bigint, n_removed bigint, kept string"
    )
    return cut.select(F.col("id").alias(id_col), "n_words", "n_removed", F.col("kept").alias("kept_sha256"))


def cut_documents(
    docs: DataFrame, length: int = 35, *, id_col: str = "doc_id", text_col: str = "text", wide: int = WIDE
) -> DataFrame:
    """All rows and columns of ``docs``; texts with repeats become their kept words joined by one space.

    Columns may have any names and stay in order.  Nulls, short and repeated
    texts and empty tables as in ``without_repeats``; a text that loses nothing
    stays byte for byte.
    """
    others = [c for c in docs.columns if c != text_col]
    quoted = [F.col("`" + c.replace("`", "``") + "`").alias(f"c{i}") for i, c in enumerate(others)]
    rows = _with_runs(docs, length, id_col, text_col, wide, F.struct(F.lit(0).alias("none"), *quoted).alias("doc")).select(
        "doc", "text", "runs"
    )
    schema = T.StructType(
        [
            T.StructField("id", rows.schema["doc"].dataType),
            T.StructField("n_words", T.LongType()),
            T.StructField("n_removed", T.LongType()),
            T.StructField("kept", T.StringType()),
        ]
    )
    cut = rows.mapInArrow(lambda b: _cut(b, length, True), schema)
    place = {c: i for i, c in enumerate(others)}
    return cut.select(*[(F.col("kept") if c == text_col else F.col(f"id.c{place[c]}")).alias(c) for c in docs.columns])
