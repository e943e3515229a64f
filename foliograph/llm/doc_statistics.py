"""Statistics of whole texts as numbers of similar scale, in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from foliograph.llm.shingles import windows
from foliograph.llm.textbytes import hash_spans, split_words, text_slices

NAMES = (
    "log_words", "word_length", "word_length_spread", "upper", "digits", "stops", "symbols", "shouts",
    "other_marks", "wide_chars", "distinct_words", "distinct_pairs", "top_word", "log_line_words",
    "repeated_lines", "stopped_lines", "short_words", "long_words",
)


def _class(chars: str) -> np.ndarray:
    table = np.zeros(256, np.uint8)
    table[[ord(c) for c in chars]] = 1
    return table


_UPPER, _DIGIT = _class("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _class("0123456789")
_STOP, _SYMBOL, _SHOUT = _class(".,"), _class("#*$%&|<>"), _class("!?")
_MARK = _class("\"'()+-/:;=@[\\]^_`{}~")
_WIDE = np.zeros(256, np.uint8)
_WIDE[0xC0:] = 1  # first bytes of characters beyond ASCII
_FIRST = np.ones(256, np.uint8)
_FIRST[0x80:0xC0] = 0


def _sums(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return (total[edges[1:]] - total[edges[:-1]]).astype(np.float64)


def _runs(hashes: np.ndarray, text: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per text the number of distinct hashes and the count of its most frequent one."""
    key = np.sort((text.astype(np.uint64) << np.uint64(40)) | (hashes >> np.uint64(24)))
    distinct, most = np.zeros(n), np.zeros(n)
    if len(key):
        head = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        count = np.diff(np.concatenate([head, [len(key)]]))
        owner = (key[head] >> np.uint64(40)).astype(np.int64)
        distinct = np.bincount(owner, minlength=n).astype(np.float64)
        np.maximum.at(most, owner, count)
    return distinct, most


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of ``NAMES`` per text; an empty text has zeros where nothing can be measured."""
    n = len(offsets) - 1
    starts, ends, first = split_words(data, offsets)
    n_words = np.diff(first).astype(np.float64)
    some = np.maximum(n_words, 1)
    length = (ends - starts).astype(np.float64)
    mean = _weighted(length, first) / some
    spread = np.sqrt(np.maximum(_weighted(length**2, first) / some - mean**2, 0))
    chars = np.maximum(_sums(_FIRST[data], offsets), 1)

    def share(table: np.ndarray) -> np.ndarray:
        return np.sqrt(_sums(table[data], offsets) / chars)

    text = np.repeat(np.arange(n), np.diff(first))
    hashes = hash_spans(data, starts, ends)
    distinct, most = _runs(hashes, text, n)
    pair, owner = windows(hashes, 2), text[:-1]
    inside = text[1:] == owner if len(text) else np.empty(0, np.bool_)
    pairs, _ = _runs(pair[inside], owner[inside], n)
    n_lines, repeated, stopped = _lines(data, offsets)
    lines = np.maximum(n_lines, 1)
    short = _weighted((length <= 2).astype(np.float64), first) / some
    long = np.sqrt(_weighted((length > 20).astype(np.float64), first) / some)
    return np.column_stack(
        [
            np.log1p(n_words), np.sqrt(mean), np.sqrt(spread), share(_UPPER), share(_DIGIT), share(_STOP),
            share(_SYMBOL), share(_SHOUT), share(_MARK), share(_WIDE), distinct / some,
            pairs / np.maximum(n_words - 1, 1), np.sqrt(most / some), np.log1p(n_words / lines),
            np.sqrt(repeated / lines), stopped / lines, short, long,
        ]
    )


def _weighted(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(values)])
    return total[edges[1:]] - total[edges[:-1]]


def _lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per text its lines that are not empty, those equal to an earlier one, those that end like a sentence."""
    n = len(offsets) - 1
    if not len(data):
        return np.zeros(n), np.zeros(n), np.zeros(n)
    breaks = np.flatnonzero(data == 0x0A)
    begin = np.unique(np.concatenate([offsets[:-1], breaks + 1]))
    begin = begin[begin < len(data)]
    stop = np.searchsorted(np.unique(np.concatenate([breaks, offsets[1:]])), begin)
    end = np.unique(np.concatenate([breaks, offsets[1:]]))[stop]
    full = end > begin
    begin, end = begin[full], end[full]
    text = np.searchsorted(offsets, begin, "right") - 1
    distinct, _ = _runs(hash_spans(data, begin, end), text, n)
    count = np.bincount(text, minlength=n).astype(np.float64)
    closing = np.isin(data[end - 1], np.frombuffer(b".!?", np.uint8))
    return count, count - distinct, np.bincount(text, closing, minlength=n)


def statistic_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """id, text -> id, statistics."""
    for batch in batches:
        for first, last, data, offsets in text_slices(batch.column(1)):
            rows = statistics(data, offsets)
            lists = pa.FixedSizeListArray.from_arrays(pa.array(rows.ravel()), rows.shape[1]).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(first, last - first), lists], names=["id", "statistics"]
            )
