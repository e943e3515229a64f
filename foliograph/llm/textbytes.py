"""Words and their hashes straight from UTF-8 bytes.

Arrow hands a task the bytes of many texts in one buffer.  Splitting and
hashing work on slices of that buffer with numpy; no text becomes a Python
string.  Memory is bounded by ``SLICE`` bytes of text (or one text, if that is
longer) and blocks of ``BLOCK`` bytes while hashing.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa

SLICE = 1 << 22
BLOCK = 1 << 19

# A word is a run of bytes other than these: space and \t \n \v \f \r.
_IN_WORD = np.ones(256, np.bool_)
_IN_WORD[[0x20, *range(0x09, 0x0E)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASE = 0x9E3779B97F4A7C15 | 1


def mix(x: np.ndarray) -> np.ndarray:
    """A well-mixed bijection of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x = x * _M1
    x = x ^ (x >> np.uint64(27))
    x = x * _M2
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base))
    out[0] = 1
    return np.multiply.accumulate(out)


_POW = _powers(_BASE, BLOCK + 1)
_INV = _powers(pow(_BASE, -1, 1 << 64), BLOCK + 1)


def text_slices(column: pa.Array, limit: int = SLICE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``first, last, data, offsets``: rows ``first..last`` with their bytes; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if n == 0:
        return
    wide = pa.types.is_large_string(column.type)
    _, where, raw = column.buffers()
    offsets = np.frombuffer(where, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.empty(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), n)
        a, b = offsets[first], offsets[last]
        yield first, last, data[a:b], offsets[first : last + 1] - a
        first = last


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


# Terms are runs of digits, letters and bytes outside ASCII; a-z only, so texts are lower-cased first.
TERM_BYTES = np.zeros(256, np.bool_)
TERM_BYTES[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def split_words(
    data: np.ndarray, offsets: np.ndarray, word_bytes: np.ndarray = _IN_WORD
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``starts, ends`` of all words, and per text the number of its first word.

    The last entry of the third array is the number of words.  A word is a run
    of bytes for which ``word_bytes`` holds.
    """
    if not len(data):
        none = np.empty(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    inside = word_bytes[data]
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    stops[:-1] &= ~inside[1:]
    edge = offsets[offsets < len(data)]
    begins[edge] = inside[edge]
    edge = edge[edge > 0] - 1
    stops[edge] = inside[edge]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span; spans ascend and do not overlap."""
    out = np.empty(len(starts), np.uint64)
    at, n = 0, len(starts)
    while at < n:
        base = starts[at]
        stop = int(np.searchsorted(ends, base + BLOCK, "right"))
        if stop <= at:  # one very long span
            digest = blake2b(data[base : ends[at]].tobytes(), digest_size=8).digest()
            out[at] = np.frombuffer(digest, np.uint64)[0]
            at += 1
            continue
        piece = data[base : ends[stop - 1]]
        total = np.empty(len(piece) + 1, np.uint64)
        total[0] = 0
        np.cumsum(_BYTE[piece] * _POW[: len(piece)], out=total[1:])
        a, b = starts[at:stop] - base, ends[at:stop] - base
        out[at:stop] = mix((total[b] - total[a]) * _INV[a] + (b - a).astype(np.uint64))
        at = stop
    return out


def gather_ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices ``starts[i] .. starts[i] + lengths[i] - 1`` of all ranges, one after the other."""
    total = int(lengths.sum())
    if not total:
        return np.empty(0, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(total)
