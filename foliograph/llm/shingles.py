"""Word shingles of texts as 64-bit hashes, and their minwise signatures."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

from foliograph.llm.textbytes import hash_spans, lower_ascii, mix, split_words, text_slices

_ODD = np.uint64(0xD6E8FEB86659FD93)


def _weights(n: int, seed: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * _ODD + np.uint64(seed)) | np.uint64(1)


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of every ``size`` consecutive entries."""
    if len(hashes) < size:
        return np.empty(0, np.uint64)
    weight = _weights(size, size)
    n = len(hashes) - size + 1
    total = hashes[:n] * weight[0]
    for i in range(1, size):
        total += hashes[i : i + n] * weight[i]
    return mix(total)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> list[np.ndarray]:
    """Per text its distinct shingles in ascending order.

    Words are lower-cased (A-Z); a text with fewer words than ``size`` has its
    whole sequence as the only shingle, one without words has none.
    """
    data = lower_ascii(data)
    starts, ends, first = split_words(data, offsets)
    hashes = hash_spans(data, starts, ends)
    rolled = windows(hashes, size)
    sets = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= size:
            sets.append(np.unique(rolled[a : b - size + 1]))
        else:
            sets.append(windows(hashes[a:b], b - a) if b > a else hashes[:0])
    return sets


@lru_cache(maxsize=4)
def _permutations(count: int) -> np.ndarray:
    return _weights(count, 0x51ED270B)


def signatures(sets: list[np.ndarray], count: int) -> np.ndarray:
    """``count`` minwise values of 16 bits per set; rows of empty sets are zero."""
    sizes = np.array([len(s) for s in sets], np.int64)
    out = np.zeros((len(sets), count), np.uint16)
    full = np.flatnonzero(sizes)
    if not len(full):
        return out
    joined = np.concatenate([sets[i] for i in full])
    edge = np.cumsum(sizes[full]) - sizes[full]
    for k, factor in enumerate(_permutations(count)):
        smallest = np.minimum.reduceat(joined * factor, edge)
        out[full, k] = mix(smallest) >> np.uint64(48)
    return out


def fingerprints(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums per set that tell different sets apart."""
    a = np.array([s.sum(dtype=np.uint64) for s in sets], np.uint64)
    b = np.array([mix(s ^ _ODD).sum(dtype=np.uint64) for s in sets], np.uint64)
    return a.view(np.int64), b.view(np.int64)


def signature_batches(batches: Iterator[pa.RecordBatch], size: int, count: int, packed: Callable) -> Iterator[pa.RecordBatch]:
    """id, text -> id, n_shingles, two fingerprints, signature."""
    for batch in batches:
        for first, last, data, offsets in text_slices(batch.column(1)):
            sets = shingle_sets(data, offsets, size)
            sig = signatures(sets, count)
            a, b = fingerprints(sets)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(first, last - first),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(a),
                    pa.array(b),
                    pa.array(packed(sig), pa.binary()),
                ],
                names=["id", "n_shingles", "fp_a", "fp_b", "sig"],
            )


def set_batches(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """id, text -> id, shingles."""
    for batch in batches:
        for first, last, data, offsets in text_slices(batch.column(1)):
            sets = shingle_sets(data, offsets, size)
            edges = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
            values = pa.array(np.concatenate([s.view(np.int64) for s in sets]) if sets else np.empty(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(first, last - first), pa.ListArray.from_arrays(pa.array(edges), values)],
                names=["id", "shingles"],
            )
