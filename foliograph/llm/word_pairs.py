"""Features of a word and the word before it, inside a class, as a table spread over shards.

P(word | class, last) = base(word) * exp(weight(last, word)) / Z(last, class)

where base is the word's share of its class, a pair that was never seen has
weight 0, and Z sums over the class.  Weights maximise the likelihood less
``PENALTY`` times their sum (they are not negative): updates add the logarithm
of seen over expected counts, so what is held of a pair stays below its share.

The contexts of a shard are disjoint from those of all others, so its weights
are found in one task from the counts of all training texts, and texts are
scored where the weights are: tasks send each shard the pairs of their slices
in packed blocks, counts first.  The number of shards follows the corpus.  A
frequent last word would fill its shard; those are left to the model that all
tasks have.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from foliograph.llm.textbytes import mix

PLACE_BITS = 19
PENALTY = 0.6
UPDATES = 8
_PENDING = 1 << 20
_COUNTS, _TEXTS, _DIRECTORY = 0, 1, 2

BLOCKS = "shard int, kind int, slice bigint, keys binary, extra binary"
SUMS = "slice bigint, kind int, at binary, value binary"


@dataclass
class Classes:
    """Frequent words by place; the words of a class have neighbouring places."""

    base: np.ndarray  # share of the word in its class, by place
    first: np.ndarray  # first place of the word's class, by place


@dataclass
class Pairs:
    """Weights of pairs in key order, and log Z per context and class in key order."""

    keys: np.ndarray
    weight: np.ndarray
    groups: np.ndarray
    log_z: np.ndarray

    def log_ratio(self, keys: np.ndarray, classes: Classes) -> np.ndarray:
        """log P(word | class, last) - log base(word) of each pair."""
        out = np.zeros(len(keys))
        if len(self.keys):
            at, hit = _found(self.keys, keys)
            out[hit] = self.weight[at[hit]]
            at, hit = _found(self.groups, _group(keys, classes))
            out[hit] -= self.log_z[at[hit]]
        return out


def _found(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return at, table[at] == keys


def _place(keys: np.ndarray) -> np.ndarray:
    return (keys & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)


def _group(keys: np.ndarray, classes: Classes) -> np.ndarray:
    return (keys >> np.uint64(PLACE_BITS) << np.uint64(PLACE_BITS)) | classes.first[_place(keys)].astype(np.uint64)


def pair_keys(last: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Hash of the last word, then the place of the word."""
    context = mix(last * np.uint64(3) + np.uint64(0x77)) >> np.uint64(PLACE_BITS)
    return (context << np.uint64(PLACE_BITS)) | place.astype(np.uint64)


def fitted(keys: np.ndarray, seen: np.ndarray, classes: Classes) -> Pairs:
    """Weights for the distinct pairs ``keys``, ascending, seen so often in training."""
    if not len(keys):
        return Pairs(keys, np.empty(0, np.float32), keys, np.empty(0))
    group = _group(keys, classes)
    head = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    size = np.diff(np.append(head, len(keys)))
    base = classes.base[_place(keys)]
    total = np.repeat(np.add.reduceat(seen.astype(np.float64), head), size)
    goal = np.log((seen - PENALTY) / total / base)
    weight, z = np.zeros(len(keys)), np.ones(len(head))
    for _ in range(UPDATES):
        # seen over expected: the old weight cancels out
        weight = np.maximum(goal + np.repeat(np.log(z), size), 0)
        z = 1 + np.add.reduceat(base * np.expm1(weight), head)
    return Pairs(keys, weight.astype(np.float32), group[head], np.log1p(np.add.reduceat(base * np.expm1(weight.astype(np.float32)), head)))


# Blocks: numbers as planes of their bytes, which compress well in a shuffle.


def _planes(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T).tobytes()


def _values(raw: np.ndarray, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(width, -1).T).reshape(-1).view(kind)


def packed(keys: np.ndarray) -> bytes:
    """Ascending keys as runs of one context and the places of each run."""
    context = keys >> np.uint64(PLACE_BITS)
    head = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]]))
    runs = np.diff(np.append(head, len(keys))).astype(np.uint32)
    return np.uint64(len(head)).tobytes() + _planes(context[head]) + _planes(runs) + _planes(_place(keys).astype(np.uint32))


def unpacked(raw: bytes) -> np.ndarray:
    data = np.frombuffer(raw, np.uint8)
    n = int(data[:8].view(np.uint64)[0])
    context = _values(data[8 : 8 + 8 * n], np.uint64)
    runs = _values(data[8 + 8 * n : 8 + 12 * n], np.uint32)
    return (np.repeat(context, runs) << np.uint64(PLACE_BITS)) | _values(data[8 + 12 * n :], np.uint32).astype(np.uint64)


def blocks(
    number: int, keys: np.ndarray, text: np.ndarray, train: np.ndarray, names: np.ndarray, shards: int
) -> Iterator[pa.RecordBatch]:
    """All blocks of one slice: pairs with the text each stands in, and which pairs are for training.

    ``names`` identifies the slice's texts; it goes past the shards as a directory.
    """
    order = np.argsort(keys, kind="stable")
    keys, text, train = keys[order], text[order].astype(np.uint32), train[order]
    learnt, seen = np.unique(keys[train], return_counts=True)
    out: list[tuple[int, int, bytes, bytes]] = [(number % shards, _DIRECTORY, b"", names.tobytes())]
    for kind, own, extra in ((_COUNTS, learnt, seen.astype(np.uint32)), (_TEXTS, keys, text)):
        if len(own):
            shard = ((own >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)
            cut = np.flatnonzero(np.diff(shard, prepend=shard[0] + np.uint64(1)))
            for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(own)]):
                out.append((int(shard[a]), kind, packed(own[a:b]), _planes(extra[a:b])))
    shard, kind, keyed, extra = zip(*out)
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(shard, pa.int32()),
            pa.array(kind, pa.int32()),
            pa.array([number] * len(out), pa.int64()),
            pa.array(keyed, pa.binary()),
            pa.array(extra, pa.binary()),
        ],
        names=["shard", "kind", "slice", "keys", "extra"],
    )


class _Counts:
    """Distinct pairs of a shard with their counts; what comes in is added up now and then."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = self.settled = 0

    def add(self, keys: np.ndarray, seen: np.ndarray) -> None:
        self.parts.append((keys, seen))
        self.size += len(keys)
        if self.size > 2 * self.settled + _PENDING:
            self.parts = [self.whole()]
            self.size = self.settled = len(self.parts[0][0])

    def whole(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.parts:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        keys = np.concatenate([k for k, _ in self.parts])
        seen = np.concatenate([s for _, s in self.parts]).astype(np.int64)
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        head = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        return keys[head], np.add.reduceat(seen[order], head)


def shard_sums(batches: Iterator[pa.RecordBatch], classes: Classes) -> Iterator[pa.RecordBatch]:
    """Per block of texts the sum of the log ratios of each text; blocks come by shard, counts first."""
    shard, counts, pairs = None, _Counts(), None
    for batch in batches:
        out: list[tuple[int, int, bytes, bytes]] = []
        for own, kind, number, keys, extra in zip(*(c.to_pylist() for c in batch.columns)):
            if own != shard:
                shard, counts, pairs = own, _Counts(), None
            if kind == _DIRECTORY:
                out.append((number, kind, b"", extra))
                continue
            keyed, more = unpacked(keys), _values(np.frombuffer(extra, np.uint8), np.uint32)
            if kind == _COUNTS:
                counts.add(keyed, more)
                continue
            if pairs is None:
                pairs, counts = fitted(*counts.whole(), classes), _Counts()
            text, inverse = np.unique(more, return_inverse=True)
            total = np.bincount(inverse, pairs.log_ratio(keyed, classes), minlength=len(text))
            out.append((number, kind, _planes(text), total.astype(np.float32).tobytes()))
        if out:
            number, kind, at, value = zip(*out)
            yield pa.RecordBatch.from_arrays(
                [pa.array(number, pa.int64()), pa.array(kind, pa.int32()), pa.array(at, pa.binary()), pa.array(value, pa.binary())],
                names=["slice", "kind", "at", "value"],
            )


def per_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``key_a, key_b, inside``: the texts of each slice with their sums; the directory comes first."""
    number, names, total = None, np.empty((0, 2), np.int64), np.empty(0)

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(names[:, 0]), pa.array(names[:, 1]), pa.array(total)], names=["key_a", "key_b", "inside"]
        )

    for batch in batches:
        for own, kind, at, value in zip(*(c.to_pylist() for c in batch.columns)):
            if own != number:
                if len(names):
                    yield done()
                number, names = own, np.empty((0, 2), np.int64)
            if kind == _DIRECTORY:
                names = np.frombuffer(value, np.int64).reshape(-1, 2)
                total = np.zeros(len(names))
            else:
                total[_values(np.frombuffer(at, np.uint8), np.uint32)] += np.frombuffer(value, np.float32)
    if len(names):
        yield done()
