"""Byte-pair encoding of many short pieces at once.

Pieces of similar length form one padded matrix.  In every round each row
merges its leftmost pair of minimum rank; pairs are looked up in a hash table,
rows shrink by compaction and finished rows leave the matrix.  A piece longer
than ``LONG`` symbols would make rounds long for its whole matrix and takes a
heap of (rank, place) instead, with the same result.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

import numpy as np

from foliograph.llm.textbytes import mix

LONG = 128
ROWS = 16_384
_NONE = np.int32(2**31 - 1)


class PairTable:
    """(left, right) -> (rank, merged id), open addressing in numpy arrays."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray, merged: np.ndarray):
        bits = max(4, int(len(left) * 4).bit_length())
        self.shift = np.uint64(64 - bits)
        self.mask = (1 << bits) - 1
        keys = (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)
        self.keys = np.full(1 << bits, np.uint64(2**64 - 1))
        self.rank = np.full(1 << bits, _NONE, np.int32)
        self.merged = np.zeros(1 << bits, np.int32)
        slot = (mix(keys) >> self.shift).astype(np.int64)
        todo = np.arange(len(keys))
        while len(todo):
            free = self.keys[slot[todo]] == np.uint64(2**64 - 1)
            _, first = np.unique(slot[todo[free]], return_index=True)
            put = todo[free][first]
            at = slot[put]
            self.keys[at], self.rank[at], self.merged[at] = keys[put], rank[put], merged[put]
            todo = np.setdiff1d(todo, put, assume_unique=True)
            slot[todo] = (slot[todo] + 1) & self.mask

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The slot of each pair; an empty slot has the rank of no pair."""
        keys = (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint32)
        slot = (mix(keys) >> self.shift).astype(np.int64)
        found = self.keys[slot]
        todo = np.flatnonzero((found != keys) & (found != np.uint64(2**64 - 1)))
        while len(todo):
            slot[todo] = (slot[todo] + 1) & self.mask
            found = self.keys[slot[todo]]
            todo = todo[(found != keys[todo]) & (found != np.uint64(2**64 - 1))]
        return slot


def encode_pieces(symbols: np.ndarray, lengths: np.ndarray, table: PairTable) -> tuple[np.ndarray, np.ndarray]:
    """Ids and their counts; ``symbols`` holds the pieces one after the other."""
    starts = np.cumsum(lengths) - lengths
    counts = np.zeros(len(lengths), np.int64)
    parts: list[tuple[np.ndarray, np.ndarray]] = []  # pieces, padded ids
    floor, width = 0, 4
    while floor < LONG:
        rows = np.flatnonzero((lengths > floor) & (lengths <= width))
        for at in range(0, len(rows), ROWS):
            _merge_rows(symbols, starts, lengths, rows[at : at + ROWS], width, table, counts, parts)
        floor, width = width, width * 2
    for piece in np.flatnonzero(lengths > LONG):
        ids = _merge_long(symbols[starts[piece] : starts[piece] + lengths[piece]], table)
        counts[piece] = len(ids)
        parts.append((np.array([piece]), ids[None, :]))
    out = np.empty(int(counts.sum()), np.int32)
    begin = np.cumsum(counts) - counts
    for pieces, padded in parts:
        used = np.arange(padded.shape[1]) < counts[pieces][:, None]
        out[(begin[pieces][:, None] + np.arange(padded.shape[1]))[used]] = padded[used]
    return out, counts


def _merge_rows(symbols, starts, lengths, rows, width, table, counts, parts) -> None:
    column = np.arange(width)
    inside = column < lengths[rows][:, None]
    grid = np.where(inside, symbols[np.minimum(starts[rows][:, None] + column, len(symbols) - 1)], -1).astype(np.int32)
    size = lengths[rows].copy()
    slots = table.find(grid[:, :-1].ravel(), grid[:, 1:].ravel()).reshape(len(rows), width - 1)
    ranks = np.where(inside[:, 1:], table.rank[slots], _NONE)
    while len(rows):
        place = ranks.argmin(axis=1)
        line = np.arange(len(rows))
        going = ranks[line, place] != _NONE
        if not going.all():
            done = ~going
            counts[rows[done]] = size[done]
            parts.append((rows[done], grid[done][:, : max(1, int(size[done].max()))]))
            rows, grid, ranks, size, place = rows[going], grid[going], ranks[going], size[going], place[going]
            line = np.arange(len(rows))
            if not len(rows):
                break
            used = int(size.max())
            grid, ranks = grid[:, :used], ranks[:, : used - 1]
        new = table.merged[table.find(grid[line, place], grid[line, place + 1])]
        # Close the gap: everything right of the pair moves one place left.
        moved = np.arange(grid.shape[1] - 1) > place[:, None]
        grid[:, :-1] = np.where(moved, grid[:, 1:], grid[:, :-1])
        grid[:, -1] = -1
        grid[line, place] = new
        keep = np.arange(ranks.shape[1] - 1) > place[:, None]
        ranks[:, :-1] = np.where(keep, ranks[:, 1:], ranks[:, :-1])
        ranks[:, -1] = _NONE
        size -= 1
        for shift in (-1, 0):  # the pairs that hold the new symbol
            at = place + shift
            ok = np.flatnonzero((at >= 0) & (at + 1 < size))
            ranks[ok, at[ok]] = table.rank[table.find(grid[ok, at[ok]], grid[ok, at[ok] + 1])]
        over = np.flatnonzero((place >= size - 1) & (place < ranks.shape[1]))
        ranks[over, place[over]] = _NONE


def _merge_long(symbols: np.ndarray, table: PairTable) -> np.ndarray:
    ids = symbols.astype(np.int64).tolist()
    n = len(ids)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    slots = table.find(symbols[:-1].astype(np.int32), symbols[1:].astype(np.int32))
    ranks = table.rank[slots]
    live = np.flatnonzero(ranks != _NONE)
    heap = [(int(ranks[i]), int(i), ids[i], ids[i + 1]) for i in live]
    heapq.heapify(heap)
    known: dict[tuple[int, int], tuple[int, int]] = {}

    def lookup(a: int, b: int) -> tuple[int, int]:
        if (a, b) not in known:
            slot = table.find(np.array([a], np.int32), np.array([b], np.int32))[0]
            known[a, b] = int(table.rank[slot]), int(table.merged[slot])
        return known[a, b]

    while heap:
        _, i, a, b = heapq.heappop(heap)
        j = after[i]
        if ids[i] != a or j >= n or ids[j] != b:
            continue  # one of the two has been merged meanwhile
        ids[i], ids[j] = lookup(a, b)[1], -1
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
        for left in (before[i], i):
            right = after[left] if left >= 0 else n
            if left >= 0 and right < n:
                rank, _ = lookup(ids[left], ids[right])
                if rank != int(_NONE):
                    heapq.heappush(heap, (rank, left, ids[left], ids[right]))
    return np.array([x for x in ids if x >= 0], np.int32)


class PieceCache:
    """Ids of the distinct byte spans a worker has met, found by their hash.

    At most ``limit`` spans are held; then it starts anew.
    """

    def __init__(self, encode, limit: int = 600_000):
        self.encode, self.limit = encode, limit
        self.clear()

    def clear(self) -> None:
        self.hashes = np.empty(0, np.uint64)
        self.begin, self.count = np.empty(0, np.int64), np.empty(0, np.int64)
        self.ids = np.empty(0, np.int32)

    def lookup(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray):
        """Row of each span in this cache; unknown spans are encoded first."""
        distinct, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        at, fresh = self._known(distinct)
        if len(fresh) and len(self.hashes) + len(fresh) > self.limit:
            self.clear()
            at, fresh = self._known(distinct)
        if len(fresh):
            where = first[fresh]
            ids, counts = self.encode(_spans(data, starts[where], ends[where]))
            begin = len(self.ids) + np.cumsum(counts) - counts
            self.ids = np.concatenate([self.ids, ids])
            put = np.searchsorted(self.hashes, distinct[fresh])
            self.hashes = np.insert(self.hashes, put, distinct[fresh])
            self.begin = np.insert(self.begin, put, begin)
            self.count = np.insert(self.count, put, counts)
            at = np.searchsorted(self.hashes, distinct)
        return at[inverse]

    def _known(self, distinct: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.hashes, distinct)
        known = np.zeros(len(distinct), np.bool_)
        inside = at < len(self.hashes)
        known[inside] = self.hashes[at[inside]] == distinct[inside]
        return at, np.flatnonzero(~known)


def _spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Sequence[bytes]:
    whole = data.tobytes()
    return [whole[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
