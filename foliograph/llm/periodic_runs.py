"""Periodic runs of words, found by internal pattern matching.

A run is a maximal stretch of words with smallest period ``q`` that holds at
least ``shortest`` words and two periods.  With ``b`` the largest power of two
for which ``2 b - 1`` words fit into the run's length less ``q``, the run holds
a dyadic block of ``b`` words that occurs again ``q <= 4 b - 2`` words later.

* Each dyadic block asks for its occurrences in the four windows of ``b``
  places after it: its suffix array interval comes from the names of equal
  blocks, and a wavelet matrix over the suffix array gives the first, second and
  last place in each window (range successor).
* Occurrences of a block within ``b`` places form one arithmetic progression.
  If it has three members or more and block and progression lie in one run of
  the progression's difference, that difference is the only candidate period;
  otherwise every member is one.
* Candidates are extended to both sides by comparing names of dyadic blocks, and
  equal stretches keep their smallest period.

Only stretches whose four-word sequences occur twice in their text are indexed,
which holds for every run.  Memory grows with a slice of texts (``SLICE``
bytes, or one longer text), not with the table; nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from foliograph.llm.shingles import windows
from foliograph.llm.textbytes import gather_ranges, hash_spans, mix, split_words, text_slices
from foliograph.llm.wavelet import WaveletMatrix

SHORTEST = 12
# The smallest blocks are four words long and start at every third word, so
# that a run of 12 words of period 6 holds one in its first half.
_GRAM, _STRIDE = 4, 3
# Blocks or candidates handled at a time.
CHUNK = 1 << 17


class _Stretches:
    """Names of all stretches of 1, 2, 4, ... symbols, and the suffix array in a wavelet matrix."""

    def __init__(self, symbols: np.ndarray):
        self.n = n = len(symbols)
        self.names = [symbols]
        # The last symbol of every stretch is unlike all others, so names become unique.
        while int(self.names[-1].max()) + 1 < n:
            reach, last = 1 << (len(self.names) - 1), self.names[-1]
            ahead = np.zeros(n, np.int64)
            ahead[: n - reach] = last[reach:] + 1
            self.names.append(np.unique(last * (n + 1) + ahead, return_inverse=True)[1])
        self.levels = len(self.names) - 1
        self.suffixes = WaveletMatrix(np.argsort(self.names[-1]), n)

    def after(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Equal symbols from places ``i`` and ``j > i`` on."""
        total = np.zeros(len(i), np.int64)
        for level in range(self.levels - 1, -1, -1):
            name = self.names[level]
            total += (name[i + total] == name[j + total]).astype(np.int64) << level
        return total

    def before(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Equal symbols before places ``i`` and ``j > i``."""
        total = np.zeros(len(i), np.int64)
        for level in range(self.levels - 1, -1, -1):
            name, at = self.names[level], i - total - (1 << level)
            same = (at >= 0) & (name[at] == name[j - total - (1 << level)])
            total += same.astype(np.int64) << level
        return total

    def candidates(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places and distances at which a block occurs again and a run may have that period."""
        for level in range(_GRAM.bit_length() - 1, self.levels):
            size, name = 1 << level, self.names[level]
            count = np.bincount(name)
            less = np.cumsum(count) - count
            places = np.arange(0, self.n - size + 1, _STRIDE if size == _GRAM else size)
            places = places[count[name[places]] > 1]
            for at in range(0, len(places), CHUNK):
                p = places[at : at + CHUNK]
                low = less[name[p]]
                yield from self._occurrences(p, low, low + count[name[p]], size)

    def _occurrences(self, p: np.ndarray, low: np.ndarray, high: np.ndarray, size: int):
        find = self.suffixes
        start = find.count_less(low, high, np.minimum(p + 1, self.n))
        for window in range(4):
            stop = find.count_less(low, high, np.minimum(p + 1 + (window + 1) * size, self.n))
            some = np.flatnonzero(stop > start)
            here, a, b, k, n = p[some], low[some], high[some], start[some], (stop - start)[some]
            first = find.quantile(a, b, k)
            yield here, first - here
            more = np.flatnonzero(n > 1)
            second = find.quantile(a[more], b[more], k[more] + 1)
            yield here[more][n[more] == 2], (second - here[more])[n[more] == 2]
            many = n[more] > 2
            here, first, n = here[more][many], first[more][many], n[more][many]
            step = second[many] - first
            inside = self.after(here, here + step) >= first + size - here - step
            yield here[inside], step[inside]
            here, first, n, step = here[~inside], first[~inside], n[~inside], step[~inside]
            edge = np.concatenate([[0], np.cumsum(n)])
            at = 0
            while at < len(n):  # whole progressions, a chunk at a time
                to = max(at + 1, int(np.searchsorted(edge, edge[at] + CHUNK, "right")) - 1)
                number = gather_ranges(np.zeros(to - at, np.int64), n[at:to])
                again = lambda x: np.repeat(x[at:to], n[at:to])  # noqa: B023, E731
                yield again(here), again(first) + number * again(step) - again(here)
                at = to
            start = stop

    def runs(self, shortest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``start, end, period`` of all runs, in order of start, then end."""
        found = np.empty((3, 0), np.int64)
        held = []
        for p, q in self.candidates():
            start = p - self.before(p, p + q)
            end = p + q + self.after(p, p + q)
            good = end - start >= np.maximum(shortest, 2 * q)
            if good.any():
                held.append(np.stack([start[good], end[good], q[good]]))
            if sum(h.shape[1] for h in held) > CHUNK + found.shape[1]:
                found, held = _least_periods([found, *held]), []
        return tuple(_least_periods([found, *held]))


def _least_periods(parts: list[np.ndarray]) -> np.ndarray:
    start, end, period = np.concatenate(parts, axis=1)
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    new = np.ones(len(start), np.bool_)
    new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    return np.stack([start[new], end[new], period[new]])


def text_runs(words: np.ndarray, first: np.ndarray, shortest: int = SHORTEST) -> tuple[np.ndarray, ...]:
    """``text, start, end, period`` of all runs, by text, start and period; places are counted over all texts."""
    none = np.empty(0, np.int64)
    if shortest < SHORTEST:
        raise ValueError(f"runs shorter than {SHORTEST} words are not searched")
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    if len(words) < shortest:
        return none, none, none, none
    own = words + mix(text.astype(np.uint64))  # equal words of two texts are two symbols
    rolled = windows(own, _GRAM)
    inside = text[_GRAM - 1 :] == text[: len(rolled)]
    place = np.flatnonzero(inside)
    order = np.argsort(rolled[place], kind="stable")
    value = rolled[place[order]]
    twice = np.zeros(len(value), np.bool_)
    twice[1:] = value[1:] == value[:-1]
    twice[:-1] |= twice[1:]
    cover = np.zeros(len(words) + 1, np.int64)
    starts = place[order[twice]]
    cover[starts] += 1
    cover[starts + _GRAM] -= 1
    covered = np.cumsum(cover)[:-1] > 0
    begins, stops = covered.copy(), covered.copy()
    begins[1:] &= ~covered[:-1] | (text[1:] != text[:-1])
    stops[:-1] &= ~covered[1:] | (text[1:] != text[:-1])
    begin, end = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    long = end - begin >= shortest
    begin, end = begin[long], end[long]
    if not len(begin):
        return none, none, none, none
    size = end - begin
    put = np.cumsum(size + 1) - size - 1
    symbol = np.empty(int((size + 1).sum()), np.int64)
    known, number = np.unique(own[gather_ranges(begin, size)], return_inverse=True)
    symbol[gather_ranges(put, size)] = number
    symbol[put + size] = len(known) + np.arange(len(put))
    start, stop, period = _Stretches(symbol).runs(shortest)
    stretch = np.searchsorted(put, start, "right") - 1
    shift = begin[stretch] - put[stretch]
    start, stop = start + shift, stop + shift
    order = np.lexsort((period, start))
    start, stop, period = start[order], stop[order], period[order]
    return text[start], start, stop, period


_FIELDS = [
    ("n_runs", T.LongType()),
    ("start", T.LongType()),
    ("length", T.LongType()),
    ("period", T.LongType()),
    ("exponent_milli", T.LongType()),
    ("runs_sha256", T.StringType()),
    ("collapsed_sha256", T.StringType()),
]


def _sliced(column: pa.Array, shortest: int):
    for begin, last, data, offsets in text_slices(column):
        starts, ends, first = split_words(data, offsets)
        text, start, stop, period = text_runs(hash_spans(data, starts, ends), first, shortest)
        yield begin, data, starts, ends, first, text, start - first[text], stop - first[text], period


def _kept_words(n: int, first: np.ndarray, text: np.ndarray, start: np.ndarray, stop: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Words in no run beyond its first period."""
    gone = np.zeros(n + 1, np.int64)
    np.add.at(gone, first[text] + start + period, 1)
    np.add.at(gone, first[text] + stop, -1)
    return np.flatnonzero(np.cumsum(gone)[:-1] == 0)


def _joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, kept: np.ndarray, first: np.ndarray) -> Iterator[bytes]:
    """Kept words of each text with one space between them."""
    size = ends[kept] - starts[kept]
    put = np.cumsum(size + 1) - size - 1
    out = np.full(int((size + 1).sum()), 0x20, np.uint8)
    out[gather_ranges(put, size)] = data[gather_ranges(starts[kept], size)]
    edge = np.concatenate([put, [len(out)]])[np.searchsorted(kept, first)].tolist()
    raw = out.tobytes()
    return (raw[a : max(a, b - 1)] for a, b in zip(edge[:-1], edge[1:]))


def run_digests(
    docs: DataFrame, shortest: int = SHORTEST, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: id, ``n_runs``, the run of greatest length and digests of all runs and of the collapsed text.

    ``start`` (a word's number from 0), ``length``, ``period`` and
    ``exponent_milli`` are those of the longest run (ties: smallest start, then
    period) and null without runs.  ``runs_sha256`` is over the lines
    ``start,length,period``, ``collapsed_sha256`` over the words in no run
    beyond its first period, joined by one space.  Null and empty texts have no
    words and no runs; repeated rows give repeated rows, ids stay as they are,
    null included; a table without rows gives none; other columns are not
    looked at.
    """
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), *[T.StructField(n, t) for n, t in _FIELDS]])
    nothing = sha256(b"").hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, data, starts, ends, first, text, start, stop, period in _sliced(batch.column(1), shortest):
                n = len(first) - 1
                edge = np.searchsorted(text, np.arange(n + 1)).tolist()
                best: list[tuple] = [(None, None, None, None)] * n
                lines = [nothing] * n
                for i in np.unique(text).tolist():
                    s, length, q = (x[edge[i] : edge[i + 1]].tolist() for x in (start, stop - start, period))
                    top = min(range(len(s)), key=lambda j: (-length[j], s[j], q[j]))
                    best[i] = (s[top], length[top], q[top], 1000 * length[top] // q[top])
                    lines[i] = sha256("".join(f"{a},{b},{c}\n" for a, b, c in zip(s, length, q)).encode()).hexdigest()
                kept = _kept_words(len(starts), first, text, start, stop, period)
                collapsed = [sha256(t).hexdigest() for t in _joined(data, starts, ends, kept, first)]
                columns = [
                    batch.column(0).slice(begin, n),
                    pa.array(np.diff(np.array(edge, np.int64))),
                    *[pa.array([b[j] for b in best], pa.int64()) for j in range(4)],
                    pa.array(lines, pa.string()),
                    pa.array(collapsed, pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`").cast("string")).mapInArrow(run, schema)


def runs(docs: DataFrame, shortest: int = SHORTEST, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per run: id, ``start``, ``length``, ``period``, ``passage`` (its first period, words joined by a space).

    Inputs as in ``run_digests``; texts without runs give no rows.
    """
    fields = [("start", T.LongType()), ("length", T.LongType()), ("period", T.LongType()), ("passage", T.StringType())]
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), *[T.StructField(n, t) for n, t in fields]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, data, starts, ends, first, text, start, stop, period in _sliced(batch.column(1), shortest):
                head = first[text] + start
                passages = [
                    b" ".join(data[starts[w] : ends[w]].tobytes() for w in range(a, a + q)).decode()
                    for a, q in zip(head.tolist(), period.tolist())
                ]
                columns = [
                    batch.column(0).take(pa.array(text + begin)),
                    *[pa.array(x) for x in (start, stop - start, period)],
                    pa.array(passages, pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`").cast("string")).mapInArrow(run, schema)


def collapsed(docs: DataFrame, shortest: int = SHORTEST, *, text_col: str = "text") -> DataFrame:
    """``docs`` with the texts that have runs replaced by their kept words, joined by one space.

    Rows, columns and their order are those of ``docs``; texts without runs,
    nulls included, stay byte for byte.
    """
    others = [c for c in docs.columns if c != text_col]
    carried = F.struct(F.lit(0).alias("none"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others)]).alias("row")
    rows = docs.select(carried, F.col(f"`{text_col}`").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            for begin, data, starts, ends, first, text, start, stop, period in _sliced(texts, shortest):
                kept = _kept_words(len(starts), first, text, start, stop, period)
                out = texts.slice(begin, len(first) - 1).to_pylist()
                changed = set(text.tolist())
                for i, words in enumerate(_joined(data, starts, ends, kept, first)):
                    if i in changed:
                        out[i] = words.decode()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(begin, len(out)), pa.array(out, pa.string())], names=["row", "text"]
                )

    made = rows.mapInArrow(run, rows.schema)
    place = {c: i for i, c in enumerate(others)}
    return made.select(*[F.col("text").alias(c) if c == text_col else F.col(f"row.c{place[c]}").alias(c) for c in docs.columns])
