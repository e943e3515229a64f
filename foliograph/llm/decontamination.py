"""Benchmark decontamination by a generalised suffix automaton of the test items.

A window is ``window`` consecutive words of an item; an item of fewer words is
one window.  Items become a suffix automaton over their words; documents are
streamed through it, and every stretch whose matching length reaches a window
is hit.

* Items are cut into pieces of ``PIECE`` words that overlap by ``window - 1``,
  so every window lies in a piece.  Pieces are dealt to blocks of about
  ``BLOCK_WORDS`` words (and ids); one block's automaton, some 50 bytes a word,
  is broadcast at a time, whatever the size of the items' table.
* A document's words go to the automaton only where all their short word
  sequences occur in items, which holds for every window; in natural text these
  are few.  Stretches are cut into lanes that overlap by a window and advance
  together.
* With one block a document's result is made in the task that reads it, and
  nothing is shuffled.  With more, each block gives the hit words and items of
  the distinct texts it hits, and these meet by two 64-bit hashes of the text.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from foliograph.llm.shingles import windows
from foliograph.llm.suffix_automaton import SuffixAutomaton
from foliograph.llm.textbytes import TERM_BYTES, gather_ranges, hash_spans, lower_ascii, split_words, text_slices
from foliograph.session import scratch_path

WINDOW = 10
BLOCK_WORDS = 500_000
PIECE = 20_000
# Words of the sequences by which stretches are chosen, and words a lane reads.
GRAM = 4
LANE = 1024


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Hashes of all words, their bytes' places, and per text its first word."""
    data = lower_ascii(data)
    starts, ends, first = split_words(data, offsets, TERM_BYTES)
    return hash_spans(data, starts, ends), starts, ends, first


def _pieces(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """item, text -> item, words (hashes as bytes)."""
    for batch in batches:
        for begin, _, data, offsets in text_slices(batch.column(1)):
            words, _, _, first = _words(data, offsets)
            row, parts = [], []
            for i, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
                for at in range(a, max(b - window + 1, a + 1) if b > a else a, PIECE):
                    row.append(begin + i)
                    parts.append(words[at : min(b, at + PIECE + window - 1)].tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int64())), pa.array(parts, pa.binary())], names=["item", "words"]
            )


class Windows:
    """One block of item windows, searched in many texts at once."""

    def __init__(self, items: list[list[str]], pieces: list[np.ndarray], window: int):
        self.window = window
        self.names = sorted({name for names in items for name in names})
        number = {name: i for i, name in enumerate(self.names)}
        self.vocabulary = np.unique(np.concatenate(pieces)) if pieces else np.empty(0, np.uint64)
        self.shortest = min([window, *map(len, pieces)])
        self.gram = min(GRAM, self.shortest)
        self.grams = np.unique(np.concatenate([windows(p, self.gram) for p in pieces] or [self.vocabulary]))
        symbols = [np.searchsorted(self.vocabulary, p) for p in pieces]
        self.automaton = SuffixAutomaton([s.tolist() for s in symbols], len(self.vocabulary))
        self.state = self.automaton.first_at_least(window)
        self._name_windows([[number[n] for n in names] for names in items], symbols)

    def _name_windows(self, items: list[list[int]], symbols: list[np.ndarray]) -> None:
        """Items per window state, and per state the short items that end its strings."""
        ends: dict[int, set[tuple[int, int]]] = {}
        sizes = np.array([len(s) for s in symbols], np.int64)
        begin = np.cumsum(sizes) - sizes
        at, state, length = self._stream(np.concatenate([*symbols, np.empty(0, np.int64)]), begin, sizes)
        piece = np.searchsorted(begin, at, "right") - 1
        held = {}
        for p, s in set(zip(piece[length >= self.window].tolist(), self.state[state[length >= self.window]].tolist())):
            held.setdefault(s, set()).update(items[p])
        for p in np.flatnonzero(sizes < self.window).tolist():
            s = int(state[np.searchsorted(at, begin[p] + sizes[p] - 1)])
            # A state is named by the string's length too: shorter strings share it.
            ends.setdefault(s, set()).update((int(sizes[p]), i) for i in [-1, *items[p]])
        self.items = {s: np.array(sorted(i), np.int64) for s, i in held.items()}
        self.short: dict[int, list[tuple[int, np.ndarray]]] = {}
        for s in np.argsort(self.automaton.size, kind="stable").tolist():
            by_size: dict[int, list[int]] = {}
            for size, item in ends.get(s, ()):
                by_size.setdefault(size, []).append(item)
            own = [(size, np.array([i for i in sorted(by) if i >= 0], np.int64)) for size, by in sorted(by_size.items())]
            above = self.short.get(int(self.automaton.link[s]), [])
            if own or above:
                self.short[s] = above + own
        self.has_short = np.zeros(len(self.automaton.size), np.bool_)
        self.has_short[list(self.short)] = True

    def _stretches(self, words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Begins and sizes of stretches, within one text each, that hold every possible window."""
        none = np.empty(0, np.int64)
        if len(words) < self.gram or not len(self.grams):
            return none, none
        rolled = windows(words, self.gram)
        at = np.minimum(np.searchsorted(self.grams, rolled), len(self.grams) - 1)
        known = np.zeros(len(words) + 1, np.bool_)
        known[: len(rolled)] = self.grams[at] == rolled
        for back in range(1, self.gram):  # sequences that would cross into the next text
            edge = first[1:] - back
            known[edge[edge >= 0]] = False
        begins, stops = known.copy(), known.copy()
        edge = np.zeros(len(known), np.bool_)
        edge[first] = True
        begins[1:] &= ~known[:-1] | edge[1:]
        stops[:-1] &= ~known[1:] | edge[1:]
        begin = np.flatnonzero(begins)
        size = np.flatnonzero(stops) + self.gram - begin
        long = size >= self.shortest
        return begin[long], size[long]

    def _stream(self, symbols: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, ...]:
        """Places, states and matching lengths of at least ``shortest`` in the stretches, in order of place."""
        lanes = -(-size // LANE)
        number = gather_ranges(np.zeros(len(size), np.int64), lanes)
        owner = np.repeat(np.arange(len(size)), lanes)
        new = begin[owner] + number * LANE
        stop = np.minimum(begin[owner] + size[owner], new + LANE)
        from_ = np.where(number > 0, np.maximum(new - self.window + 1, begin[owner]), new)
        order = np.argsort(from_ - stop, kind="stable")
        from_, new, stop = from_[order], new[order], stop[order]
        state, length = np.zeros(len(from_), np.int32), np.zeros(len(from_), np.int32)
        live, found, step = len(from_), [], 0
        while live:
            at = from_[:live] + step
            self.automaton.advance(state[:live], length[:live], symbols[at])
            keep = (length[:live] >= self.shortest) & (at >= new[:live])
            if keep.any():
                found.append((at[keep], state[:live][keep], length[:live][keep]))
            step += 1
            live = int(np.searchsorted(from_[:live] - stop[:live], -step, "left"))
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int32), np.empty(0, np.int32)
        at, state, length = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(at)
        return at[order], state[order], length[order]

    def search(self, words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, dict[int, np.ndarray]]:
        """Which words are hit, and per hit text the numbers of its items."""
        gone = np.zeros(len(words) + 1, np.int64)
        begin, size = self._stretches(words, first)
        if not len(begin):
            return gone[:-1] > 0, {}
        inside = gather_ranges(begin, size)
        symbols = np.full(len(words), -1, np.int64)
        place = np.minimum(np.searchsorted(self.vocabulary, words[inside]), len(self.vocabulary) - 1)
        symbols[inside] = np.where(self.vocabulary[place] == words[inside], place, -1)
        at, state, length = self._stream(symbols, begin, size)
        text = np.searchsorted(first, at, "right") - 1
        long = length >= self.window
        np.add.at(gone, at[long] - length[long] + 1, 1)
        np.add.at(gone, at[long] + 1, -1)
        items: dict[int, list[np.ndarray]] = {}
        pairs = np.unique(text[long] * len(self.state) + self.state[state[long]])
        for t, s in zip((pairs // len(self.state)).tolist(), (pairs % len(self.state)).tolist()):
            items.setdefault(t, []).append(self.items[s])
        for i in np.flatnonzero(self.has_short[state]).tolist():
            for size_, named in self.short[int(state[i])]:
                if size_ <= length[i]:
                    gone[at[i] - size_ + 1] += 1
                    gone[at[i] + 1] -= 1
                    items.setdefault(int(text[i]), []).append(named)
        return np.cumsum(gone)[:-1] > 0, {t: np.unique(np.concatenate(lists)) for t, lists in items.items()}


def _blocks(items: DataFrame, window: int, id_col: str, text_col: str, block_words: int) -> Iterator[Windows]:
    """The items' windows in blocks of bounded size; at least one block."""
    named = items.select(F.col(f"`{id_col}`").cast("string").alias("item"), F.col(f"`{text_col}`").cast("string").alias("text"))
    path = scratch_path(items.sparkSession, "item-pieces")
    pieces = named.mapInArrow(lambda b: _pieces(b, window), "item string, words binary")
    pieces.dropDuplicates(["item", "words"]).write.parquet(path)
    stored = items.sparkSession.read.parquet(path)
    total = stored.agg(F.coalesce(F.sum(F.octet_length("words") / 8 + 1), F.lit(0.0)).cast("bigint")).first()[0]
    count = max(1, -(-total // block_words))
    share = F.pmod(F.xxhash64("item"), F.lit(count))  # splits the ids of a text that very many items share
    block = F.pmod(F.xxhash64("words", share), F.lit(count))
    dealt = stored.groupBy(block.alias("block"), "words").agg(F.sort_array(F.collect_set("item")).alias("items"))
    for number in range(count):
        held = dealt.filter(F.col("block") == number).orderBy("words").select("items", "words").toArrow()
        words = [np.frombuffer(w, np.uint64) for w in held.column(1).to_pylist()]
        yield Windows(held.column(0).to_pylist(), words, window)


def _hits(batch: pa.RecordBatch, column: int, found: Windows) -> Iterator[tuple[int, np.ndarray, tuple, list[list[str]]]]:
    """Per slice of texts: its first row, hit words, the words' places, and the item names per text."""
    for begin, _, data, offsets in text_slices(batch.column(column)):
        words, starts, ends, first = _words(data, offsets)
        hit, items = found.search(words, first)
        names = [[found.names[i] for i in items[t].tolist()] if t in items else [] for t in range(len(first) - 1)]
        yield begin, hit, (data, offsets, starts, ends, first), names


def _digest_columns(hit: np.ndarray, first: np.ndarray, names: list[list[str]]) -> list[pa.Array]:
    total = np.concatenate([[0], np.cumsum(hit)])
    n_hit = total[first[1:]] - total[first[:-1]]
    return [
        pa.array(np.diff(first)),
        pa.array(n_hit),
        pa.array([len(n) for n in names], pa.int64()),
        pa.array([sha256(",".join(n).encode()).hexdigest() for n in names], pa.string()),
        pa.array(n_hit > 0),
    ]


def _clean_columns(hit: np.ndarray, places: tuple, max_coverage: float) -> tuple[np.ndarray, list[bytes]]:
    """Which texts stay, and their bytes without hit stretches."""
    data, offsets, starts, ends, first = places
    joined = np.zeros(len(hit), np.bool_)  # hit like the word before in the same text
    joined[1:] = hit[1:] & hit[:-1]
    joined[first[:-1][first[:-1] < len(hit)]] = False
    drop = np.zeros(len(data) + 1, np.int64)
    np.add.at(drop, np.where(joined, np.concatenate([[0], ends[:-1]]), starts)[hit], 1)
    np.add.at(drop, ends[hit], -1)
    keep = np.cumsum(drop)[:-1] == 0
    total, kept_bytes = np.concatenate([[0], np.cumsum(hit)]), np.concatenate([[0], np.cumsum(keep)])
    n = np.maximum(np.diff(first), 1)
    stays = (total[first[1:]] - total[first[:-1]]) <= max_coverage * n
    raw, edge = data[keep].tobytes(), kept_bytes[offsets].tolist()
    return stays, [raw[a:b] for a, b in zip(edge[:-1], edge[1:])]


def _text_keys(text_col: str) -> list[Column]:
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), F.reverse(text)).alias("k2")]


_MARKS = "k1 bigint, k2 bigint, marks binary, names array<string>"


def _marked(batches: Iterator[pa.RecordBatch], found: Windows) -> Iterator[pa.RecordBatch]:
    """k1, k2, text -> the hit texts' words as packed bits, and their items."""
    for batch in batches:
        for begin, hit, places, names in _hits(batch, 2, found):
            first = places[-1]
            total = np.concatenate([[0], np.cumsum(hit)])
            rows = np.flatnonzero(total[first[1:]] > total[first[:-1]])
            take = pa.array(rows + begin)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(take),
                    batch.column(1).take(take),
                    pa.array([np.packbits(hit[first[r] : first[r + 1]]).tobytes() for r in rows], pa.binary()),
                    pa.array([names[r] for r in rows], pa.list_(pa.string())),
                ],
                names=["k1", "k2", "marks", "names"],
            )


def _joined_hits(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, tuple, list[list[str]]]]:
    """As ``_hits``, from the columns text, marks and names of several blocks."""
    marks, named = batch.column(1), batch.column(2)
    for begin, last, data, offsets in text_slices(batch.column(0)):
        starts, ends, first = split_words(lower_ascii(data), offsets, TERM_BYTES)
        hit, names = np.zeros(len(starts), np.bool_), []
        for i in range(last - begin):
            a, b = first[i], first[i + 1]
            for bits in marks[begin + i].as_py() or ():
                hit[a:b] |= np.unpackbits(np.frombuffer(bits, np.uint8), count=b - a).astype(np.bool_)
            names.append(sorted({n for part in named[begin + i].as_py() or () for n in part}))
        yield begin, hit, (data, offsets, starts, ends, first), names


def _scan(docs: DataFrame, items: DataFrame, finish, schema: T.StructType, carried: Column, window: int, item_col: str, text_col: str, item_text_col: str, block_words: int) -> DataFrame:
    """Rows of ``finish(row values, hit, places, names)`` over all documents."""
    text = F.col(f"`{text_col}`").cast("string").alias("text")
    spark = docs.sparkSession
    blocks = _blocks(items, window, item_col, item_text_col, block_words)
    found, more = next(blocks), next(blocks, None)
    if more is None:
        shared = spark.sparkContext.broadcast(found)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for begin, hit, places, names in _hits(batch, 1, shared.value):
                    yield finish(batch.column(0).slice(begin, len(names)), hit, places, names)

        return docs.select(carried.alias("row"), text).mapInArrow(run, schema)

    path = scratch_path(spark, "item-hits")
    keyed = docs.select(*_text_keys(text_col), text)
    number = 0
    while found is not None:
        shared = spark.sparkContext.broadcast(found)
        marks = keyed.mapInArrow(lambda b, s=shared: _marked(b, s.value), _MARKS)
        # Copies of a text have the same hits.
        hit = F.any_value(F.struct("marks", "names")).alias("hit")
        marks.groupBy("k1", "k2").agg(hit).write.parquet(f"{path}/{number}")
        shared.unpersist()
        found, more, number = more, next(blocks, None), number + 1
    hits = (
        spark.read.parquet(*[f"{path}/{i}" for i in range(number)])
        .groupBy("k1", "k2")
        .agg(F.collect_list("hit.marks").alias("marks"), F.collect_list("hit.names").alias("names"))
    )
    rows = docs.select(*_text_keys(text_col), carried.alias("row"), text).join(hits, ["k1", "k2"], "left").select("text", "marks", "names", "row")

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, hit, places, names in _joined_hits(batch):
                yield finish(batch.column(3).slice(begin, len(names)), hit, places, names)

    return rows.mapInArrow(joined, schema)


def contamination(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``<id_col>, n_words, n_hit, n_items, items_sha256, contaminated`` per row of ``docs``.

    Words are runs of digits, letters and characters outside ASCII after A-Z
    are lower-cased.  Null and empty texts have no words and no windows; an
    empty items' table hits nothing; an empty documents' table gives no rows.
    An item without an id hits words but is not counted; rows with one id are
    one item; repeated documents each give their row, with ids as they are,
    null included.  Other columns are not looked at.
    """
    kind = docs.schema[id_col].dataType
    schema = T.StructType(
        [
            T.StructField(id_col, kind),
            T.StructField("n_words", T.LongType()),
            T.StructField("n_hit", T.LongType()),
            T.StructField("n_items", T.LongType()),
            T.StructField("items_sha256", T.StringType()),
            T.StructField("contaminated", T.BooleanType()),
        ]
    )

    def finish(ids: pa.Array, hit: np.ndarray, places: tuple, names: list[list[str]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([ids, *_digest_columns(hit, places[-1], names)], names=schema.names)

    return _scan(docs, items, finish, schema, F.col(f"`{id_col}`"), window, item_col, text_col, item_text_col, block_words)


def decontaminated(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    max_coverage: float = 0.5,
    *,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``docs`` without the passages that reach a window, and without documents hit too widely.

    A document with more than ``max_coverage`` of its words hit goes; from the
    others each hit stretch goes, from its first word to its last, and the rest
    of the text stays byte for byte.  Columns, their names and their order are
    those of ``docs``; a null text stays null.  Null, empty and repeated rows
    as in ``contamination``.
    """
    others = [c for c in docs.columns if c != text_col]
    carried = F.struct(F.col(f"`{text_col}`").isNull().alias("none"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others)])
    kind = docs.select(carried.alias("row")).schema["row"].dataType
    schema = T.StructType([T.StructField("row", kind), T.StructField("text", T.StringType()), T.StructField("stays", T.BooleanType())])

    def finish(rows: pa.Array, hit: np.ndarray, places: tuple, names: list[list[str]]) -> pa.RecordBatch:
        stays, texts = _clean_columns(hit, places, max_coverage)
        return pa.RecordBatch.from_arrays(
            [rows, pa.array([t.decode() for t in texts], pa.string()), pa.array(stays)], names=schema.names
        )

    rows = _scan(docs, items, finish, schema, carried, window, item_col, text_col, item_text_col, block_words).filter("stays")
    text = F.when(~F.col("row.none"), F.col("text"))
    place = {c: i for i, c in enumerate(others)}
    return rows.select(*[text.alias(c) if c == text_col else F.col(f"row.c{place[c]}").alias(c) for c in docs.columns])
