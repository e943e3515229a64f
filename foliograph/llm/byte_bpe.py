"""Byte-level BPE: texts to ids by a table of ranks, and back to bytes.

``encode_decode`` cuts each text into stretches that no pretoken crosses (white
space followed by a word), so a worker applies the pretoken pattern and the
merges to distinct stretches only and gathers the ids of whole texts with
numpy.  A null text counts as empty; repeated rows give repeated rows; other
columns of the input are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from foliograph.llm.bpe import PairTable, PieceCache, encode_pieces
from foliograph.llm.textbytes import gather_ranges, hash_spans, split_words, text_slices

# White space that is not among the ASCII characters stretches are cut at.
_OTHER_SPACE = regex.compile(r"[^\S\x20\x09-\x0D]")


class ByteBpe:
    """Encoder and decoder for a file of base64 tokens and ranks."""

    def __init__(self, ranks_path: str, pattern: str):
        with open(ranks_path, "rb") as lines:
            self.tokens = {base64.b64decode(t): int(r) for t, r in (line.split() for line in lines if line.strip())}
        self.pattern = regex.compile(pattern)
        self.byte_id = np.array([self.tokens[bytes([b])] for b in range(256)], np.int32)
        self.pairs = self._pair_table()
        top = max(self.tokens.values()) + 1
        by_id = [b""] * top
        for token, rank in self.tokens.items():
            by_id[rank] = token
        self.token_size = np.array([len(t) for t in by_id], np.int64)
        self.token_at = np.cumsum(self.token_size) - self.token_size
        self.token_bytes = np.frombuffer(b"".join(by_id), np.uint8)
        self.cache = PieceCache(self._encode_stretches)

    def _pair_table(self) -> PairTable:
        left, right, rank = [], [], []
        for token, r in self.tokens.items():
            for cut in range(1, len(token)):
                a, b = self.tokens.get(token[:cut]), self.tokens.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    rank.append(r)
        r = np.array(rank, np.int32)
        return PairTable(np.array(left, np.int64), np.array(right, np.int64), r, r)

    def _pretokens(self, stretches: list[bytes]) -> tuple[list[bytes], np.ndarray]:
        pieces: list[bytes] = []
        counts = np.empty(len(stretches), np.int64)
        find = self.pattern.findall
        for i, raw in enumerate(stretches):
            found = find(raw.decode())
            counts[i] = len(found)
            pieces += [p.encode() for p in found]
        return pieces, counts

    def _encode_stretches(self, stretches: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        pieces, per = self._pretokens(stretches)
        # A whole pretoken that is itself a token takes that token's id.
        lengths = np.array([len(p) for p in pieces], np.int64)
        whole = np.array([self.tokens.get(p, -1) for p in pieces], np.int64)
        rest = np.flatnonzero(whole < 0)
        joined = np.frombuffer(b"".join(pieces[i] for i in rest), np.uint8)
        ids, counts = encode_pieces(self.byte_id[joined], lengths[rest], self.pairs)
        count = np.ones(len(pieces), np.int64)
        count[rest] = counts
        out = np.empty(int(count.sum()), np.int32)
        begin = np.cumsum(count) - count
        out[begin[whole >= 0]] = whole[whole >= 0]
        out[gather_ranges(begin[rest], counts)] = ids
        edges = np.concatenate([[0], np.cumsum(per)])
        total = np.concatenate([[0], np.cumsum(count)])
        return out, total[edges[1:]] - total[edges[:-1]]

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and their number per text."""
        starts, ends, first = split_words(data, offsets)
        counts = np.zeros(len(offsets) - 1, np.int64)
        # Each stretch runs from the end of the word before (or the text's
        # start) to the end of its own word; what follows the last word of a
        # text is a stretch of white space.
        from_, to = starts.copy(), ends
        if len(starts):
            from_[1:] = ends[:-1]
            heads = first[:-1][first[1:] > first[:-1]]
            from_[heads] = offsets[:-1][first[1:] > first[:-1]]
        tail_from = offsets[:-1].copy()
        has = first[1:] > first[:-1]
        tail_from[has] = ends[first[1:][has] - 1]
        tails = np.flatnonzero(tail_from < offsets[1:])
        from_ = np.concatenate([from_, tail_from[tails]])
        to = np.concatenate([to, offsets[1:][tails]])
        text = np.concatenate([np.repeat(np.arange(len(counts)), np.diff(first)), tails])
        order = np.argsort(from_, kind="stable")
        from_, to, text = from_[order], to[order], text[order]
        if not len(from_):
            return np.empty(0, np.int32), counts
        odd = self._with_other_space(data, offsets)
        row = self.cache.lookup(data, from_, to, hash_spans(data, from_, to))
        size = self.cache.count[row]
        ids = self.cache.ids[gather_ranges(self.cache.begin[row], size)]
        np.add.at(counts, text, size)
        return self._patched(ids, counts, odd, data, offsets) if len(odd) else (ids, counts)

    @staticmethod
    def _with_other_space(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Texts with white space outside ASCII or among \\x1c-\\x1f: they are cut as a whole."""
        hint = ((data >= 0x1C) & (data <= 0x1F)) | ((data >= 0xE1) & (data <= 0xE3))
        hint[:-1] |= (data[:-1] == 0xC2) & ((data[1:] == 0x85) | (data[1:] == 0xA0))
        texts = np.unique(np.searchsorted(offsets, np.flatnonzero(hint), "right") - 1)
        return np.array(
            [t for t in texts if _OTHER_SPACE.search(data[offsets[t] : offsets[t + 1]].tobytes().decode())], np.int64
        )

    def _patched(self, ids, counts, odd, data, offsets):
        parts, counts = np.split(ids, np.cumsum(counts)[:-1]), counts.copy()
        own, n = self._encode_stretches([data[offsets[t] : offsets[t + 1]].tobytes() for t in odd])
        for t, piece in zip(odd, np.split(own, np.cumsum(n)[:-1])):
            parts[t] = piece
        counts[odd] = n
        return np.concatenate(parts), counts

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes that ids stand for."""
        return self.token_bytes[gather_ranges(self.token_at[ids], self.token_size[ids])]


@lru_cache(maxsize=2)
def _loaded(ranks_path: str, pattern: str) -> ByteBpe:
    return ByteBpe(ranks_path, pattern)


_DIGESTS = pa.schema(
    [("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
)


def _digests(batch: pa.RecordBatch, bpe: ByteBpe) -> tuple[list, list, list]:
    n_tokens, ids_hex, bytes_hex = [], [], []
    for _, _, data, offsets in text_slices(batch.column(1)):
        ids, counts = bpe.encode(data, offsets)
        n_tokens += counts.tolist()
        at = 0
        for n in counts.tolist():
            own = ids[at : at + n]
            ids_hex.append(hashlib.sha256(own.astype("<u4").tobytes()).hexdigest())
            bytes_hex.append(hashlib.sha256(bpe.decode(own).tobytes()).hexdigest())
            at += n
    return n_tokens, ids_hex, bytes_hex


def encode_decode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` of the round trip."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _loaded(ranks_path, pattern)
        for batch in batches:
            columns = [pa.array(c, f.type) for c, f in zip(_digests(batch, bpe), _DIGESTS)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=[id_col, *_DIGESTS.names])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(
        run, f"`{id_col}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )


def encoded(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id and ``ids`` as an array of integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _loaded(ranks_path, pattern)
        for batch in batches:
            for first, last, data, offsets in text_slices(batch.column(1)):
                ids, counts = bpe.encode(data, offsets)
                edges = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(edges), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first), lists], names=[id_col, "ids"]
                )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, ids array<int>")
