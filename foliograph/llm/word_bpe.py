"""Ids of a lower-casing BPE tokenizer with word ends, for whole texts.

No match of its pattern spans white space, so a worker encodes distinct words
only.  Words of ASCII and Latin-1 letters, digits and punctuation run through
the batched merge; every other word goes through the ``tokenizers`` library.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import regex
from tokenizers import Tokenizer

from foliograph.llm.bpe import PairTable, PieceCache, encode_pieces
from foliograph.llm.textbytes import gather_ranges, hash_spans, split_words

_PLAIN = regex.compile("[!-~À-ÖØ-öø-ÿ]+")


def byte_chars() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = (b for b in range(256) if b not in set(visible))
    chars = {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [chars[b] for b in range(256)]


class WordBpe:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, end = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pattern = regex.compile(split["pattern"]["Regex"])
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.library = Tokenizer.from_file(path)
        chars = byte_chars()
        self.inner = np.array([vocab[c] for c in chars], np.int32)
        self.final = np.array([vocab[c + end] for c in chars], np.int32)
        self.pairs = PairTable(
            np.array([vocab[a] for a, _ in merges], np.int64),
            np.array([vocab[b] for _, b in merges], np.int64),
            np.arange(len(merges), dtype=np.int32),
            np.array([vocab[a + b] for a, b in merges], np.int32),
        )
        self.cache = PieceCache(self._encode_words)

    def _encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        pieces: list[bytes] = []
        per = np.zeros(len(words), np.int64)
        other: list[int] = []
        texts: list[str] = []
        for i, raw in enumerate(words):
            word = raw.decode()
            if not _PLAIN.fullmatch(word) or any(s in word for s in self.special):
                other.append(i)
                texts.append(word)
                continue
            found = (word.lower(),) if word.isalpha() else self.pattern.findall(word.lower())
            per[i] = len(found)
            pieces += [p.encode() for p in found]
        lengths = np.array([len(p) for p in pieces], np.int64)
        joined = np.frombuffer(b"".join(pieces), np.uint8)
        symbols = self.inner[joined]
        symbols[np.cumsum(lengths) - 1] = self.final[joined[np.cumsum(lengths) - 1]]
        ids, counts = encode_pieces(symbols, lengths, self.pairs)
        edges = np.concatenate([[0], np.cumsum(per)])
        total = np.concatenate([[0], np.cumsum(counts)])
        own = total[edges[1:]] - total[edges[:-1]]
        if not other:
            return ids, own
        parts = np.split(ids, np.cumsum(own)[:-1])
        for i, e in zip(other, self.library.encode_batch(texts, add_special_tokens=False)):
            parts[i] = np.array(e.ids, np.int32)
            own[i] = len(e.ids)
        return np.concatenate(parts), own

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and their number per text."""
        starts, ends, first = split_words(data, offsets)
        if not len(starts):
            return np.empty(0, np.int32), np.zeros(len(offsets) - 1, np.int64)
        row = self.cache.lookup(data, starts, ends, hash_spans(data, starts, ends))
        size = self.cache.count[row]
        total = np.concatenate([[0], np.cumsum(size)])
        return self.cache.ids[gather_ranges(self.cache.begin[row], size)], total[first[1:]] - total[first[:-1]]


@lru_cache(maxsize=2)
def word_bpe(path: str) -> WordBpe:
    return WordBpe(path)
