"""A generalised suffix automaton over sequences of symbols, streamed in lockstep.

Building adds one symbol at a time.  Matching advances many streams at once:
each holds the state and the length of the longest suffix of what it has read
that occurs in some sequence.
"""

from __future__ import annotations

import numpy as np


class SuffixAutomaton:
    """``sequences`` are lists of numbers below ``symbols``."""

    def __init__(self, sequences: list[list[int]], symbols: int):
        self.symbols = max(symbols, 1)
        step: list[dict[int, int]] = [{}]
        link, size = [-1], [0]

        def state(steps: dict[int, int], length: int, shorter: int) -> int:
            step.append(steps)
            size.append(length)
            link.append(shorter)
            return len(size) - 1

        def split(at: int, symbol: int) -> int:
            """The state of the longest string of ``at`` followed by ``symbol``, cut from a longer one if need be."""
            to = step[at][symbol]
            if size[to] == size[at] + 1:
                return to
            part = state(dict(step[to]), size[at] + 1, link[to])
            link[to] = part
            while at >= 0 and step[at].get(symbol) == to:
                step[at][symbol] = part
                at = link[at]
            return part

        for sequence in sequences:
            last = 0
            for symbol in sequence:
                if symbol in step[last]:  # an earlier sequence had this already
                    last = split(last, symbol)
                    continue
                new = state({}, size[last] + 1, 0)
                at = last
                while at >= 0 and symbol not in step[at]:
                    step[at][symbol] = new
                    at = link[at]
                if at >= 0:
                    link[new] = split(at, symbol)
                last = new

        self.size = np.array(size, np.int32)
        self.link = np.array(link, np.int32)
        counts = [len(s) for s in step]
        from_ = np.repeat(np.arange(len(step), dtype=np.int64), counts)
        by = np.fromiter((c for s in step for c in s), np.int64, len(from_))
        to = np.fromiter((t for s in step for t in s.values()), np.int32, len(from_))
        key = from_ * self.symbols + by
        order = np.argsort(key)
        self.key, self.to = key[order], to[order]

    def advance(self, state: np.ndarray, length: np.ndarray, symbol: np.ndarray) -> None:
        """Read one symbol per stream (negative: in no sequence), changing ``state`` and ``length``."""
        todo = np.arange(len(symbol))
        if not len(self.key):
            return
        while len(todo):
            key = state[todo].astype(np.int64) * self.symbols + symbol[todo]
            at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
            found = (self.key[at] == key) & (symbol[todo] >= 0)
            state[todo[found]] = self.to[at[found]]
            length[todo[found]] += 1
            todo = todo[~found]
            length[todo[state[todo] == 0]] = 0
            todo = todo[state[todo] > 0]
            state[todo] = self.link[state[todo]]
            length[todo] = self.size[state[todo]]

    def first_at_least(self, length: int) -> np.ndarray:
        """Per state the state of its strings' suffix of ``length`` symbols; -1 where they are shorter."""
        out = np.full(len(self.size), -1, np.int32)
        shorter = np.where(self.link >= 0, self.size[np.maximum(self.link, 0)], -1)
        own = (self.size >= length) & (shorter < length)
        out[own] = np.flatnonzero(own)
        for at in np.argsort(self.size, kind="stable").tolist():  # a link is always shorter
            if shorter[at] >= length:
                out[at] = out[self.link[at]]
        return out
