"""An index of a shard's words for phrases of limited length.

The shard's text is an array of symbols: 0 closes a piece, 1 and up are words. Its
suffixes are sorted by as many symbols as a phrase may have; that is all the order that
intervals of such phrases need. Of the Burrows-Wheeler transform the index keeps the
inverse of the last-to-first mapping: the row of a suffix without its first symbol. It
rises within the rows of a word, so its differences are small. Besides there is for each
row how many symbols it shares with the row before.

A phrase is an interval of rows. One word more cuts it where rows share no more symbols;
the mapping leads from the longer phrase to the interval of its last part.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from poolweave.llm.common import ranges

DEPTH = 5


@dataclass
class Phrases:
    """Intervals of distinct phrases of ``words`` words."""

    start: np.ndarray
    size: np.ndarray
    words: int

    def taken(self, places: np.ndarray) -> Phrases:
        return Phrases(self.start[places], self.size[places], self.words)


@dataclass
class Extended:
    """Phrases one word longer, with the places of their first and last parts in the list."""

    phrases: Phrases
    without_last: np.ndarray
    without_first: np.ndarray


def order_of(key: np.ndarray, bits: int) -> np.ndarray:
    """The stable order of keys below ``2**bits``: sorted with their places in one number."""
    n = len(key)
    room = max(1, int(n).bit_length())
    if bits + room > 63:
        return np.argsort(key, kind="stable")
    return np.sort(key.astype(np.int64) << room | np.arange(n)) & ((1 << room) - 1)


def suffixes(text: np.ndarray, bits: int) -> np.ndarray:
    """The text's suffixes, sorted by DEPTH symbols."""
    n = len(text)
    # Ranks by 1, 2, 4 and at last DEPTH symbols: two shorter ranks give a longer one.
    rank, order = text.astype(np.int64), np.arange(n)
    for first, more in ((1, 1), (2, 2), (4, 1)):
        behind = np.zeros(n, np.int64)
        behind[: max(0, n - first)] = rank[first:] if more > 1 or first == 1 else text[first:]
        key = rank << bits | behind
        order = order_of(key, 2 * bits)
        if first + more < DEPTH:
            new = np.ones(n, np.int64)
            new[1:] = key[order[1:]] != key[order[:-1]]
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(new)
    return order


class Index:
    """Where each symbol's rows begin, the rows one symbol on, and symbols shared with the row before."""

    def __init__(self, begin: np.ndarray, following: np.ndarray, shared: np.ndarray) -> None:
        self.begin, self.following, self.shared = begin, following, shared

    @classmethod
    def of(cls, text: np.ndarray) -> Index:
        bits = max(1, int(text.max(initial=0)).bit_length(), int(len(text)).bit_length())
        order = suffixes(text, bits)
        begin = np.append(0, np.cumsum(np.bincount(text, minlength=1)))
        following = order_of(text[order - 1], bits).astype(np.int32)
        padded = np.append(text, np.zeros(DEPTH, text.dtype))
        shared, equal = np.zeros(len(text), np.uint8), np.ones(max(0, len(text) - 1), bool)
        for k in range(DEPTH):
            symbol = padded[order + k]
            equal &= symbol[1:] == symbol[:-1]
            shared[1:] += equal
        return cls(begin, following, shared)

    def words(self) -> Phrases:
        """Every word as a phrase: symbol k + 1 is at place k."""
        return Phrases(self.begin[1:-1], np.diff(self.begin)[1:], 1)

    def extended(self, phrases: Phrases) -> Extended:
        """All phrases one word longer whose first and last parts are both in ``phrases``."""
        place = np.full(len(self.shared), -1, np.int32)
        place[ranges(phrases.start, phrases.size)] = np.repeat(np.arange(len(phrases.size), dtype=np.int32), phrases.size)
        heads = np.flatnonzero(self.shared <= phrases.words)
        ends = np.append(heads[1:], len(self.shared))
        some = place[heads] >= 0
        heads, ends = heads[some], ends[some]
        last = place[self.following[heads]]
        some = last >= 0
        heads, ends, last = heads[some], ends[some], last[some]
        return Extended(Phrases(heads, ends - heads, phrases.words + 1), place[heads], last)
