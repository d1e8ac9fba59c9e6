"""Burrows-Wheeler transforms of small sets of strings, and their merge.

A shard is a set of byte strings, each closed by an end mark of its own; end marks sort
below all bytes and among each other by string. Shards are sorted one by one. Their
merge never sorts suffixes again: it starts from the shards one after the other and
refines that interleave. In each step the rows are dealt out, in their present order,
by the two symbols that precede their suffixes; the row where a shard's suffix begins
two symbols earlier is known from its own transform. After n steps rows are in the order
of their first 2n symbols, and rows that agree in all of them are one block: blocks are
the intervals whose common prefix is at least that long.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

END = 0  # bytes are stored one higher; UTF-8 has no byte above 0xF4


@dataclass
class Shard:
    """Sorted suffixes of a set of strings, as positions in their joined text."""

    text: np.ndarray  # each string followed by two end marks
    string: np.ndarray  # of every position
    order: np.ndarray  # position of each row's suffix
    rank: np.ndarray  # row of each position


def joined(strings: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Strings in the rows of a matrix as one text with end marks, and their numbers."""
    width = strings.shape[1]
    body = np.zeros((len(strings), width + 2), np.uint8)
    inside = np.arange(width) < lengths[:, None]
    body[:, :width] = np.where(inside, strings + 1, END)
    keep = np.arange(width + 2) < (lengths + 2)[:, None]
    number = np.broadcast_to(np.arange(len(strings))[:, None], keep.shape)
    return body[keep], number[keep]


def sorted_shard(text: np.ndarray, string: np.ndarray) -> Shard:
    """Sort all suffixes up to their end marks, by doubling prefixes from 8 symbols."""
    n = len(text)
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    key = np.zeros(n, np.uint64)
    open_ = np.ones(n, bool)  # no end mark so far
    for k in range(8):
        symbol = padded[k : k + n]
        open_ &= symbol != END
        key = key << np.uint64(8) | np.where(open_, symbol, 0).astype(np.uint64)
    order = np.argsort(key, kind="stable")
    sorted_key, sorted_open = key[order], open_[order]
    new = np.ones(n, bool)
    # Suffixes that end within the prefix are told apart by string.
    new[1:] = (sorted_key[1:] != sorted_key[:-1]) | ~sorted_open[1:]
    width = 8
    while not new.all():
        group = np.cumsum(new) - 1
        rank = np.empty(n, np.int64)
        rank[order] = group
        size = np.bincount(group)
        rows = np.flatnonzero(size[group] > 1)
        behind = rank[np.minimum(order[rows] + width, n - 1)]
        again = np.lexsort((behind, group[rows]))
        order[rows] = order[rows][again]
        behind, groups = behind[again], group[rows]
        fresh = np.ones(len(rows), bool)
        fresh[1:] = (behind[1:] != behind[:-1]) | (groups[1:] != groups[:-1])
        new[rows] |= fresh
        width *= 2
    rank = np.empty(n, np.int64)
    rank[order] = np.arange(n)
    return Shard(text, string, order, rank)


def merged_blocks(shards: list[Shard], prefix: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of the merge of all shards in the order of their first ``prefix`` symbols.

    Returns, for every row, its shard, its position there, and the number of its block.
    ``prefix`` is even. Rows whose suffix ends earlier are blocks of their own.
    """
    base = np.cumsum([0] + [len(s.text) for s in shards])
    total = int(base[-1])
    back = np.empty(total, np.int64)  # the row two symbols earlier
    symbols = np.empty(total, np.uint16)  # and those two symbols
    fixed_rows, fixed_keys = [], []
    for k, s in enumerate(shards):
        before = s.order - 2
        before[before < 0] += len(s.text)
        middle = s.order - 1
        middle[middle < 0] += len(s.text)
        back[base[k] : base[k + 1]] = s.rank[before] + base[k]
        symbols[base[k] : base[k + 1]] = s.text[before].astype(np.uint16) << 8 | s.text[middle]
        # Suffixes that start with an end mark, or one symbol before it, are in order
        # by string within their bucket.
        first, second = s.text, np.append(s.text[1:], END)
        own = np.flatnonzero((first == END) | (second == END))
        fixed_rows.append(s.rank[own] + base[k])
        key = np.where(first[own] == END, 0, first[own].astype(np.int64) << 8)
        fixed_keys.append(key)
    rows, keys = np.concatenate(fixed_rows), np.concatenate(fixed_keys)
    rows, keys = rows[np.argsort(keys, kind="stable")], np.sort(keys)
    # Where a bucket begins does not change; its fixed rows come first in it.
    heads = np.concatenate([s.text.astype(np.int64) << 8 | np.append(s.text[1:], END) for s in shards])
    heads = np.where(heads < 256, 0, heads)
    begin = np.cumsum(np.bincount(heads, minlength=1 << 16))
    begin = np.append(0, begin[:-1])
    places = begin[keys] + np.arange(len(keys)) - np.searchsorted(keys, keys)
    now = np.arange(total)
    block = np.zeros(total, np.int64)
    alone = np.zeros(total, bool)
    alone[places] = True
    starts = alone.copy()
    starts[1:] |= alone[:-1]
    sort_key = np.where(symbols < 256, np.uint16(0), symbols)
    for _ in range(prefix // 2):
        given = sort_key[now]
        dealt = np.argsort(given, kind="stable")
        given, was = given[dealt], block[dealt]
        now = back[now[dealt]]
        now[places] = rows
        new = starts.copy()
        new[0] = True
        new[1:] |= (given[1:] != given[:-1]) | (was[1:] != was[:-1])
        block = np.cumsum(new) - 1
    shard = np.searchsorted(base, now, "right") - 1
    position = np.concatenate([s.order for s in shards])[now]
    return shard, position, block
