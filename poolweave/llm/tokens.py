"""Token ids and counts by a public vocabulary file, one distinct word at a time.

The vocabulary splits at white space before anything else, so a text's ids are its
words' ids in order. A word of letters with punctuation behind it is two units, which
the vocabulary encodes apart; any other word is one unit. Most units repeat: a task
hashes all of them (64 bits), encodes each distinct one once and puts texts together
from the stored ids. Letters go to the vocabulary's BPE model directly, all other
units through the whole tokenizer.
"""

from __future__ import annotations

import os
import unicodedata
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa

from poolweave.llm.common import IS_SPACE, LOWER, mix, position_keys, ranges, text_bytes

TOKENIZER = "word_bpe_49k.json"
MAX_UNITS = 1_000_000  # kept by a Python worker, some 40 MB; beyond that it starts anew
TERM_BITS = 16

_LETTER, _MARK, _OTHER = 1, 2, 3
#: Bytes of other scripts count as letters until a unit is looked at.
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = _LETTER
_CLASS[[ord(c) for c in "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"]] = _MARK  # no apostrophe

_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
#: Byte-level BPE shows printable bytes as themselves and the others from 256 on.
_SHOWN = dict(zip(_PRINTED, _PRINTED)) | {
    b: 256 + k for k, b in enumerate(x for x in range(256) if x not in _PRINTED)
}


def tokenizer_path(name: str) -> str:
    """A file of that path, or the public vocabulary of that name."""
    if os.path.isabs(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


@cache
def load(name: str):
    """The tokenizer of a file, once per Python worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path(name))


@dataclass
class Units:
    """The units of a block: hashes, byte ranges, words they belong to, first by text."""

    hashes: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray
    heads: np.ndarray  # is it the first unit of its word
    two: np.ndarray  # does its word have a second unit
    first: np.ndarray


def units_of(data: np.ndarray, borders: np.ndarray) -> Units:
    inside = ~IS_SPACE[data]
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    before[borders[:-1][borders[:-1] < len(data)]] = False
    starts = np.flatnonzero(inside & ~before)
    if not len(starts):
        none, no = np.zeros(0, np.int64), np.zeros(0, bool)
        return Units(np.zeros(0, np.uint64), none, none, no, no, np.zeros(len(borders), np.int64))
    compact = data[inside]
    kinds = _CLASS[compact]
    lengths = np.diff(np.append(np.flatnonzero(~before[inside]), len(compact)))
    at = np.cumsum(lengths) - lengths
    letters = np.add.reduceat(kinds == _LETTER, at, dtype=np.int64)
    # Letters, then marks: the kinds never fall, and none is another.
    falls = np.zeros(len(compact), bool)
    falls[1:] = kinds[1:] < kinds[:-1]
    falls[at] = False
    plain = ~np.logical_or.reduceat(falls | (kinds == _OTHER), at) & (letters > 0)
    two = plain & (letters < lengths)
    # Units tile the words: each word's start, and where its marks begin.
    heads = np.ones(len(at) + int(two.sum()), bool)
    place = np.arange(len(at)) + np.cumsum(two) - two
    heads[place[two] + 1] = False
    begin = np.empty(len(heads), np.int64)
    begin[place] = at
    begin[~heads] = (at + letters)[two]
    unit_lengths = np.diff(np.append(begin, len(compact)))
    source = np.empty(len(heads), np.int64)
    source[place] = starts
    source[~heads] = (starts + letters)[two]
    pos = np.arange(len(compact)) - np.repeat(begin, unit_lengths)
    lowered = np.where(np.repeat(plain, lengths), LOWER[compact], compact)
    values = (lowered.astype(np.uint64) + np.uint64(1)) * position_keys(int(unit_lengths.max()))[pos]
    hashes = mix(np.add.reduceat(values, begin) + unit_lengths.astype(np.uint64))
    word_first = np.searchsorted(starts, borders)
    first = np.append(place, len(heads))[word_first]
    has_two = np.zeros(len(heads), bool)
    has_two[place] = two
    return Units(hashes, source, unit_lengths, heads, has_two, first)


class WordIds:
    """Ids of distinct units, as ranges of one growing array."""

    def __init__(self, name: str = TOKENIZER, limit: int = MAX_UNITS):
        self.tokenizer = load(name)
        self.limit = limit
        self._clear()

    def _clear(self) -> None:
        self.known = np.zeros(0, np.uint64)  # sorted hashes
        self.row_of = np.zeros(0, np.int64)  # and their rows
        self.n = 1  # row 0 has no id
        self.ids = np.zeros(1 << 16, np.uint16)
        self.ends = np.zeros(1 << 14, np.int64)  # row r ends at ends[r + 1]
        self.joint = np.zeros(1 << 14, bool)  # not to be encoded apart from its marks

    def _rows(self, hashes: np.ndarray, starts, lengths, data: np.ndarray) -> np.ndarray:
        """The row of each unit; new units are encoded."""
        encoded = pa.array(hashes.view(np.int64)).dictionary_encode()
        codes = np.asarray(encoded.indices)
        distinct = np.asarray(encoded.dictionary).view(np.uint64)
        if self.n + len(distinct) > self.limit:
            self._clear()
        place = np.searchsorted(self.known, distinct)
        there = np.zeros(len(distinct), bool)
        inner = place < len(self.known)
        there[inner] = self.known[place[inner]] == distinct[inner]
        if not there.all():
            sample = np.empty(len(distinct), np.int64)
            sample[codes[::-1]] = np.arange(len(codes))[::-1]
            new = sample[~there]
            self._add([data[a : a + n].tobytes() for a, n in zip(starts[new], lengths[new])])
            fresh = distinct[~there]
            order = np.argsort(fresh)
            at = place[~there][order]
            rows = np.arange(self.n - len(fresh), self.n)[order]
            self.known = np.insert(self.known, at, fresh[order])
            self.row_of = np.insert(self.row_of, at, rows)
            place = np.searchsorted(self.known, distinct)
        return self.row_of[place][codes]

    def _add(self, units: list[bytes]) -> None:
        lists: list = [None] * len(units)
        joint = np.zeros(len(units), bool)
        slow = []
        tokenize = self.tokenizer.model.tokenize
        for k, unit in enumerate(units):
            if unit.isascii():
                if unit.isalpha():
                    lists[k] = [t.id for t in tokenize(unit.decode().lower())]
                    continue
            else:
                text = unit.decode()
                # Letters may hold marks once they are normalised, as İ and क़ do.
                joint[k] = not (text.isalpha() and unicodedata.normalize("NFC", text).lower().isalpha())
                if not joint[k]:
                    text = text.translate(_ASCII_LOWER)
                    if text.islower() and unicodedata.is_normalized("NFC", text):
                        shown = text.encode().decode("latin-1").translate(_SHOWN)
                        lists[k] = [t.id for t in tokenize(shown)]
                        continue
            slow.append(k)
        if slow:
            texts = [units[k].decode() for k in slow]
            for k, e in zip(slow, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
                lists[k] = e.ids
        rows = self._append(lists)
        self.joint[rows] = joint

    def _look_up(self, texts: pa.Array) -> tuple[np.ndarray, Units]:
        data, borders = text_bytes(texts)
        units = units_of(data, borders)
        rows = self._rows(units.hashes, units.starts, units.lengths, data)
        # Words whose "letters" were none, with marks behind them: encoded as a whole.
        whole = np.flatnonzero(self.joint[rows] & units.two)
        if len(whole):
            parts = data, units.starts[whole], units.lengths[whole] + units.lengths[whole + 1]
            words = [parts[0][a : a + n].tobytes().decode() for a, n in zip(*parts[1:])]
            lists = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
            rows[whole] = self._append(lists)
            rows[whole + 1] = 0
        return rows, units

    def _append(self, lists: list[list[int]]) -> np.ndarray:
        """New rows for these ids."""
        ends = self.ends[self.n] + np.cumsum([len(x) for x in lists])
        self.ids = _room(self.ids, int(ends[-1]))
        self.ids[self.ends[self.n] : ends[-1]] = [i for x in lists for i in x]
        self.ends = _room(self.ends, self.n + len(lists) + 1)
        self.joint = _room(self.joint, self.n + len(lists) + 1)
        self.ends[self.n + 1 : self.n + 1 + len(lists)] = ends
        self.joint[self.n : self.n + len(lists)] = False
        self.n += len(lists)
        return np.arange(self.n - len(lists), self.n)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts end to end, and where each text's ids begin."""
        ids, first, _, _ = self.encode_with_terms(texts)
        return ids, first

    def encode_with_terms(self, texts: pa.Array):
        """As :meth:`encode`, then the hashed term of every word and each text's first word."""
        rows, units = self._look_up(texts)
        starts = self.ends[rows]
        lengths = self.ends[rows + 1] - starts
        total = np.append(0, np.cumsum(lengths))
        terms = (units.hashes[units.heads] >> np.uint64(64 - TERM_BITS)).astype(np.int64)
        words = np.append(0, np.cumsum(units.heads))
        return self.ids[ranges(starts, lengths)], total[units.first], terms, words[units.first]

    def count(self, texts: pa.Array) -> np.ndarray:
        """The number of ids of each text."""
        rows, units = self._look_up(texts)
        lengths = self.ends[rows + 1] - self.ends[rows]
        return np.diff(np.append(0, np.cumsum(lengths))[units.first])


_ASCII_LOWER = {c: c + 32 for c in range(65, 91)}


def _room(array: np.ndarray, needed: int) -> np.ndarray:
    if needed <= len(array):
        return array
    grown = np.zeros(max(needed, 2 * len(array)), array.dtype)
    grown[: len(array)] = array
    return grown


@cache
def word_ids(name: str = TOKENIZER) -> WordIds:
    """The ids kept by a Python worker for all its tasks."""
    return WordIds(name)
