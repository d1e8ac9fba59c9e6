"""Repeated strings against a table of all 50-byte strings; transforms against sorting."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from poolweave.llm import bwt, suffixes

from .conftest import sentence


def brute(rows):
    """doc_id -> n_bytes, n_removed, n_spans, kept_sha256 of the rows' texts."""
    first = {}
    for key, text in rows:
        data = (text or "").encode()
        for k in range(len(data) - 49):
            first[data[k : k + 50]] = min(first.get(data[k : k + 50], key), key)
    out = {}
    for key, text in rows:
        data = (text or "").encode()
        gone = [False] * len(data)
        for k in range(len(data) - 49):
            if first[data[k : k + 50]] < key:
                gone[k : k + 50] = [True] * 50
        spans = sum(g and not b for g, b in zip(gone, [False, *gone]))
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out[key] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def result(docs):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixes.remove_repeats(docs).collect()}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_shared_passages(make_docs, seed):
    chosen = random.Random(seed)
    passages = [sentence(seed * 50 + k, chosen.randrange(8, 40)) for k in range(6)]
    texts = {}
    for k in range(60):
        parts = [sentence(seed * 1000 + k, chosen.randrange(0, 30))]
        for _ in range(chosen.randrange(0, 3)):
            passage = chosen.choice(passages)
            a = chosen.randrange(len(passage) // 2)
            parts += [passage[a : a + chosen.randrange(40, 70)], chosen.choice(["x", "é", " ", "ab"]) * chosen.randrange(0, 9)]
        texts[chosen.randrange(10**6)] = "".join(parts)
    assert result(make_docs(texts)) == brute(texts.items())


def test_periodic_texts(make_docs):
    texts = {1: "a" * 200, 2: "b" * 60 + "a" * 70, 3: "ab" * 100, 4: "ba" * 49, 5: "a" * 49, 6: "a" * 50, 7: "ab" * 25 + "é" * 40}
    assert result(make_docs(texts)) == brute(texts.items())


def test_awkward_rows(awkward, awkward_rows, nothing):
    rows = [r[:2] for r in awkward_rows if r[0] is not None]
    found = suffixes.remove_repeats(awkward).collect()
    assert len(found) == len(rows)
    expected = brute(rows)
    assert all((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == expected[r.doc_id] for r in found)
    assert suffixes.remove_repeats(nothing).count() == 0


def test_segments_lose_no_string():
    """Minimizers of a long text, computed in segments, are those of the whole."""
    data = np.random.default_rng(1).integers(97, 100, 5000).astype(np.uint8)
    borders = np.array([0, 1700, 1700, 1730, 5000])
    whole = [(b + low, v) for b, v, _, _, low in suffixes.minimizers(data, borders)]
    try:
        suffixes.SEGMENT = 512
        parts = [(b + low, v) for b, v, _, _, low in suffixes.minimizers(data, borders)]
    finally:
        suffixes.SEGMENT = 1 << 20
    assert len(parts) > 5
    for k in range(2):
        assert np.array_equal(np.concatenate([p[k] for p in parts]), whole[0][k])


@pytest.mark.parametrize("shard", [5, 64, 4096])
def test_merged_pieces(monkeypatch, shard):
    monkeypatch.setattr(suffixes, "SHARD_STRINGS", shard)
    chosen = random.Random(shard)
    n = 200
    cores = np.array([chosen.randrange(2**63) for _ in range(20)], np.uint64)
    core = cores[[chosen.randrange(20) for _ in range(n)]]
    left, right = np.zeros((2, n, 8), np.uint8)
    ids = np.array([chosen.randrange(40) for _ in range(n)])
    least, strings = {}, []
    for k in range(n):
        offset = chosen.randrange(8)
        count = chosen.randrange(1, 9 - offset)
        left[k, offset:7] = [chosen.randrange(97, 99) for _ in range(7 - offset)]
        right[k, : offset + count - 1] = [chosen.randrange(97, 99) for _ in range(offset + count - 1)]
        left[k, 7], right[k, 7] = offset, count
        own = [(j, int(core[k]), bytes(left[k, j:7]), bytes(right[k, :j])) for j in range(offset, offset + count)]
        strings.append(own)
        for s in own:
            least[s] = min(least.get(s, ids[k]), ids[k])
    flags = suffixes._merged_flags([core, left.view(np.uint64).ravel(), right.view(np.uint64).ravel()], ids)
    for k in range(n):
        assert list(flags[k, : len(strings[k])]) == [least[s] < ids[k] for s in strings[k]]
        assert not flags[k, len(strings[k]) :].any()


@pytest.mark.parametrize("seed", range(12))
def test_merge_of_transforms(seed):
    """Blocks of the merge are the classes of equal prefixes, in sorted order."""
    chosen = random.Random(seed)
    alphabet = chosen.choice([b"ab", b"abc", bytes(range(0, 245))])
    base = [bytes(chosen.choice(alphabet) for _ in range(chosen.randint(4, 40))) for _ in range(3)]
    prefix = chosen.choice([2, 4, 6, 10])
    shards = []
    for _ in range(chosen.randint(1, 5)):
        strings = []
        for _ in range(chosen.randint(1, 12)):
            text = chosen.choice(base)
            a = chosen.randint(0, len(text) - 1)
            strings.append(text[a : a + chosen.randint(1, 20)])
        body, lengths = np.zeros((len(strings), 20), np.uint8), np.array([len(x) for x in strings])
        for k, x in enumerate(strings):
            body[k, : len(x)] = np.frombuffer(x, np.uint8)
        shards.append(bwt.sorted_shard(*bwt.joined(body, lengths)))
    rows = list(zip(*bwt.merged_blocks(shards, prefix)))
    head = lambda a, p: tuple(shards[a].text[p : p + prefix].tolist())
    whole = [(head(a, p), int(b), int(a), int(p)) for a, p, b in rows if len(head(a, p)) == prefix and 0 not in head(a, p)]
    assert [w[0] for w in whole] == sorted(w[0] for w in whole)
    assert len({(w[0], w[1]) for w in whole}) == len({w[0] for w in whole}) == len({w[1] for w in whole})
    assert len({(int(a), int(p)) for a, p, _ in rows}) == sum(len(s.text) for s in shards)


def test_frequent_line_between_different_bytes(make_docs, monkeypatch):
    """A line of 45 bytes with differing bytes around it: no core keeps all its pieces."""
    chosen = random.Random(8)
    line = "the same line of 45 bytes in every document!!"
    assert len(line) == 45
    texts = {k: sentence(k, 12) + chosen.choice("abc") * 3 + line + chosen.choice("xyz") + sentence(k + 900, 12) for k in range(300)}
    monkeypatch.setattr(suffixes, "HOT_PIECES", 40)
    largest = []
    send = suffixes._send_pieces

    def spy(marks, parts, hot):
        if not marks:
            largest.append(hot.value)
        return send(marks, parts, hot)

    monkeypatch.setattr(suffixes, "_send_pieces", spy)
    assert result(make_docs(texts)) == brute(texts.items())
    hot = largest[0]
    data = [t.encode() for t in texts.values()]
    lists = []
    for d in data:
        values = [v for _, v, *_ in suffixes.minimizers(np.frombuffer(d, np.uint8), np.array([0, len(d)]))]
        lists.append(np.concatenate(values).tobytes())
    block = pa.RecordBatch.from_pydict({"text": pa.array(data, pa.large_binary()), "hashes": pa.array(lists, pa.binary())})
    _, _, whole = suffixes._pieces_of(block, np.zeros_like(hot))
    by_piece = most_frequent(whole)
    _, _, whole = suffixes._pieces_of(block, hot)
    by_string = most_frequent(whole)
    assert by_piece > 40 >= by_string


def most_frequent(whole):
    """How many different pieces the core with the most of them has."""
    return int(np.unique(np.unique(np.stack(whole), axis=1)[0], return_counts=True)[1].max())
