"""Conversation repair against an exhaustive search of edits."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from poolweave.llm import conversations, queries
from poolweave.llm.turns import ASSISTANT, EMPTY, edits

COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def every_edit(rows, inserts):
    """All (cost, audit, roles, lines) with at most so many insertions."""
    def go(i, left, cost, audit, lines):
        if i == len(rows):
            yield cost, audit, lines
        if left:
            for name in ("user", "assistant"):
                yield from go(i, left - 1, cost + 5, audit + "I", lines + [(name, "")])
        if i < len(rows):
            role, text, fault = rows[i]
            yield from go(i + 1, left, cost + 2, audit + "D", lines)
            if fault in ("k", "t"):
                more = 5 if fault == "t" else 0
                yield from go(i + 1, left, cost + more, audit + "K", lines + [(role, text)])
                for name in ("user", "assistant"):
                    yield from go(i + 1, left, cost + 1 + more, audit + "R", lines + [(name, text)])
    yield from go(0, inserts, 0, "", [])


def searched(rows, inserts=3):
    good = (
        e for e in every_edit(rows, inserts)
        if re.fullmatch("(s?(ua)+)?", "".join(r[:1] or "-" for r, _ in e[2]))
    )
    return min(good, key=lambda e: e[:2])


def by_states(rows):
    """The same for long conversations: least (cost, audit, lines) by last role, row by row."""
    follows = {"": "su", "s": "u", "u": "a", "a": "u"}
    names = {"u": "user", "a": "assistant"}

    def inserted(ways):
        for _ in range(3):
            for last, (cost, audit, lines) in list(ways.items()):
                for c in follows[last]:
                    if c != "s":
                        offer(ways, c, (cost + 5, audit + "I", lines + [(names[c], "")]))
        return ways

    def offer(ways, last, way):
        if last not in ways or way[:2] < ways[last][:2]:
            ways[last] = way

    ways = inserted({"": (0, "", [])})
    for role, text, fault in rows:
        now = {}
        for last, (cost, audit, lines) in ways.items():
            offer(now, last, (cost + 2, audit + "D", lines))
            if fault in "kt":
                more = 5 if fault == "t" else 0
                for c in follows[last]:
                    if role[:1] == c:
                        offer(now, c, (cost + more, audit + "K", lines + [(role, text)]))
                    if c != "s":
                        offer(now, c, (cost + more + 1, audit + "R", lines + [(names[c], text)]))
        ways = inserted(now)
    return min((ways[s] for s in ("", "a") if s in ways), key=lambda w: w[:2])


def faulted(rows):
    out, seen = [], set()
    for role, text in rows:
        body = text.rstrip(" \t\n\x0b\x0c\r")
        fault = "b" if not body else "d" if (role, text) in seen else "k" if body[-1] in ".!?" else "t"
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def expected(table, damage=True):
    """The contract's columns of every conversation, in plain Python."""
    chats = {}
    for conv, turn, role, text in table:
        role, text = (" " if x is None else x for x in (role, text))
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        fault = zlib.crc32(key.encode()) % 20 if damage else 9
        rows = chats.setdefault(conv, [])
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        rows += [(turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    out = {}
    for conv, rows in chats.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        faults = faulted([(r, x) for _, r, x in rows])
        cost, audit, lines = by_states(faults)
        known = {t for t, _, _ in rows if t is not None}
        marks = [f for _, _, f in faults]
        pairs = [a[:1] + b[:1] for (a, _, _), (b, _, _) in zip(faults, faults[1:])]
        text = "\n".join(f"{r}:{x}" for r, x in lines)
        out[conv] = (
            max(known) - min(known) + 1 - len(known) if known else 0, marks.count("b"), marks.count("d"),
            marks.count("t"), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
            hashlib.sha256(text.encode()).hexdigest(),
        )
    return out


def got(result):
    streamed = {r.conv_id: r.sha256 for r in conversations.digests(result.pieces).collect()}
    return {
        r.conv_id: (
            *(r[c] for c in COUNTS), r.audit,
            streamed[r.conv_id] if r.repaired is None else hashlib.sha256(r.repaired.encode()).hexdigest(),
        )
        for r in result.conversations.collect()
    }


def test_edits_are_the_cheapest_and_least():
    kinds = [r + f for r, f in itertools.product("uasx", "kdt")]
    shapes = [s for n in range(3) for s in itertools.product(kinds, repeat=n)]
    shapes += random.Random(5).sample(list(itertools.product(kinds, repeat=3)), 40)
    for shape in shapes:
        rows = [(s[0], str(i), s[1]) for i, s in enumerate(shape)]
        found = min(edits("".join(shape), (EMPTY,), (EMPTY, ASSISTANT)), key=lambda e: (e.cost, e.audit))
        assert (found.cost, found.audit) == searched(rows)[:2], shape
        assert by_states(rows)[:2] == searched(rows)[:2], shape


def test_query_matches_plain_python(spark):
    tables = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{tables}/conversations.parquet").collect()
    result = queries.op12_conversation_repair(spark, tables)
    assert {r[0]: tuple(r[1:]) for r in result.collect()} == expected(
        [(r.conv_id, r.turn, r.role, r.text) for r in rows]
    )


SCHEMA = "conv_id long, turn long, role string, text string, damage string, row string, chunk int"


def awkward(seed, n, convs):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", "", None, "user", "assistant"]
    texts = ["", " \n", None, "Yes.", "No!", "cut", "Ünd?", " ", "Yes.", "x" * 3000 + "."]
    return [
        (rng.choice([None, *range(convs)]), rng.choice([None, *range(12)]), rng.choice(roles),
         rng.choice([*texts, f"{k}.", f"{k}!", f"{k}"]), "x", "y", 1)
        for k in range(n)
    ]


@pytest.mark.parametrize("turns", [1, 4, 64])
def test_chunks_nulls_and_repeats(spark, monkeypatch, turns):
    """Few conversations hold all rows, so most go through chunks over several ranges."""
    monkeypatch.setattr(conversations, "CHUNK_TURNS", turns)
    rows = awkward(turns, 300, 4) + awkward(turns + 1, 60, 40)
    rows += rows[:20]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    result = conversations.repair(conversations.damaged(frame))
    assert got(result) == expected([r[:4] for r in rows])
    plain = conversations.repair(frame.filter("conv_id IS NOT NULL"))
    assert got(plain) == expected([r[:4] for r in rows if r[0] is not None], damage=False)


def test_one_repeated_row_and_empty_table(spark, monkeypatch):
    monkeypatch.setattr(conversations, "CHUNK_TURNS", 8)
    rows = [(1, 1, "user", "Same.")] * 150 + [(1, 2, "assistant", "Other.")]
    schema = "conv_id long, turn long, role string, text string"
    result = conversations.repair(spark.createDataFrame(rows, schema))
    assert got(result) == expected(rows, damage=False)
    assert conversations.repair(spark.createDataFrame([], schema)).conversations.count() == 0


def test_dropped_conversations_stay(spark):
    gone = [(c, t) for c in range(40) for t in range(40) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0]
    rows = [(c, t, "user", "Hi.") for c, t in gone[:5]]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    result = got(conversations.repair(conversations.damaged(frame)))
    assert result == expected(rows)
    assert result[gone[0][0]] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_text_ids(spark):
    rows = [("b", 1, "user", "Hi."), ("a", 1, "user", "Hi"), ("a", 2, "user", "So.")]
    frame = spark.createDataFrame(rows, "conv_id string, turn int, role string, text string")
    assert got(conversations.repair(frame.withColumn("extra", F.lit(1)))) == expected(rows, damage=False)
