"""Phrases whose words keep together, from FM-indexes of shards.

Texts are dealt to shards of one language and a few megabytes; a shard's index is
written once and never moves again. Phrases grow by a word at a time: each shard
extends the phrases that are frequent over all shards, by its own index, and the counts
of a phrase are summed over shards. A phrase is only extended to one whose first and last
parts are both frequent, which loses nothing, since a phrase occurs no oftener than its
parts. A phrase is known by the ids of these two parts, so counts are exact and no text
moves before the frequent phrases are known.

What travels is small. The pair of ids is one number, spread by a multiplication that can
be undone; a part of all keys is a range of these numbers, so a shard sends its phrases
sorted, as differences, and each one's count. The answer is which of them are frequent, by
place, and their ranks in the part. Nothing says where a phrase lies in the shard: the
shard finds its phrases again, from the index and all answers so far.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from poolweave.llm.common import text_blocks, text_bytes
from poolweave.llm.fm_index import DEPTH, Index, order_of
from poolweave.llm.packed import pack, pack_rising, pack_text, unpack, unpack_rising, unpack_text
from poolweave.session import materialize, scratch_path

SHARD_BYTES = 4 << 20
HELD_BYTES = 12 << 20  # of texts that wait for their shard to fill
LEAST = 100
TOP = 2000
_SHARDS_PER_TASK = 1 << 11

PART_WORDS = 2_000_000  # words of all texts for each part of the keys; each shard sends a row to each part
WORD_PARTS = 2  # so many parts of phrases are one part of the words, of which a shard has fewer
_CODES = 1 << 16

_SENT = "part int, lang string, shard bigint, n int, keys binary, counts binary"
#: Rows with a shard: places and ranks of its frequent phrases. Others: a key, or a language's words.
_SUMMED = (
    "shard bigint, part int, n int, places binary, ranks binary, lang string, word string, id bigint, a bigint, "
    "first_id bigint, last_id bigint, total bigint"
)


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of the best ``top`` phrases of each language.

    A-Z count as lower case. Texts are cut at ``.,;:!?`` and line ends into pieces, these
    at spaces and tabs into words; phrases of 2 to 5 words that occur ``least`` times in
    pieces of a language are candidates, a missing language is ``und``. ``score`` is the
    least of floor(1000 * a * n / (l * r)) over all cuts; phrases that always occur within
    the same longer candidate are left out. A missing text is empty, repeated rows count
    again, texts of any length are read whole and never cut within a piece; other columns
    are ignored, and an empty table gives an empty one.
    """
    spark = docs.sparkSession
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    name = f"phrase_shards_{scratch_path(spark, 'x').rsplit('-', 1)[1]}"
    schema = "lang string, shard bigint, n bigint, n_words int, words binary, codes binary, counts binary, following binary, shared binary"
    by_shard = ByShard(spark, name)
    try:
        by_shard.write(texts.mapInArrow(_shards, schema), 0)
        return _ranked(by_shard, least, top)
    finally:
        by_shard.forget()


class ByShard:
    """Tables bucketed by shard, which are joined where they lie."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark, self.name, self.tables = spark, name, []
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def write(self, rows: DataFrame, words: int) -> None:
        """The indexes (0), or the answers to phrases of so many words."""
        self.tables.append(f"{self.name}_{words}")
        path = scratch_path(self.spark, "phrase-shards")
        rows.write.bucketBy(self.buckets, "shard").sortBy("shard").option("path", path).saveAsTable(self.tables[-1])

    def write_answers(self, found: DataFrame, words: int) -> None:
        answer = F.struct("part", "n", "places", "ranks")
        dealt = found.filter("shard IS NOT NULL").repartition(self.buckets, "shard")
        self.write(dealt.groupBy("shard").agg(F.collect_list(answer).alias(f"answers_{words}")), words)  # of one shard

    def indexes(self) -> DataFrame:
        return self.spark.table(self.tables[0])

    def joined(self, *columns: str) -> DataFrame:
        """Columns of the indexes with all answers; shards without the last ones have no longer phrases."""
        out = self.indexes().select("shard", *columns)
        for table in self.tables[1:]:
            # Hashed, not sorted: rows of an index are some megabytes each.
            out = out.join(self.spark.table(table).hint("shuffle_hash"), "shard")
        return out

    def forget(self) -> None:
        for table in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")  # the name only, its files stay until the scratch folder goes


def _ranked(by_shard: ByShard, least: int, top: int) -> DataFrame:
    shards = by_shard.indexes()
    n = shards.agg(F.sum("n")).first()[0] or 0
    parts, word_parts = n // PART_WORDS + 1, min(n // (WORD_PARTS * PART_WORDS) + 1, _CODES)

    def summed(sent: DataFrame, work) -> DataFrame:
        by_part = sent.repartition("part").sortWithinPartitions("part")
        return materialize(by_part.mapInArrow(_by_part(work), _SUMMED), "summed-phrases")

    words = shards.select("lang", "words", "codes", "counts", "n_words", "shard").mapInArrow(_sent_words(word_parts), _SENT)
    found = summed(words, _frequent_words(least, word_parts))
    totals = found.filter("total IS NOT NULL").groupBy("lang").agg(F.sum("total").alias("n"))
    # Without other columns: id, a, lang, phrase, last word, counts of first and last parts.
    none = F.array().cast("array<bigint>")
    known = found.filter("word IS NOT NULL").select(
        "id", "a", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), none.alias("firsts"), none.alias("lasts")
    )
    levels, keys = [], []
    for words_now in range(2, DEPTH + 1):
        by_shard.write_answers(found, words_now - 1)
        most = found.agg(F.max("id")).first()[0] or 0
        keys = [*keys, Keys(most, parts)]
        known_shards = by_shard.joined("n", "n_words", "codes", "counts", "following", "shared")
        sent = known_shards.mapInArrow(_sent_phrases(keys, word_parts), _SENT)
        found = summed(sent, _frequent_phrases(least, keys[-1]))
        new = found.filter("first_id IS NOT NULL").select("id", "a", "first_id", "last_id")
        known_parts = known.select(F.col("id").alias("part_id"), F.col("a").alias("part_a"), "lang", "phrase", "last", "firsts", "lasts")
        known = materialize(
            new.join(known_parts.select(F.col("part_id").alias("first_id"), F.col("part_a").alias("first_a"), "lang", "phrase", "firsts"), "first_id")
            .join(known_parts.select(F.col("part_id").alias("last_id"), F.col("part_a").alias("last_a"), "last", "lasts"), "last_id")
            .select(
                "id", "a", "first_id", "last_id", "lang", F.concat_ws(" ", "phrase", "last").alias("phrase"), "last",
                F.concat("firsts", F.array("first_a")).alias("firsts"), F.concat("lasts", F.array("last_a")).alias("lasts"),
            ),
            f"phrases-of-{words_now}",
        )
        levels.append(known)
    candidates = None
    for level, longer in zip(levels, [*levels[1:], None]):
        own = level.select("id", "a", "lang", "phrase", "firsts", "lasts")
        if longer is not None:
            # A longer phrase of equal count contains one that is a word longer.
            within = longer.select(F.col("first_id").alias("id"), "a").unionAll(longer.select(F.col("last_id").alias("id"), "a"))
            own = own.join(within.distinct(), ["id", "a"], "left_anti")
        candidates = own if candidates is None else candidates.unionAll(own)
    scored = candidates.join(totals, "lang").withColumn("cut", F.array_min(F.expr("""
        transform(sequence(1, size(firsts)), k -> named_struct(
          'score', (cast(1000 * a as decimal(20, 0)) * cast(n as decimal(18, 0)))
            div (cast(firsts[k - 1] as decimal(19, 0)) * cast(lasts[size(firsts) - k] as decimal(19, 0))),
          'k', k, 'l', firsts[k - 1], 'r', lasts[size(firsts) - k]))""")))
    rows = scored.select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = rows.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
    columns = ("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
    return materialize(ranked.select(*columns), "collocations")


class Keys:
    """Pairs of ids up to ``most`` as numbers, spread evenly over ``parts`` ranges."""

    def __init__(self, most: int, parts: int) -> None:
        self.width = max(1, most.bit_length())
        if self.width > 32:
            raise ValueError("more than 2**32 frequent phrases of one length")
        self.bits, self.parts = 2 * self.width, parts
        self.mask = (1 << self.bits) - 1
        self.span = self.mask // parts + 1
        self.factor = int(0.6180339887498949 * (1 << self.bits)) & self.mask | 1

    def of(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        pair = first.astype(np.uint64) << np.uint64(self.width) | last.astype(np.uint64)
        return pair * np.uint64(self.factor) & np.uint64(self.mask)

    def ids(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        pair = keys * np.uint64(pow(self.factor, -1, 1 << self.bits)) & np.uint64(self.mask)
        return (pair >> np.uint64(self.width)).astype(np.int64), (pair & np.uint64((1 << self.width) - 1)).astype(np.int64)

    def part_of(self, keys: np.ndarray) -> np.ndarray:
        return (keys // np.uint64(self.span)).astype(np.int64)

    def begin_of(self, part: int) -> np.uint64:
        return np.uint64(part * self.span)

    def ordered(self, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The sorted keys, and which pair each one is."""
        keys = self.of(first, last)
        order = order_of(keys, self.bits)
        return keys[order], order


def _symbols(texts: pa.Array) -> tuple[np.ndarray, list[str]]:
    """The words of all texts as numbers from 1, in their order, with 0 behind each piece."""
    lower = pc.ascii_lower(texts)
    marked = pc.replace_substring_regex(lower, "[.,;:!?\\x0A-\\x0D]+", " . ")
    closed = pc.binary_join_element_wise(marked, pa.scalar(" .", lower.type), pa.scalar("", lower.type))
    words = pc.list_flatten(pc.split_pattern_regex(closed, "[ \t]+")).dictionary_encode()
    order = np.asarray(pc.array_sort_indices(words.dictionary))
    spelled = words.dictionary.take(order).to_pylist()
    # A piece's end is the only "."; the empty word stands before a text's first space.
    border = np.array([w in (".", "") for w in spelled], bool)
    number = np.cumsum(~border)
    number[border] = 0
    number[order] = number.copy()
    text = number[np.asarray(words.indices)].astype(np.int32)
    keep = text > 0
    keep[1:] |= text[:-1] > 0
    return text[keep], [w for w, b in zip(spelled, border) if not b]


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    task = TaskContext.get().partitionId() * _SHARDS_PER_TASK
    held: dict[str, list[pa.Array]] = {}
    size: dict[str, int] = {}
    made = 0

    def shard(lang: str) -> pa.RecordBatch | None:
        nonlocal made
        del size[lang]
        text, words = _symbols(pa.concat_arrays(held.pop(lang)))
        if not words:
            return None
        if made == _SHARDS_PER_TASK:
            raise ValueError("a task reads more text than its shards' numbers allow")
        index = Index.of(text)
        out = {
            "lang": [lang], "shard": pa.array([task + made], pa.int64()), "n": pa.array([len(text)], pa.int64()),
            "n_words": pa.array([len(words)], pa.int32()), "words": [pack_text(words)],
            "codes": [(pd.util.hash_array(np.array(words, object), categorize=False) % _CODES).astype("<u2").tobytes()],
            "counts": [pack(np.diff(index.begin))],
            # As differences, modulo 2**32: only where another word begins they are not small.
            "following": [pack(np.diff(index.following, prepend=np.int32(0)).view(np.uint32))], "shared": [pack(index.shared)],
        }
        made += 1
        del text, words, index
        pa.default_memory_pool().release_unused()
        return pa.RecordBatch.from_pydict(out)

    for block in text_blocks(batches, "text"):
        langs = block.column("lang").dictionary_encode()
        for k, lang in enumerate(langs.dictionary.to_pylist()):
            texts = block.column("text").filter(pc.equal(langs.indices, k)).cast(pa.large_string())
            held.setdefault(lang, []).append(texts)
            size[lang] = size.get(lang, 0) + int(text_bytes(texts)[1][-1])
        while size and (max(size.values()) >= SHARD_BYTES or sum(size.values()) > HELD_BYTES):
            out = shard(max(size, key=size.get))
            if out is not None:
                yield out
    for lang in list(size):
        out = shard(lang)
        if out is not None:
            yield out


def _sent(rows: list[tuple]) -> pa.RecordBatch:
    """Rows (part, lang, shard, n, keys, counts)."""
    kinds = (pa.int32(), pa.string(), pa.int64(), pa.int32(), pa.binary(), pa.binary())
    names = ("part", "lang", "shard", "n", "keys", "counts")
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)


def _groups(part: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Each part of a sorted list with its places."""
    borders = np.flatnonzero(np.diff(part)) + 1
    for a, b in zip([0, *borders.tolist()], [*borders.tolist(), len(part)]):
        if b > a:
            yield int(part[a]), slice(a, b)


def _words_by_part(codes: bytes, word_parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of a shard's words, by part of all words, and the part of each."""
    part = np.frombuffer(codes, "<u2").astype(np.int64) % word_parts
    order = np.argsort(part, kind="stable")
    return order, part[order]


def _sent_words(word_parts: int):
    """The words of each shard by part of all words: their spelling and counts."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                words = np.array(unpack_text(row["words"]), object)
                size = unpack(row["counts"], row["n_words"] + 1)[1:]
                order, part = _words_by_part(row["codes"], word_parts)
                words, size = words[order], size[order]
                yield _sent([
                    (p, row["lang"], row["shard"], own.stop - own.start, pack_text(words[own].tolist()), pack(size[own]))
                    for p, own in _groups(part)
                ])

    return send


def _answered(answers: list[dict], part: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Which phrases of a list sorted by part are frequent, and their ids."""
    places, ids = [], []
    for x in sorted(answers, key=lambda x: x["part"]):
        places.append(unpack_rising(x["places"], x["n"]) + np.searchsorted(part, x["part"]))
        ids.append(_ids(unpack_rising(x["ranks"], x["n"]), x["part"], parts))
    none = [np.zeros(0, np.int64)]
    return np.concatenate(places or none), np.concatenate(ids or none)


def _ids(ranks: np.ndarray, part: int, parts: int) -> np.ndarray:
    return ranks * parts + part + 1


def _sent_phrases(keys: list[Keys], word_parts: int):
    """The phrases of each shard that are a word longer than its frequent ones, by part.

    Keys are those of phrases of 2, 3 words and so on. The shorter phrases are found again
    in their order, since answers name them by it.
    """

    def longest(row: dict) -> tuple[np.ndarray, np.ndarray]:
        begin = np.append(0, np.cumsum(unpack(row["counts"], row["n_words"] + 1)))
        following = np.cumsum(unpack(row["following"], row["n"]).astype(np.uint32), dtype=np.uint32).astype(np.int32)
        index = Index(begin, following, unpack(row["shared"], row["n"]).astype(np.uint8))
        order, part = _words_by_part(row["codes"], word_parts)
        phrases, parts = index.words(), word_parts
        for k, own in enumerate(keys):
            places, ids = _answered(row[f"answers_{k + 1}"], part, parts)
            longer = index.extended(phrases.taken(order[places]))
            numbers, order = own.ordered(ids[longer.without_last], ids[longer.without_first])
            phrases, part, parts = longer.phrases, own.part_of(numbers), own.parts
        return numbers, phrases.size[order]

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                numbers, size = longest(row)
                rows = [
                    (p, None, row["shard"], own.stop - own.start, pack_rising(numbers[own] - keys[-1].begin_of(p)), pack(size[own] - 1))
                    for p, own in _groups(keys[-1].part_of(numbers))
                ]
                if rows:
                    yield _sent(rows)

    return send


def _by_part(work):
    """``work`` on the rows of one part after the other."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if held and held[0]["part"] != row["part"]:
                    yield work(held)
                    held = []
                held.append(row)
        if held:
            yield work(held)

    return read


def _answer(rows: list[dict], frequent: np.ndarray, rank: np.ndarray, keys: list[dict]) -> pa.RecordBatch:
    """To every shard the places and ranks of its frequent phrases, both rising; then the keys."""
    ends = np.cumsum([r["n"] for r in rows])
    out = []
    for r, end in zip(rows, ends):
        own = slice(end - r["n"], end)
        places = np.flatnonzero(frequent[own])
        if len(places):
            out.append({
                "shard": r["shard"], "part": r["part"], "n": len(places),
                "places": pack_rising(places), "ranks": pack_rising(rank[own][places]),
            })
    out += keys
    kinds = {"shard": pa.int64(), "part": pa.int32(), "n": pa.int32(), "places": pa.binary(), "ranks": pa.binary(),
             "lang": pa.string(), "word": pa.string(), **{c: pa.int64() for c in ("id", "a", "first_id", "last_id", "total")}}
    return pa.RecordBatch.from_arrays([pa.array([r.get(c) for r in out], t) for c, t in kinds.items()], list(kinds))


def _frequent_words(least: int, parts: int):
    def work(rows: list[dict]) -> pa.RecordBatch:
        rows.sort(key=lambda r: r["lang"])
        frequent, ranks, keys = [], [], []
        made = 0
        for lang in dict.fromkeys(r["lang"] for r in rows):
            own = [r for r in rows if r["lang"] == lang]
            size = np.concatenate([unpack(r["counts"], r["n"]) for r in own])
            words = pa.array([w for r in own for w in unpack_text(r["keys"])], pa.large_string()).dictionary_encode()
            order = np.asarray(pc.array_sort_indices(words.dictionary))
            code = np.empty(len(order), np.int64)
            code[order] = np.arange(len(order))
            code = code[np.asarray(words.indices)]
            count = np.bincount(code, weights=size).astype(np.int64)
            often = count >= least
            rank = made + np.cumsum(often) - 1
            made += int(often.sum())
            spelled = words.dictionary.take(order[often]).to_pylist()
            ids = _ids(rank[often], rows[0]["part"], parts)
            keys += [{"lang": lang, "word": w, "id": i, "a": n} for w, i, n in zip(spelled, ids.tolist(), count[often].tolist())]
            keys.append({"lang": lang, "total": int(size.sum())})
            frequent.append(often[code])
            ranks.append(rank[code])
        return _answer(rows, np.concatenate(frequent), np.concatenate(ranks), keys)

    return work


def _frequent_phrases(least: int, keys: Keys):
    def work(rows: list[dict]) -> pa.RecordBatch:
        part = rows[0]["part"]
        offset = np.concatenate([unpack_rising(r["keys"], r["n"]) for r in rows])
        size = np.concatenate([unpack(r["counts"], r["n"]) for r in rows]) + 1
        order = order_of(offset, max(1, int(offset.max()).bit_length()))
        new = np.ones(len(offset), bool)
        new[1:] = offset[order[1:]] != offset[order[:-1]]
        heads = np.flatnonzero(new)
        count = np.add.reduceat(size[order], heads)
        often = count >= least
        rank = np.cumsum(often) - 1
        group = np.empty(len(offset), np.int64)
        group[order] = np.cumsum(new) - 1
        first, last = keys.ids(offset[order[heads][often]].astype(np.uint64) + keys.begin_of(part))
        ids = _ids(rank[often], part, keys.parts)
        found = [
            {"id": i, "a": n, "first_id": p, "last_id": s}
            for i, n, p, s in zip(ids.tolist(), count[often].tolist(), first.tolist(), last.tolist())
        ]
        return _answer(rows, often[group], rank[group], found)

    return work
