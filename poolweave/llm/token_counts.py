"""Token counts through a cache keyed by content and tokenizer digests.

A document's content is normalised (runs of ASCII white space become one space,
which no count depends on) and digested. Counts known for (content digest, tokenizer
digest) are joined; only the distinct contents without one are encoded, and their
counts are appended to the cache. Entries that writers added twice count once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from poolweave.llm import tokens
from poolweave.llm.common import text_blocks, whole_text

CACHE_COLUMNS = "content string, tokenizer string, n_tokens long"


def normalised(text: Column) -> Column:
    """Runs of ASCII white space as one space."""
    return F.regexp_replace(text, r"[\t\n\x0B\f\r][ \t\n\x0B\f\r]*| [ \t\n\x0B\f\r]+", " ")


def tokenizer_digest(name: str) -> str:
    with open(tokens.tokenizer_path(name), "rb") as file:
        return hashlib.sha256(file.read()).hexdigest()


def count_tokens(
    docs: DataFrame, cache_path: str, tokenizer: str = tokens.TOKENIZER
) -> DataFrame:
    """doc_id, n_bytes and n_tokens of every row of ``docs`` (doc_id, text).

    A null text is the empty one: 0 bytes, 0 tokens. Rows that repeat, and rows
    without doc_id, are counted like any other; other columns are ignored. Texts of any
    length are counted whole; an empty table gives an empty one.
    """
    spark = docs.sparkSession
    version = tokenizer_digest(tokenizer)
    spark.createDataFrame([], CACHE_COLUMNS).write.mode("append").parquet(cache_path)

    def known() -> DataFrame:
        cache = spark.read.schema(CACHE_COLUMNS).parquet(cache_path)
        own = cache.filter(F.col("tokenizer") == version)
        return own.groupBy("content").agg(F.min("n_tokens").alias("n_tokens"))

    content = F.sha2(normalised(whole_text()), 256).alias("content")
    misses = (
        docs.select(content, normalised(whole_text()).alias("text"))
        .join(known().select("content"), "content", "left_anti")
        .dropDuplicates(["content"])
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = tokens.word_ids(tokenizer)
        for block in text_blocks(batches, "text"):
            counts = pa.array(words.count(block.column("text")), pa.int64())
            kind = pa.array([version] * block.num_rows, pa.string())
            yield pa.RecordBatch.from_arrays(
                [block.column("content").cast(pa.string()), kind, counts],
                ["content", "tokenizer", "n_tokens"],
            )

    misses.mapInArrow(encode, CACHE_COLUMNS).write.mode("append").parquet(cache_path)
    keyed = docs.select("doc_id", F.octet_length(whole_text()).cast("long").alias("n_bytes"), content)
    return keyed.join(known(), "content", "left").drop("content")
