"""The pipeline's stages one by one, and the queries against their SQL."""

import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from poolweave import llm
from poolweave.llm import packing

from .test_tokens import library

TABLES = "/root/testdata/sf0.001"
TWO = ("documents", "embeddings")


@pytest.mark.parametrize("name", sorted(llm.ORACLES))
def test_query_agrees_with_its_sql(spark, name):
    connection = duckdb.connect()
    for table in TWO:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{TABLES}/{table}.parquet'")
    got = llm.QUERIES[name](spark, TABLES)
    answer = connection.execute(llm.ORACLES[name])
    order = [c[0] for c in answer.description]
    assert sorted(order) == sorted(got.columns)
    expected = sorted(map(tuple, answer.fetchall()))
    assert sorted(tuple(r[c] for c in order) for r in got.collect()) == expected


def test_all_are_registered():
    names = entry.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
    assert "pipeline" in names
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_copies", "benchmark", "secrets", "packing"]


def test_stages(spark, tmp_path):
    """Every stage keeps what it should of the stage before it."""
    documents = spark.read.parquet(f"{TABLES}/documents.parquet").withColumn("component_id", F.lit("clash"))
    item = spark.read.parquet(f"{TABLES}/benchmark.parquet").first()
    key = "0123456789abcdef01234567"
    clean = documents.filter("length(text) > 800").first().text
    planted = [
        (10**6, "@@@ ### " * 200), (10**6 + 1, clean[: len(clean) // 2] + f" token={key} " + clean[len(clean) // 2 :]),
        (10**6 + 2, clean[:400] + " " + item.text + " " + clean[400:]), (10**6 + 3, None), (None, clean),
    ]
    extra = spark.createDataFrame(planted, "doc_id long, text string")
    docs = documents.unionByName(extra, allowMissingColumns=True)
    kept = {}
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = f"{tmp_path}/{number}"
        stage(spark, docs, TABLES).write.parquet(path)
        after = spark.read.parquet(path)
        if name != "packing":
            assert after.columns == docs.columns
            kept[name] = {r.doc_id: r.text for r in after.collect()}
            assert set(kept[name]) <= {r.doc_id for r in docs.collect()}
        docs_before, docs = docs, after
    assert 10**6 not in kept["quality"] and 10**6 + 1 in kept["quality"] and None in kept["quality"]
    groups = len(kept["quality"]) - len(kept["near_copies"])
    assert groups > 0
    assert 10**6 + 2 not in kept["benchmark"]
    assert all(key not in (t or "") for t in kept["secrets"].values())
    assert set(kept["secrets"]) == set(kept["benchmark"])
    rows = docs.collect()
    texts = {r.doc_id: r.text for r in docs_before.filter("doc_id IS NOT NULL").collect()}
    for doc_id, ids in zip(texts, library(texts.values())):
        pieces = sorted((r for r in rows if r.doc_id == doc_id), key=lambda r: r.start)
        assert sum(r.length for r in pieces) == len(ids) + 1
    assert packing.END_ID == 1 and zlib.crc32(b"") == 0


def test_run_on_empty_tables(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{TABLES}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
