"""From raw documents to packed sequences: five stages over whole tables.

Each stage takes ``(spark, docs, sf_dir)`` and works on all documents that the stage
before kept. A stage's result is written as Parquet and reread as the next one's
documents. All stages but the last return the columns of ``documents``, extra ones
included; a null text is judged as the empty text, rows that repeat share their fate,
and rows without doc_id, which cannot be told apart, are kept. An empty table gives an
empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from poolweave.llm import decontaminate, jaccard, packing, quality, secrets
from poolweave.llm.common import table
from poolweave.session import materialize, scratch_path

#: Near copies here: five-word shingles, similarity 0.8.
NEAR_COPIES = jaccard.Spec(words=5, num=80, den=100)
_KEY = "__stage_doc_id"


def _keyed(decisions: DataFrame, *columns: Column | str) -> DataFrame:
    """Decisions under a name that no column of the documents has."""
    return decisions.select(F.col("doc_id").alias(_KEY), *columns)


def _without(docs: DataFrame, decisions: DataFrame) -> DataFrame:
    gone = materialize(_keyed(decisions).filter(F.col(_KEY).isNotNull()).distinct(), "stage-rejects")
    return docs.join(gone, docs["doc_id"] == gone[_KEY], "left_anti")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject; where it can learn nothing, all."""
    judged = quality.score_documents(docs, table(spark, sf_dir, "labels"))
    rejected = judged.filter((F.col("predicted") == 0) & F.col("trained"))
    return _without(docs, rejected)


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one that names it."""
    groups = jaccard.similar_sets(docs, NEAR_COPIES)
    return _without(docs, groups.filter(F.col("component_id") != F.col("doc_id")))


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return _without(docs, decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark")))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with every secret cut out of the text, and their length counted again."""
    cleaned = secrets.redact(docs, scratch_path(spark, "secret-ledger"))
    if "n_chars" not in docs.columns:
        return cleaned
    kind = docs.schema["n_chars"].dataType
    return cleaned.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All texts as pieces of sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality", quality_stage),
    ("near_copies", near_copy_stage),
    ("benchmark", benchmark_stage),
    ("secrets", secret_stage),
    ("packing", packing_stage),
]

#: Learned scores and token ids are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
