"""The queries of this subpackage, and the SQL they must agree with where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from poolweave.llm import collocations, conversations, decontaminate, jaccard, language, near_vectors, packing, quality, secrets, suffixes, token_counts, topk, urls
from poolweave.llm.common import table
from poolweave.session import scratch_path

MAX_TOKENS = 2048


def op1_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document through a new ledger; the document is the path."""
    documents = table(spark, sf_dir, "documents")
    versions = documents.select(F.col("doc_id").alias("path"), F.lit(0).alias("version"), "text")
    found = secrets.scan_versions(versions, scratch_path(spark, "secret-ledger"))
    return found.select(
        F.col("path").alias("doc_id"),
        "n_assign",
        "n_access",
        "n_hex",
        F.sha2("spans", 256).alias("base_sha256"),  # the method adds no span of its own
        "spans",
    )


def _secret_sql() -> str:
    kinds = " UNION ALL ".join(
        f"""SELECT doc_id, {k} AS k, '{r.kind}' AS kind, {r.min_length} AS least,
        regexp_extract_all(body, '{p}') AS hits, regexp_extract_all(body, '{p}', {r.group}) AS tested,
        string_split_regex(body, '{p}') AS gaps FROM bodies"""
        for k, r in enumerate(secrets.RULES)
        for p in [r.pattern.replace("'", "''")]
    )
    return f"""
WITH bodies AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
kinds AS ({kinds}),
each_hit AS (SELECT doc_id, k, kind, least, hits, tested, gaps, unnest(range(1, len(hits) + 1)) AS i
  FROM kinds),
spans AS (SELECT doc_id, k, kind, length(hits[i]) AS size,
  CAST(list_sum(list_transform(gaps[1:i], lambda x: length(x)))
    + coalesce(list_sum(list_transform(hits[1:i-1], lambda x: length(x))), 0) AS BIGINT) AS first
  FROM each_hit WHERE length(tested[i]) >= least),
texts AS (SELECT doc_id,
  string_agg(kind || ':' || first || ':' || (first + size), ',' ORDER BY first, k) AS spans,
  count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access,
  count(*) FILTER (k = 2) AS n_hex FROM spans GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
  coalesce(n_hex, 0) AS n_hex, sha256(coalesce(spans, '')) AS base_sha256,
  coalesce(spans, '') AS spans
FROM documents d LEFT JOIN texts t ON t.doc_id = d.doc_id
"""


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose three-word shingles agree by nine tenths."""
    return jaccard.similar_sets(table(spark, sf_dir, "documents"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learned from the labels that are not held out."""
    return quality.score_documents(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item or a paraphrase of one."""
    return decontaminate.contaminated(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op5_retrieval_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in sequences of at most 2048 ids, next to its lexical neighbours."""
    return packing.pack(table(spark, sf_dir, "documents"))


def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best other vectors of every vector whose id is divisible by 50."""
    return topk.top_k(table(spark, sf_dir, "embeddings"))


_TOP_K_SQL = """
WITH vectors AS (SELECT vec_id,
  list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
  CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM vectors q JOIN vectors c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
ranked AS (SELECT query_id, vec_id, score, CAST(row_number() OVER (
  PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM pairs)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules and the regression's verdict for the url of every page."""
    return urls.judge(table(spark, sf_dir, "pages"), urls.labelled_urls(spark))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document through a new cache."""
    counts = token_counts.count_tokens(
        table(spark, sf_dir, "documents"), scratch_path(spark, "token-cache")
    )
    return counts.withColumn("over_limit", F.col("n_tokens") > MAX_TOKENS)


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document keeps without strings that a smaller id has."""
    return suffixes.remove_repeats(table(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the rows that are not held out."""
    return language.identify(table(spark, sf_dir, "documents"))


def op11_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors of cosine 0.95 or more."""
    return near_vectors.near_vectors(table(spark, sf_dir, "embeddings"))


_NEAR_VECTORS_SQL = """
WITH RECURSIVE vectors AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM vectors a JOIN vectors b
  ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.95),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
degree AS (SELECT a, count(*) AS n_links FROM links GROUP BY a)
SELECT e.vec_id, coalesce(n_links, 0) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN least l ON l.a = e.vec_id LEFT JOIN degree d ON d.a = e.vec_id
"""


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit of the cheapest edits that repair every damaged conversation."""
    result = conversations.repair(conversations.damaged(table(spark, sf_dir, "conversations")))
    streamed = conversations.digests(result.pieces).select(F.col("conv_id").alias("d_conv"), "sha256")
    audits = result.conversations.join(streamed, F.col("conv_id").eqNullSafe(F.col("d_conv")), "left")
    digest = F.coalesce(F.sha2("repaired", 256), "sha256")
    columns = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    return audits.select(*columns, digest.alias("repaired_sha256"))


def op13_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best 2000 phrases of two to five words of each language."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


_PHRASES_SQL = """
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(
    coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
lists AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[ \\t]+'), lambda x: x <> '') AS w FROM pieces),
grams AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2),
    lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM lists, range(1, 6) AS lengths(k) WHERE len(w) >= k),
f AS (SELECT lang, k, phrase, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= 100),
totals AS (SELECT lang, sum(len(w)) AS n FROM lists GROUP BY lang),
candidates AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE k >= 2),
within AS (SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS longer
  FROM candidates, range(1, 6) AS starts(i), range(2, 5) AS lengths(m) WHERE m < k AND i + m - 1 <= k GROUP BY ALL),
cuts AS (SELECT c.lang, c.phrase, c.a, l.a AS l, r.a AS r, n, cut,
    (1000::HUGEINT * c.a * n::HUGEINT) // (l.a::HUGEINT * r.a) AS score
  FROM candidates c, range(1, 5) AS places(cut), f l, f r, totals t
  WHERE cut < c.k AND l.lang = c.lang AND l.phrase = array_to_string(w[1:cut], ' ')
    AND r.lang = c.lang AND r.phrase = array_to_string(w[cut + 1:], ' ') AND t.lang = c.lang),
least AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
kept AS (SELECT s.* FROM least s LEFT JOIN within v ON v.lang = s.lang AND v.phrase = s.phrase
  WHERE v.longer IS NULL OR 100 * v.longer < 100 * s.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked WHERE rank <= 2000
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_secret_scans, op2_ngram_jaccard, op3_quality_classifier, op4_benchmark_decontamination, op5_retrieval_packing, op6_exact_top_k, op7_url_filters, op8_token_counts, op9_suffix_dedup, op10_language_id, op11_embedding_near_dedup, op12_conversation_repair, op13_phrase_mining)
}
ORACLES: dict[str, str] = {"op1_secret_scans": _secret_sql(), "op6_exact_top_k": _TOP_K_SQL, "op11_embedding_near_dedup": _NEAR_VECTORS_SQL, "op13_phrase_mining": _PHRASES_SQL}
