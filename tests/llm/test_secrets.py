"""Secret scans against positions found by Python's regular expressions."""

import hashlib
import re

from pyspark.sql import functions as F

from poolweave.llm import secrets
from poolweave.session import scratch_path


def brute(text):
    text = text or ""
    found = []
    for k, rule in enumerate(secrets.RULES):
        for m in re.finditer(rule.pattern, text, re.ASCII):
            if len(m[rule.group]) >= rule.min_length:
                found.append((m.start(), k, f"{rule.kind}:{m.start()}:{m.end()}"))
    return ",".join(x[2] for x in sorted(found))


def versions(docs):
    return docs.select(F.col("doc_id").alias("path"), F.lit(0).alias("version"), "text", *docs.columns[5:])


KEY = "0123456789abcdef01234567"
CASES = [
    f"token = \"{KEY}\"", "token=ab", "token=token: abcdefgh", "PASSWORD:  'hunter22'", "password = short",
    "AKIA" + "A" * 16, "AKIAAKIA" + "B" * 10, f"é✓ {KEY}{KEY} {KEY}x", "api_key=abcdef,apikey:'abcdefg'", KEY[:23],
    "secret= \"x\" secret=abcdefg", "aaaaaaaaaaaaaaaaaaaaaaaaaaaa api-key", None, "",
]


def test_spans(spark, make_docs):
    found = secrets.scan_versions(versions(make_docs(CASES)), scratch_path(spark, "ledger"))
    rows = {r.path: r for r in found.collect()}
    for k, text in enumerate(CASES):
        assert rows[k].spans == brute(text), text
        assert rows[k].n_hex == brute(text).count("hex:")


def test_awkward_rows(spark, awkward, awkward_rows, nothing):
    found = secrets.scan_versions(versions(awkward), scratch_path(spark, "ledger")).collect()
    assert len(found) == len(awkward_rows)
    texts = {r[0]: r[1] for r in awkward_rows}
    assert all(r.spans == brute(texts[r.path]) for r in found)
    assert secrets.scan_versions(versions(nothing), scratch_path(spark, "ledger")).count() == 0


def test_only_unseen_blobs_are_scanned(spark, make_docs):
    ledger = scratch_path(spark, "ledger")
    first = make_docs([CASES[0], CASES[0], "nothing"])
    secrets.scan_versions(versions(first), ledger)
    assert spark.read.parquet(ledger).count() == 2
    # A ledger entry is believed: a changed one comes back for a known blob.
    again = secrets.scan_versions(versions(make_docs([CASES[0], CASES[5]])), ledger)
    assert spark.read.parquet(ledger).count() == 3
    assert {r.path: r.n_access for r in again.collect()} == {0: 0, 1: 1}
    # Other rules have other versions.
    assert spark.read.parquet(ledger).select("rules").distinct().count() == 1
    assert secrets.rules_version(secrets.RULES[:1]) != secrets.rules_version()


def test_many_secrets_in_one_text(spark, make_docs):
    text = " ".join(f"token={k:08d}" for k in range(20_000))
    (row,) = secrets.scan_versions(versions(make_docs([text])), scratch_path(spark, "ledger")).collect()
    assert row.n_assign == 20_000
    assert hashlib.sha256(row.spans.encode()).digest() == hashlib.sha256(brute(text).encode()).digest()


def test_redaction(spark, awkward, make_docs):
    docs = make_docs(CASES)
    cleaned = {r.doc_id: r.text for r in secrets.redact(docs, scratch_path(spark, "ledger")).collect()}
    for k, text in enumerate(CASES):
        spans = [tuple(map(int, s.split(":")[1:])) for s in brute(text).split(",") if s]
        out, at = "", 0
        for start, end in spans:
            if start > at or not out and start == at:
                out += text[at:start] + secrets.MASK
            at = max(at, end)
        expected = out + text[at:] if spans else text
        assert cleaned[k].replace(secrets.MASK * 2, secrets.MASK) == expected if text else cleaned[k] == text
        if text:
            assert not brute(cleaned[k])
    kept = secrets.redact(awkward, scratch_path(spark, "ledger"))
    assert kept.columns == awkward.columns
    assert kept.count() == awkward.count()


def test_entries_written_twice_count_once(spark, make_docs):
    ledger = scratch_path(spark, "ledger")
    versions = make_docs(["token = abcdef1", "plain", "token = abcdef1"]).selectExpr("doc_id AS path", "0 AS version", "text")
    once = sorted(map(str, secrets.scan_versions(versions, ledger).collect()))
    for _ in range(2):
        spark.read.parquet(ledger).write.mode("append").parquet(ledger + "-twice")
    assert sorted(map(str, secrets.scan_versions(versions, ledger + "-twice").collect())) == once
