"""Secret scans through an incremental ledger of content-addressed blobs.

Every historical version of every path is addressed by the digest of its content. A
ledger lists what was found for each (blob, rule version); only blobs without an entry
for the present rules are scanned, each once however many paths and versions have it,
and the ledger's findings are joined back to all of them. All steps are SQL functions.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from poolweave.llm.common import whole_text
from poolweave.session import materialize


@dataclass(frozen=True)
class Rule:
    """A kind of secret: what matches, and how long which group must be."""

    kind: str
    pattern: str
    group: int
    min_length: int


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(map(_either_case, ("password", "passwd", "secret", "token", "api_?key")))
#: The three kinds in their order.
RULES = (
    Rule("assign", rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
)
#: What a text must hold for any match to count: cheap to look for.
_LEAST = (RULES[0].pattern, r"AKIA[A-Z0-9]{16}", r"[0-9a-f]{24}")

MASK = "[secret]"
_BLOB, _STARTS, _ENDS = "__blob", "__starts", "__ends"
LEDGER_COLUMNS = "blob string, rules string, spans string, n_assign long, n_access long, n_hex long"


def rules_version(rules: tuple[Rule, ...] = RULES) -> str:
    return hashlib.sha256(repr(rules).encode()).hexdigest()


def _matches(text: Column, number: int, rule: Rule, least: str) -> Column:
    """The rule's matches as lengths: of the gap before, the match, the tested group."""
    lengths = lambda items: F.transform(items, lambda x: F.length(x).cast("long"))
    every = lambda group: F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(group))
    return F.when(
        text.rlike(least),
        F.struct(
            F.lit(number).alias("kind"),
            F.arrays_zip(
                lengths(F.split(text, rule.pattern, -1)).alias("gap"),
                lengths(every(0)).alias("length"),
                lengths(every(rule.group)).alias("tested"),
            ).alias("matches"),
        ),
    )


def find_secrets(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per row of ``blobs`` (blob, text): spans as text, count of each kind.

    A span is kind:start:end in code points, end exclusive; spans are ordered by start,
    then kind as listed, and joined by commas.
    """
    text = F.col("text")
    found = F.array_compact(
        F.array(*(_matches(text, k, r, p) for k, (r, p) in enumerate(zip(rules, _LEAST))))
    )
    one = blobs.select("blob", F.explode_outer(found).alias("found")).select(
        "blob", F.col("found.kind").alias("kind"), F.posexplode_outer("found.matches")
    )
    so_far = Window.partitionBy("blob", "kind").orderBy("pos")
    # The gap after the last match has no length: it comes last and ends nothing.
    end = F.sum(F.col("col.gap") + F.coalesce("col.length", F.lit(0))).over(so_far)
    least = F.element_at(F.array(*(F.lit(r.min_length) for r in rules)), F.col("kind") + 1)
    name = F.element_at(F.array(*(F.lit(r.kind) for r in rules)), F.col("kind") + 1)
    span = F.struct(
        (F.col("end") - F.col("col.length")).alias("start"),
        "kind",
        F.concat_ws(":", name, F.col("end") - F.col("col.length"), F.col("end")).alias("text"),
    )
    spans = one.withColumn("end", end).select(
        "blob", "kind", F.when(F.col("col.tested") >= least, span).alias("span")
    )
    count = lambda k: F.count(F.when(F.col("kind") == k, F.col("span")))
    return (
        spans.groupBy("blob")
        .agg(
            F.sort_array(F.collect_list("span")).alias("spans"),
            *(count(k).alias(f"n_{r.kind}") for k, r in enumerate(rules)),
        )
        .withColumn("spans", F.array_join("spans.text", ","))
    )


def scan_versions(versions: DataFrame, ledger_path: str) -> DataFrame:
    """The rows of ``versions`` (path, version, text) with their blob's findings.

    Returns path, version, blob, spans, n_assign, n_access, n_hex. A null text is the
    empty one and has no finding. Rows that repeat stay, rows without a path too; other
    columns are ignored. Texts of any length are scanned whole; an empty table gives an
    empty one. Entries that writers added twice count once.
    """
    spark = versions.sparkSession
    version = rules_version()
    spark.createDataFrame([], LEDGER_COLUMNS).write.mode("append").parquet(ledger_path)

    def ledger() -> DataFrame:
        entries = spark.read.schema(LEDGER_COLUMNS).parquet(ledger_path)
        own = entries.filter(F.col("rules") == version).drop("rules")
        # Entries of one blob are alike, whoever wrote them.
        return own.groupBy("blob").agg(*(F.min(c).alias(c) for c in own.columns if c != "blob"))

    blob = F.sha2(whole_text(), 256).alias("blob")
    unseen = (
        versions.select(blob, whole_text().alias("text"))
        .join(ledger().select("blob"), "blob", "left_anti")
        .dropDuplicates(["blob"])
    )
    entries = find_secrets(unseen).withColumn("rules", F.lit(version))
    entries.select(
        *(c.split()[0] for c in LEDGER_COLUMNS.split(", "))
    ).write.mode("append").parquet(ledger_path)
    return versions.select("path", "version", blob).join(ledger(), "blob", "left")


def redact(docs: DataFrame, ledger_path: str, mask: str = MASK) -> DataFrame:
    """``docs`` (text, and any other columns) with each stretch of secrets as one mask.

    All rows and columns stay; a text without finding is unchanged, a null one as well.
    Texts of any length are cleaned whole; an empty table gives an empty one.
    """
    blob = F.sha2(whole_text(), 256)
    versions = docs.select(F.lit(None).cast("string").alias("path"), F.lit(0).alias("version"), "text")
    found = scan_versions(versions, ledger_path).filter(F.col("spans") != "")
    spans = F.transform(F.split("spans", ","), lambda x: F.split(x, ":"))
    edge = lambda k: F.transform(spans, lambda x: x[k].cast("int"))
    found = found.groupBy(F.col("blob").alias(_BLOB)).agg(F.first("spans").alias("spans"))
    edges = materialize(found.select(_BLOB, edge(1).alias(_STARTS), edge(2).alias(_ENDS)), "secret-spans")
    letters = F.split("text", "")
    # The text before a span begins where the spans before it have ended.
    ended = lambda k: F.coalesce(F.array_max(F.slice(_ENDS, 1, k)), F.lit(0))
    before = lambda start, k: F.when(
        (start > ended(k)) | (k == 0),
        F.array_join(F.slice(letters, ended(k) + 1, F.greatest(start - ended(k), F.lit(0))), ""),
    )
    last = F.array_max(_ENDS)
    rest = F.array_join(F.slice(letters, last + 1, F.greatest(F.length("text") - last, F.lit(0))), "")
    parts = F.array_compact(F.transform(_STARTS, before))
    cleaned = F.concat(F.array_join(parts, mask), F.lit(mask), rest)
    joined = docs.withColumn(_BLOB, blob).join(edges, _BLOB, "left")
    return joined.withColumn("text", F.when(F.col(_STARTS).isNotNull(), cleaned).otherwise(F.col("text"))).select(
        *(f"`{c}`" for c in docs.columns)
    )
