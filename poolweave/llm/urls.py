"""URL filter: host and path rules, and a logistic regression for all other URLs.

The regression works on hashed character n-grams of host and path. It is trained from
a small labelled table, in its dual form: one weight per labelled URL, found by gradient
ascent on the table's Gram matrix, all in SQL functions. The model has a fixed number of
weights, whatever the number of pages, and a page is judged where it is read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 8192
SIZES = (3, 4, 5)  # characters of an n-gram
MAX_LABELLED = 500  # the Gram matrix has this number squared of entries
STEPS = 400
RATE = 4.0
DECAY = 0.0005

#: The words of the labelled table's hosts. No host of the test tables is among them.
ORDINARY = """
library weather museum recipes university gardening travel news software docs school hospital railway theatre
music history science kitchen bakery bicycle camera council archive gallery orchestra football chess sailing
climbing poetry physics chemistry maps hotel island forest village church market bookshop teacher nursery
knitting cycling painting pottery cooking language grammar weekly monthly journal letters reader stories
northern southern western eastern center there other those three thing another nation region station option
""".split()
UNWANTED = """
poker roulette jackpot slots betting gambling wager sportsbook onlinecasino lottowin viagra pharmacy pills4you
steroids tablets porn xxx cams nude escorts adultsonly malware phishing trojan spyware spammer linkfarm scam
tracker tracking adserver popads banners payday loans replica fake torrent crack warez keygen freebies cheapest
""".split()
PATHS = ("/en/12", "/de/77/", "/fr/3.html", "/es/2021", "/about", "/index.html?page=2", "", "/en/40021?utm_source=feed")
_FRONTS = ("www.", "", "m.", "blog.")
_ENDS = (".example.com", ".example.org", ".example.net")


def named_urls(words: list[str]) -> list[str]:
    """URLs of hosts of one word, and of a word and its third neighbour."""
    hosts = [h for k, w in enumerate(words) for h in (w, f"{w}-{words[(k + 3) % len(words)]}")]
    return [
        f"http://{_FRONTS[k % len(_FRONTS)]}{h}{_ENDS[k % len(_ENDS)]}{PATHS[k % len(PATHS)]}" for k, h in enumerate(hosts)
    ]


ALLOWED_URLS, BLOCKED_URLS = named_urls(ORDINARY), named_urls(UNWANTED)


@dataclass(frozen=True)
class Rule:
    """Judges a host and its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


#: The rules of the query.
RULES = (
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
)


def host_of(url: Column) -> Column:
    """From after the first ``://`` up to ``/``, ``?``, ``#`` or end, A-Z in lower case."""
    host = F.coalesce(F.regexp_extract(url, r"(?s)://([^/?#]*)", 1), F.lit(""))
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)://[^/?#]*([^?#]*)", 1), F.lit(""))


def _rule(rules: tuple[Rule, ...], host: Column, path: Column, value) -> Column:
    """``value`` of the longest rule that fits; of equally long ones the first as text."""
    chosen = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (-len(r.text), r.text), reverse=True):
        own = (host == rule.host) | host.endswith("." + rule.host)
        chosen = F.when(own & path.startswith(rule.path), value(rule)).otherwise(chosen)
    return chosen


def ngram_buckets(host: Column, path: Column) -> Column:
    """Buckets of the n-grams of ``^host$`` and of ``^path$``, apart by a salt."""

    def of(text: Column, salt: int, n: int) -> Column:
        letters = F.split(F.concat(F.lit("^"), text, F.lit("$")), "")
        places = F.sequence(F.lit(0), F.size(letters))
        starts = F.filter(places, lambda i: i <= F.size(letters) - n)
        gram = lambda i: F.concat_ws("", *(F.get(letters, i + k) for k in range(n)))
        return F.transform(
            starts, lambda i: F.pmod(F.xxhash64(gram(i), F.lit(salt)), F.lit(BUCKETS))
        )

    return F.when(host == "", F.array().cast("array<bigint>")).otherwise(
        F.concat(*(of(host, 1, n) for n in SIZES), *(of(path, 2, n) for n in SIZES))
    )


def train(labelled: DataFrame) -> list[float]:
    """Weights by bucket, the bias last, from ``labelled`` (url, blocked).

    Rows with a null are left out. At most :data:`MAX_LABELLED` rows; without any, all
    weights are 0. The table is repeatedly multiplied by itself, never by the pages.
    """
    rows = labelled.filter(F.col("url").isNotNull() & F.col("blocked").isNotNull())
    if rows.count() > MAX_LABELLED:
        raise ValueError(f"more than {MAX_LABELLED} labelled URLs")
    # Sorted by content: the order, and so the sums, do not depend on the reading.
    one = rows.agg(
        F.sort_array(
            F.collect_list(
                F.struct(
                    F.col("url"),
                    F.col("blocked").cast("double").alias("y"),
                    F.sort_array(ngram_buckets(host_of(F.col("url")), path_of(F.col("url")))).alias("b"),
                )
            )
        ).alias("rows")
    )
    unit = lambda r: F.lit(1.0) / F.sqrt(F.greatest(F.size(r["b"]), F.lit(1)))
    # A row's share of another's n-grams; each row also has a constant feature of 1.
    features = one.select("rows", F.explode("rows").alias("r")).select(
        "rows", F.col("r"), F.transform("rows", lambda s: F.size(F.array_intersect(F.array_distinct(s["b"]), F.col("r.b"))) * unit(s) * unit(F.col("r")) + 1.0).alias("k")
    )
    gram = features.agg(F.first("rows").alias("rows"), F.sort_array(F.collect_list(F.struct("r.url", "r.y", "k"))).alias("g"))
    zeros = F.transform("rows", lambda _: F.lit(0.0))
    dot = lambda k, a: F.aggregate(F.zip_with(k, a, lambda x, w: x * w), F.lit(0.0), lambda s, x: s + x)
    step = lambda a: F.zip_with(
        F.col("g"),
        a,
        lambda row, w: w * (1 - DECAY)
        + RATE * (row["y"] - 1 / (1 + F.exp(-dot(row["k"], a)))) / F.greatest(F.size("rows"), F.lit(1)),
    )
    fitted = gram.select("rows", F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), zeros, lambda a, _: step(a)).alias("a"))
    alone = fitted.select(F.explode(F.arrays_zip("rows", "a")).alias("z")).select(
        (F.col("z.a") * unit(F.col("z.rows"))).alias("w"), "z.a", F.array_distinct("z.rows.b").alias("b")
    )
    weights = alone.select("w", F.explode("b").alias("bucket")).groupBy("bucket").agg(F.sum("w").alias("w"))
    bias = alone.agg(F.lit(BUCKETS).cast("long").alias("bucket"), F.coalesce(F.sum("a"), F.lit(0.0)).alias("w"))
    model = [0.0] * (BUCKETS + 1)
    for bucket, w in weights.unionAll(bias).collect():  # at most BUCKETS + 1 rows
        model[bucket] = w
    return model


def judge(
    pages: DataFrame, labelled: DataFrame, rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """page_id, host, path, rule, verdict and probability to block of every page.

    A null url, and one without ``://``, has an empty host and path and no n-grams: no
    rule fits, and it is allowed. Repeated rows stay; other columns are ignored. URLs of
    any length are judged whole; an empty table gives an empty one.
    """
    weights = F.split(F.lit(",".join(map(repr, train(labelled)))), ",").cast("array<double>")
    grams = F.array_distinct(F.col("grams"))
    margin = F.aggregate(
        grams, F.lit(0.0), lambda s, b: s + F.get(weights, b.cast("int"))
    ) / F.sqrt(F.greatest(F.size("grams"), F.lit(1))) + F.get(weights, F.lit(BUCKETS))
    parts = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    scored = parts.withColumn("grams", ngram_buckets(F.col("host"), F.col("path")))
    scored = scored.withColumn("blocking", F.when(F.col("host") == "", 0.0).otherwise(1 / (1 + F.exp(-margin))))
    host, path = F.col("host"), F.col("path")
    return scored.select(
        "page_id",
        "host",
        "path",
        _rule(rules, host, path, lambda r: F.lit(r.text)).alias("rule"),
        F.coalesce(
            _rule(rules, host, path, lambda r: F.lit(r.verdict)),
            F.when(F.col("blocking") >= 0.5, "block").otherwise("allow"),
        ).alias("verdict"),
        "blocking",
    )


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The small labelled table that the query learns from."""
    rows = [(u, 0) for u in ALLOWED_URLS] + [(u, 1) for u in BLOCKED_URLS]
    return spark.createDataFrame(rows, "url string, blocked int")
