"""Connected components of a graph given by its links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from poolweave.session import materialize


def components(links: DataFrame) -> DataFrame:
    """node and component (its smallest node) of every node of ``links`` (a, b).

    Links to smaller nodes are rewired to ever smaller ones (alternating stars) until
    nothing changes, in a number of rounds that grows with the logarithm of the longest
    path. A round's minima are written before they are joined, so that the join deals
    out the links of a hub.
    """
    edges = materialize(
        links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "links",
    )
    state = None
    while True:
        # Every larger neighbour of a node is linked to the node's smallest neighbour.
        edges = _rewired(edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), larger=True)
        # Every smaller neighbour of a node, and the node, to the smallest of them.
        edges = _rewired(edges, larger=False)
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    roots = edges.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(roots)


def _rewired(edges: DataFrame, larger: bool) -> DataFrame:
    least = edges.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
    joined = edges.join(materialize(least, "least-neighbours"), "a")
    if larger:
        kept = joined.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        kept = joined.select(F.col("b").alias("a"), F.col("least").alias("b")).unionAll(
            joined.select("a", F.col("least").alias("b"))
        )
    return materialize(kept.filter("a > b").distinct(), "rewired")
