"""Connected components of a graph given as edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import stash


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (long a, long b): the least node reachable from it.

    Alternates large-star and small-star steps: every node hands its larger neighbours, then its smaller ones, to the
    least one it knows. Edges become stars in a number of rounds that grows with the logarithm of the longest path. The
    least neighbour is an aggregate with partial sums and is joined back to the edges, so that a node with a third of all
    edges is split by the skew join. Each round is written to the shared folder.
    """
    now = stash(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        # both directions; each node hands on its larger neighbours, and stays linked to the least itself
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min(F.least("a", "b")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # small star: edges lead from the larger to the smaller node
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        handed = large.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = stash(handed.union(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct(), "edges")
        state = now.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first()
        if state == before:
            break
        before = state
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
