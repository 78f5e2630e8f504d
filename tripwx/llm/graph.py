"""Connected components by alternating large and small stars.

Each round every vertex hands its larger neighbours, then its smaller ones,
to the least vertex around it, until all edges are stars around the least
vertex of their component.  A round is two shuffles of the edges; the
number of rounds grows with the logarithm of a component's size.  Rounds are
cut to the shared folder.  Minima are pre-aggregated, and the joins back are
plain equi-joins that adaptive execution splits at a hub.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwx.llm.store import cut


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every vertex of ``edges`` (a, b; any orderable
    type) but those that name their component; no edges, no rows."""
    e = edges.filter(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    e = cut(e, "edges")
    before = _mark(e)
    while before[0]:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter(F.col("a") != F.col("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.filter(F.col("a") != F.col("b")).unionByName(least.select("a", F.col("m").alias("b"))).distinct()
        e = cut(small, "stars")
        after = _mark(e)
        if after == before:
            break
        before = after
    return e.select(F.col("a").alias("node"), F.col("b").alias("component"))
