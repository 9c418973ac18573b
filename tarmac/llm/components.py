"""Connected components of an edge table, by alternating star contractions.

Every round hangs each node's neighbours on the smallest one known, in both directions, until nothing
changes; the number of rounds grows with the logarithm of the longest chain. A node's neighbours
are never gathered: only their minimum is, and a join carries it back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import stored


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def _hang(edges: DataFrame, larger: bool) -> DataFrame:
    """Link every neighbour of u (the larger ones, or the smaller ones and u) to u's smallest."""
    if larger:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges
    lowest = both.groupBy("u").agg(F.min("v").alias("low"))
    lowest = lowest.select(F.col("u").alias("node"), F.least("u", "low").alias("low"))
    hung = both.join(lowest, F.col("u") == F.col("node"))
    if larger:
        return hung.filter("v > u").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()
    own = lowest.select(F.col("node").alias("u"), F.col("low").alias("v"))
    out = hung.select(F.col("v").alias("u"), F.col("low").alias("v")).unionByName(own)
    return out.filter("u > v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every node of the edges (a, b); the component is its smallest id.

    Loops and repeated edges change nothing; edges with a null end are ignored.
    """
    stars = stored(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .filter("a is not null and b is not null and u > v")
        .distinct(),
        "components",
    )
    before = _fingerprint(stars)
    while before[0]:
        stars = stored(_hang(_hang(stars, True), False), "components")
        after = _fingerprint(stars)
        if after == before:
            break
        before = after
    # At the fixed point every node but the smallest has one edge, to the smallest.
    found = stars.select(F.col("u").alias("id"), F.col("v").alias("component"))
    roots = stars.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return found.unionByName(roots)
