"""Connected components of an edge table by large-star and small-star rounds
(Kiveris et al., "Connected Components in MapReduce and Beyond"): each round is
an aggregate and a join, so a node with very many neighbours is never gathered
in one place, and the rounds grow with the logarithm of the longest path."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlens.llm.common import saved


def _both(e: DataFrame) -> DataFrame:
    return e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _state(e: DataFrame):
    r = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_000_007)).first()
    return r[0], r[1]


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node with an edge; root is the smallest node of
    its component. ``edges``: u, v of one orderable type; loops, repeats and
    either direction are fine; no edges give no rows."""
    e = saved(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    state = _state(e)
    while state[0]:
        both = _both(e)
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v")
        e = saved(small.distinct(), "edges")
        now = _state(e)
        if now == state:
            break
        state = now
    roots = e.select("v").distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots.select(F.col("v").alias("node"), F.col("v").alias("root")))
