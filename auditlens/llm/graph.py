"""Connected components of a graph that no task need hold."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditlens.llm.common import materialise


def components(links: DataFrame) -> DataFrame:
    """(node, comp): the smallest node reachable, for every node of the links (a, b).

    Alternating large-star and small-star rounds until the links stay as they
    are; every round is a written table. The least neighbours are written too
    and read as a table of their own, so that the join with them is one of two
    scans and a node with a large part of all links is split by the skew join.
    Links to itself, repeated links and empty tables give no row of their own.
    """
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    links, before = materialise(links, "links"), None
    while True:
        both = links.union(links.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(materialise(least, "least"), "a").where("b > a")
        large = materialise(large.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "large-stars")
        least = materialise(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        small = large.join(least, "a").select(F.explode(F.array(
            F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        links = materialise(small.select("e.*").where("a <> b").distinct(), "links")
        now = links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == before:
            return links.select(F.col("a").alias("node"), F.col("b").alias("comp"))
        before = now


def least_reachable(node: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of the nodes the smallest one reachable over the links between
    positions ``a`` and ``b``; all in memory, for the links of one block."""
    low = node.copy()
    while len(a):
        least = np.minimum(low[a], low[b])
        after = low.copy()
        np.minimum.at(after, a, least)
        np.minimum.at(after, b, least)
        if np.array_equal(after, low):
            break
        low = after
    return low
