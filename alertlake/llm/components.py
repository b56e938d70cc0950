"""Connected components by alternating large and small stars, and spanning links of a block."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alertlake.llm.common import forget, save


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (columns a, b; whole numbers).

    ``component`` is the smallest node reachable.  Every round points each node's larger
    neighbours at its smallest one (large star), then its smaller ones (small star), until
    nothing changes; rounds grow with the logarithm of the longest path.  Each round is a
    written table, so a lost executor costs one round at most."""
    stars = save(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                 .distinct())
    before = None
    while True:
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.where("v > u").join(least, "u").where("v <> m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(
            F.explode(F.array(F.struct("u", F.col("m").alias("v")),
                              F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        new = save(small.select("e.*").where("u <> v").distinct())
        now = new.agg(F.count(F.lit(1)), F.sum(F.hash("u", "v").cast("long"))).first()
        forget(stars)
        stars = new
        if now == before:
            break
        before = now
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


class Forest:
    """Grows a spanning forest over the nodes 0..n-1 of a block of links.

    ``add`` takes one node and all its partners, and returns those partners that it joins to
    the node's tree for the first time; all other links add nothing to the components.  So a
    block of n nodes gives less than n links, however many pairs are linked."""

    def __init__(self, n: int):
        self.tree = np.arange(n)

    def add(self, node: int, partners: np.ndarray) -> np.ndarray:
        trees = self.tree[partners]
        own = self.tree[node]
        other = trees != own
        if not other.any():
            return partners[:0]
        names, first = np.unique(trees[other], return_index=True)
        self.tree[np.isin(self.tree, names)] = own
        return partners[other][first]
