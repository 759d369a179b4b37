"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of links(a, b); component is the smallest node reachable.

    Rounds go on until one changes nothing, which takes as many as the logarithm of the longest path or so. Each is two
    groupings and two joins on Spark and is written to the shared folder, so lineage stays
    short; only a count and a checksum reach the driver. A hub's edges meet its minimum in a join whose one
    side has one row per node, which adaptive execution can split.
    Nulls in a or b and self-links are ignored; repeated links do no harm; an empty table gives an empty one.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = materialise(edges, "links")
    before, settled = _signature(edges), False
    while before[0] and not settled:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("x"), F.least("u", "m").alias("m"))
        large = both.join(least, F.col("u") == F.col("x")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("x"), "m")
        small = large.join(least, F.col("u") == F.col("x")).select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        edges = materialise(small.where("u <> v").distinct(), "links")
        before, settled = (now := _signature(edges)), now == before
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(edges.select("v", "v").distinct())


class Forest:
    """Union-find over 0..n-1 for the links inside one block: keeps only links that join two trees."""

    def __init__(self, n: int):
        self.label = np.arange(n)
        self.kept: list[tuple[int, int]] = []

    def link(self, i: int, others: np.ndarray) -> None:
        """Link i with each of others, which are indices."""
        if not len(others):
            return
        labels, first = np.unique(self.label[others], return_index=True)
        new = labels != self.label[i]
        if new.any():
            self.kept += [(i, int(others[j])) for j in first[new]]
            self.label[np.isin(self.label, labels[new])] = self.label[i]
