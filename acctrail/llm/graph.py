"""Connected components of an edge table by Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of ``edges``; root is the component's smallest node.

    Alternates two exact rewritings until nothing changes: each node's larger
    neighbours move to its smallest neighbour, then each node's smaller
    neighbours move to the smallest of them. A group of n nodes ends as n - 1
    edges to its root; the number of rounds grows with the logarithm of n.
    Each round is written to the shared folder, and only its counters come
    to the driver. Null nodes and self-links are ignored.
    """
    def canonical(df):
        return (df.where("a is not null and b is not null and a <> b")
                .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())

    current = stored(canonical(edges.select(F.col(a).alias("a"), F.col(b).alias("b"))), "links")
    now = _sums(current)
    while True:
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = canonical(both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")))
        large = stored(large, "links")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(low.select("a", F.col("m").alias("b"))))
        small = stored(canonical(small), "links")
        # both hold distinct links, so equal numbers and no new one mean equal sets; they are compared once their sums agree
        before, now = now, _sums(small)
        if now == before and small.exceptAll(current).isEmpty():
            break
        current = small
    roots = small.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return small.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def _sums(links: DataFrame) -> tuple:
    """Number of the links, and a checksum that does not depend on their order."""
    return tuple(links.agg(F.count("a"), F.bit_xor(F.xxhash64("a", "b"))).first())


class Forest:
    """Union-find over 0..n-1 for the rows that one task holds."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def union(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        if x == y:
            return False
        if y < x:
            x, y = y, x
        self.parent[y] = x
        return True
