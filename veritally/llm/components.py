"""Connected components of links, by alternating large and small stars over stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritally.llm.common import Scratch


def smallest(edges: DataFrame) -> DataFrame:
    """(node, least): the smaller of a node and its smallest neighbour.

    Grouping by one expression more than the joins use lets adaptive execution split the rows of a
    hub in those joins; the aggregate itself combines before its shuffle.
    """
    grouped = edges.groupBy("u", F.pmod(F.col("u"), F.lit(2)).alias("_half")).agg(F.min("v").alias("least"))
    return grouped.select(F.col("u").alias("node"), F.least("u", "least").alias("least"))


def hooked(edges: DataFrame) -> DataFrame:
    return edges.join(smallest(edges), F.col("u") == F.col("node"))


def components(links: DataFrame, scratch: Scratch, most_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b) that is not its component's smallest node.

    Loops and repeated links are allowed. Stops when a round changes nothing.
    """
    edges = links.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = scratch.table(edges.distinct())

    def mark(df):
        return df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    seen = mark(edges)
    for _ in range(most_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = hooked(both).filter("v > u").select(F.col("v").alias("u"), F.col("least").alias("v"))
        large = scratch.table(large.distinct())
        found = hooked(large)
        # A node and all smaller neighbours point at the least of them.
        small = found.filter("v != least").select(F.col("v").alias("u"), F.col("least").alias("v"))
        small = small.unionByName(found.select("u", F.col("least").alias("v"))).filter("u != v").distinct()
        edges = scratch.table(small)
        now = mark(edges)
        if now == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = now
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
