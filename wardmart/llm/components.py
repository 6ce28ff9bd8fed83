"""Connected components of a link table, by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardmart.llm.base import stored


def components(links: DataFrame) -> DataFrame:
    """(id, root) for every id of ``links(a, b)``: the smallest id that it can reach.

    Each round first hangs every larger neighbour of a node under the smallest one
    around it, then the smaller neighbours too; trees turn into stars in a number of
    rounds that grows with the logarithm of the longest chain. A round is written to
    the shared folder, so a lost executor costs one round at most. Nodes with many
    links are met by a minimum (combined before the shuffle) and by a join with these
    minima as a stored table: adaptive execution splits the links of such a node, which
    it would not do beside an aggregate. Rows with a null end or equal ends are no links.
    """
    edges = (
        links.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    edges = stored(edges, "links")
    before = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if state == before or not state[0]:
            break
        before = state
        edges = stored(_star(edges), "links")
    return edges.select(F.col("a").alias("id"), F.col("b").alias("root")).union(
        edges.select(F.col("b").alias("id"), F.col("b").alias("root")).distinct()
    )


def _star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = stored(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("least")), "least")
    large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    large = stored(large.distinct(), "large")
    least = stored(large.groupBy("a").agg(F.min("b").alias("least")), "least")
    small = large.join(least, "a").where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return small.union(least.select("a", F.col("least").alias("b"))).distinct()
