"""Connected components of links in a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from amity.llm.tables import drop_tables, shared_table


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``links`` (``a, b``, no NULLs), where the component is
    the least node that can be reached.

    Large-star and small-star rounds on links from the greater to the lesser node:
    first each link goes on from its lesser node to that node's own least
    neighbour, then a node and its lesser neighbours go to the least of these.
    Minima are merged before their shuffle and kept in the shared folder, so that
    the joins are between two plain shuffles, which Spark splits where one node has
    very many links. Rounds end when the links no longer change. Links that repeat
    or join a node with itself do no harm.
    """
    links = shared_table(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    nodes = links.select("a").union(links.select("b")).distinct()
    edges, state, last = links.where("a <> b"), None, ()

    def least(df: DataFrame, name: str) -> DataFrame:
        return shared_table(df.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", name))

    while True:
        nearest = least(edges, "b")
        large = edges.join(nearest, "b", "left").select("a", F.coalesce("m", "b").alias("b")).distinct()
        lowest = least(large, "a")
        small = large.join(lowest, "a")
        ends = F.explode(F.array("a", "b")).alias("a")
        edges = shared_table(small.select(ends, F.col("m").alias("b")).where("a <> b").distinct())
        drop_tables(nearest, lowest, *last)
        last = (edges,)
        found = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(found) == state:
            break
        state = tuple(found)
    alone = nodes.select("a", F.col("a").alias("b"))
    return alone.union(edges).groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "node")
