"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packetloom.llm.common import store


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges(a, b)``; root is the smallest node of the component.

    Each round replaces a node's links by links to the smallest node around it
    and writes the result, so lineage stays short and the number of rounds is
    logarithmic in practice. Smallest neighbours are found with map-side
    combining and joined back on a unique key, so a hub is no large group.
    """
    links = store(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    state = None
    while True:
        signature = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if signature == state or not signature[0]:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                links.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
        state = signature
        both = links.union(links.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # all of large points downwards, so a node's smaller neighbours are all of its neighbours
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = store(small.union(low.select("u", F.col("m").alias("v"))).distinct(), "links")
