"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskbook.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """node, component (smallest node reachable) for every node of ``links`` (long a, b).

    Alternating large-star and small-star steps: every node's larger, then smaller
    neighbours are linked to the smallest one around, until nothing changes. The
    minimum per node is a partially aggregated shuffle; the join back on the
    node is an equi-join that AQE splits where one node holds many links. Each
    round's links are a table in the shared folder. Rounds grow with the logarithm
    of the nodes.
    """
    both = lambda e: e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = stored(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct(), "links-0")
    step = 0
    while True:
        # Large star: larger neighbours of a node are linked to the smallest one around it.
        around = both(edges)
        lowest = around.groupBy("a").agg(F.min(F.least("a", "b")).alias("low"))
        large = around.where("b > a").join(lowest, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        # Small star: a node and its smaller neighbours are linked to the smallest of them.
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        met = large.join(low, "a")
        small = met.where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(low.select("a", F.col("low").alias("b"))).distinct()
        step += 1
        small = stored(small.where("a > b"), f"links-{step}")
        change = small.exceptAll(edges).limit(1).count() + edges.exceptAll(small).limit(1).count()
        edges = small
        if not change:
            break
    return edges.groupBy("a").agg(F.min("b").alias("component")).select(F.col("a").alias("node"), "component").unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
