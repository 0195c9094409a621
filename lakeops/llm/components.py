"""Connected components of a link table, as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lakeops.session import materialize


def connected_components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(a, b) links of comparable ids -> (node, root): the smallest node that
    each linked node reaches. Nodes without a link are not listed.

    Alternating large-star and small-star steps: every node points its larger
    neighbours, then its smaller ones, at the smallest of them, until nothing
    changes; a number of rounds in the logarithm of the nodes. A node's
    smallest neighbour is an aggregate joined back, so no neighbourhood is
    gathered in one task, and each round's table is written to the shared
    folder, which cuts the lineage.
    """
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct()
    links = materialize(links, "links")
    before = None
    for _ in range(max_rounds):
        # large star: the larger neighbours of each node point at its smallest
        # neighbour or itself
        both = links.union(links.select("b", "a"))
        low = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        # small star: the smaller neighbours and the node point at the smallest
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a > b").union(low.select("a", F.col("low").alias("b"))).distinct()
        links = materialize(small, "links")
        now = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h"), F.count_distinct("a").alias("k")).first()
        if now.n == now.k and (now.n, now.h) == before:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        before = (now.n, now.h)
    raise RuntimeError(f"components not settled after {max_rounds} rounds")
