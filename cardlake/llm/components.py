"""Connected components of a table of links, by repeated joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cardlake.session import stage


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of ``links``; the root is the component's least node.

    Each round every node takes the least root among its neighbours' and hands it to its old root, so that both a star and a
    long chain shrink fast (large-star and small-star steps on the contracted links). A node with very many links is
    pre-aggregated on the map side: only a minimum per node and task is shuffled.
    """
    links = links.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).filter("a < b").distinct()
    links = stage(links, "links")
    first = links
    while True:
        # large star: a node's larger neighbours are linked to its least neighbour (or itself)
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("hub")).agg(F.min("b").alias("low")).select(
            "hub", F.least("hub", "low").alias("low"))
        large = (both.filter("b > a").join(least, F.col("a") == F.col("hub"))
                 .select(F.col("low").alias("a"), "b").filter("a < b").distinct())
        large = stage(large, "links")
        # small star: a node and its smaller neighbours are linked to the least of them
        low = large.groupBy(F.col("b").alias("hub")).agg(F.min("a").alias("low"))
        small = large.join(low, F.col("b") == F.col("hub"))
        small = (small.select(F.col("low").alias("a"), F.col("a").alias("b"))
                 .union(low.select(F.col("low").alias("a"), F.col("hub").alias("b"))).filter("a < b").distinct())
        small = stage(small, "links")
        if small.count() == links.count() and small.exceptAll(links).isEmpty():
            links = small
            break
        links = small
    rooted = links.select(F.col("b").alias("node"), F.col("a").alias("root"))
    roots = first.select(F.col("a").alias("node")).union(first.select(F.col("b").alias("node"))).distinct()
    return roots.join(rooted, "node", "left").select("node", F.coalesce("root", "node").alias("root"))
