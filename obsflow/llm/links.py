"""Connected components of a table of links, as repeated Spark joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from obsflow.session import materialise


def _both_ways(edges):
    return edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def components(edges):
    """``node``, ``component``: the smallest node reachable from each node that has a link.

    ``edges`` has long columns ``a`` and ``b``. Alternates two steps until nothing
    changes: every node links its larger neighbours to its smallest one, then
    its smaller neighbours and itself. The links of a node shrink to one, the
    smallest of its component, in a logarithmic number of rounds. Each round is
    a table in the shared folder, so lineage stays short and lost executors
    cost a part of one round.
    """
    links = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = materialise(links.distinct(), "links")
    seen = None
    while True:
        state = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == seen:
            break
        seen = tuple(state)
        near = _both_ways(links)
        least = near.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = near.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = materialise(large.distinct(), "links")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        links = materialise(small.union(least.select("a", F.col("m").alias("b"))).distinct(), "links")
    return links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component")).union(
        links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
