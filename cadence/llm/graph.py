"""Linking what shares buckets, and connected components, as joins and sums.

Everything stays distributed: a bucket or node that holds a third of all rows is
summed up before it is shuffled, and joins on it are plain equi-joins that
adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.llm.tables import cut


def components(links: DataFrame) -> DataFrame:
    """Components of undirected links (a, b): columns ``node`` and ``component``
    (the smallest node reachable), for the nodes that have links. Alternates
    the large-star and small-star steps until the stars stay as they are; the
    rounds grow with the logarithm of a component's size, not its diameter."""
    edges = cut(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    state = None
    while True:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = cut(small.union(least).distinct())
        now = tuple(edges.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long"))).first())
        if now == state:
            break
        state = now
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


def shared_buckets(members: DataFrame) -> DataFrame:
    """Of (key, node): the rows of buckets with two nodes or more, with the
    bucket's smallest node as ``hub``."""
    hubs = members.groupBy("key").agg(F.min("node").alias("hub"), F.max("node").alias("last")).where("hub < last")
    return members.join(hubs.select("key", "hub"), "key")


def hub_pairs(shared: DataFrame) -> DataFrame:
    """For each node the hub that it shares most buckets with: one pair a node."""
    met = shared.where("node <> hub").groupBy("node", "hub").count()
    best = met.groupBy("node").agg(F.max(F.struct("count", (-F.col("hub")).alias("less"))).alias("best"))
    return best.select(F.col("node").alias("a"), (-F.col("best.less")).alias("b"))


def open_members(shared: DataFrame, comps: DataFrame) -> DataFrame:
    """(key, node, c, n): the rows of buckets whose nodes are in several components,
    with each node's component and the bucket's size. Buckets within one
    component have nothing left to find."""
    at = shared.select("key", "node").join(comps, "node", "left").select("key", "node", F.coalesce("component", "node").alias("c"))
    left = at.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count("*").alias("n")).where("lo < hi")
    return cut(at.join(left.select("key", "n"), "key"))


def link_buckets(members: DataFrame, verify, settle) -> DataFrame:
    """Components of the links between nodes that share a bucket. First each node
    is paired with one hub: ``verify`` takes pairs (a, b) and returns those that are
    links. Buckets that still span several components go to ``settle``, which takes
    the rows of open_members() and returns links that join up all that is linked."""
    shared = cut(shared_buckets(members))
    comps = components(verify(hub_pairs(shared)))
    at = open_members(shared, comps)
    if at.isEmpty():
        return comps
    stars = comps.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))
    return components(stars.union(settle(at)))
