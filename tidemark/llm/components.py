"""Connected components by alternating stars, in a number of rounds that grows with the logarithm."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.durable import free, settle


def _digest(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return row[0], int(row[1] or 0)


def _nearest(pairs: DataFrame) -> DataFrame:
    """The smallest neighbour of each node; reduced before the shuffle, so a hub is one row a task.

    Settled, so that what it joins meets a table of known size: broadcast while it is small, and
    beyond that a plain join of two shuffles, in which adaptive execution splits a hub's rows.
    """
    return settle(pairs.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")), "nearest")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for all nodes of ``edges`` (a, b); a component is named by its smallest node.

    Nodes may have any type that can be ordered. Rows with a null end and loops are passed over;
    repeated edges count once, and no edges give no rows. Each round's files are removed once the
    next round is settled.
    """
    edges = settle(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    seen = _digest(edges)
    while seen[0]:
        # Larger neighbours of each node go to its smallest neighbour, or to itself if it is smaller.
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = _nearest(both)
        large = (
            both.join(low, both.a == low.node)
            .where("b > a")
            .select(F.col("b").alias("a"), F.least("a", "low").alias("b"))
            .distinct()
        )
        large = settle(large, "edges")
        free(edges, low)
        # Each node and its smaller neighbours go to the smallest of them.
        low = _nearest(large)
        joined = large.join(low, large.a == low.node)
        small = joined.select("a", F.col("low").alias("b")).union(
            joined.where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        )
        edges = settle(small.distinct(), "edges")
        free(large, low)
        now = _digest(edges)
        if now == seen:
            break
        seen = now
    members = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return members.union(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
