"""Connected components of a graph given by its links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import discard, written


def _least(edges: DataFrame, node: str, other: str) -> DataFrame:
    """For each node the least of itself and its neighbours; combined before the shuffle."""
    return edges.groupBy(F.col(node).alias("node")).agg(F.least(F.min(node), F.min(other)).alias("low"))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """`node` and `component` (the least node it can reach) of every node with a link.

    `links` has the columns a and b. Rounds of two steps, in which each node hands its least
    neighbour first to its larger neighbours and then to its smaller ones, turn every component
    into a star around its least node in a number of rounds that grows as a logarithm. Each
    round is written to the checkpoint folder; only a count and a checksum reach the driver.
    """
    pairs = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    edges = written(pairs.where("a <> b").distinct())
    before = None
    while (now := _state(edges)) != before:
        before = now
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        larger = both.join(_least(both, "a", "b"), F.col("a") == F.col("node")).where("b > a")
        handed = written(larger.select(F.col("low").alias("a"), "b").where("a <> b").distinct())
        discard(edges)
        lows = _least(handed, "b", "a")
        smaller = handed.join(lows, F.col("b") == F.col("node"))
        edges = written(
            smaller.select(F.col("low").alias("a"), F.col("a").alias("b"))
            .unionByName(lows.select(F.col("low").alias("a"), F.col("node").alias("b")))
            .where("a <> b")
            .distinct()
        )
        discard(handed)
    members = edges.select(F.col("b").alias("node"), F.col("a").alias("component"))
    return members.unionByName(edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
