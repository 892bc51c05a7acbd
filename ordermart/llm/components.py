"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermart.session import freeze
from ordermart.sinks.tables import by_rows

# Edges to a file, where they are fewer than a shuffle's partitions hold.
FILE_EDGES = 1 << 20


def _large_star(edges: DataFrame, parts: int | None = None) -> DataFrame:
    """Hang every larger neighbour of a node on the least of the node and its neighbours.

    An edge gives one row at most; rows may repeat.
    """
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # Stored, so that the join reads it apart from the edges and a hub's edges can be split.
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("least"))
    least = by_rows(freeze(_merged(least, parts), "least-neighbours"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))


def _small_star(edges: DataFrame, parts: int | None = None) -> DataFrame:
    """Hang a node and its smaller neighbours on the least of them; every edge has ``a > b``."""
    least = by_rows(freeze(_merged(edges.groupBy("a").agg(F.min("b").alias("least")), parts), "least-neighbours"))
    hung = (
        edges.join(least, "a")
        .select(F.explode(F.array("a", "b")).alias("a"), F.col("least").alias("b"))
        .where("a > b")
        .distinct()
    )
    return _merged(hung, parts)


def _merged(dealt: DataFrame, parts: int | None) -> DataFrame:
    """What a shuffle dealt by a key without hot values, in no more than ``parts`` tasks and files."""
    return dealt if parts is None else dealt.coalesce(parts)


def _parts(edges: DataFrame) -> int:
    return max(edges.sparkSession.sparkContext.defaultParallelism, math.ceil(edges.count() / FILE_EDGES))


def _flat(edges: DataFrame, parts: int) -> bool:
    """Whether every node hangs on one root only, and no root on anything."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("hangs"), F.lit(0).alias("holds")).unionByName(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("hangs"), F.lit(1).alias("holds"))
    )
    nodes = ends.groupBy("node").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds"))
    return _merged(nodes, parts).agg(F.coalesce(F.bool_and(F.col("hangs") + F.col("holds") < 2), F.lit(True))).first()[0]


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (longs ``a, b``); the root is the least node.

    Each round is a few joins of edges with one row per node; a hub's edges are a skewed
    join, which adaptive execution splits. Rounds grow with the logarithm of the longest
    path. Every round's edges are stored, so that no lineage builds up.
    """
    edges = freeze(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "edges",
    )
    # A round does not make edges more.
    parts = _parts(edges)
    while not _flat(edges, parts):
        # Stored, as the small star reads it twice.
        hung = freeze(_large_star(edges, parts), "large-star")
        edges = freeze(_small_star(hung, parts), "edges")
    leaves = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return leaves.unionByName(leaves.select("root").distinct().select(F.col("root").alias("node"), "root"))
