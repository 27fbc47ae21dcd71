"""Breadth-first expansion over an edge table."""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut


def clean_edges(discoveries: DataFrame) -> DataFrame:
    """``source, target`` once each, without nulls and self-links."""
    return (
        discoveries.select(F.col("from_channel").alias("source"), F.col("to_channel").alias("target"))
        .where("source is not null and target is not null and source <> target")
        .distinct()
    )


def one_round(edges: DataFrame, frontier: DataFrame, seen: DataFrame) -> DataFrame:
    """``node``: targets of the frontier not seen before, each once. A semi-join takes an edge once, however
    often its source stands in the frontier."""
    reached = edges.join(frontier.select(F.col("node").alias("source")), "source", "left_semi")
    return reached.select(F.col("target").alias("node")).distinct().join(seen.select("node"), "node", "left_anti")


#: After so many rounds what is seen is gathered into one copy, so that plans of long chains stay short.
GATHER = 16


def reach(edges: DataFrame, start: DataFrame) -> DataFrame:
    """``node, depth`` of all that can be reached from ``start`` (depth 0), however far.

    Each round is one semi-join with the frontier and one anti-join with what is seen, materialised
    in the shared checkpoint folder; it ends when a round finds nothing.
    """
    edges = cut(edges)
    seen = frontier = cut(start.select("node").distinct().withColumn("depth", F.lit(0)))
    for depth in count(1):
        frontier = cut(one_round(edges, frontier, seen).withColumn("depth", F.lit(depth)))
        if frontier.isEmpty():
            return seen
        seen = seen.unionByName(frontier)
        if depth % GATHER == 0:
            seen = cut(seen.repartition("node"))
