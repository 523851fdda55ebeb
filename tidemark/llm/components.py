"""Connected components by repeated contraction, for edge lists of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.scale import materialise

# Rounds in one fixed random order; later ones draw a new order, against long chains.
_FIXED = 4


def connected(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable, for every node of an edge.

    Each round sends a node to the smallest neighbour in a random order and
    keeps the edges between different nodes that are left, so stars and cliques
    end after two or three rounds and chains shrink by a constant share. A
    round aggregates with map-side combining and joins written tables, whose
    large keys Spark splits; nothing is collected but an emptiness test. Null
    ends and self links are ignored; no edge gives no row.
    """
    ends = edges.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b"))
    ends = ends.where("a is not null and b is not null and a <> b")
    nodes = ends.select("a").unionAll(ends.select("b")).distinct()
    # xxhash64 of one long is one to one, so hashed nodes can stand for the nodes.
    label = materialise(nodes.select(F.col("a").alias("node"), F.xxhash64("a").alias("at")), "labels")
    left = materialise(
        ends.select(F.xxhash64("a").alias("a"), F.xxhash64("b").alias("b")).distinct(), "edges"
    )
    turn = 0
    while not left.isEmpty():
        turn += 1
        if turn > _FIXED:
            left = left.select(F.xxhash64("a").alias("a"), F.xxhash64("b").alias("b"))
            label = label.select("node", F.xxhash64("at").alias("at"))
        both = left.unionAll(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        to = both.groupBy(F.col("a").alias("at")).agg(F.min("b").alias("low"))
        to = materialise(to.select("at", F.least("at", "low").alias("to")), "step")
        label = materialise(
            label.join(to, "at", "left").select("node", F.coalesce("to", "at").alias("at")), "labels"
        )
        moved = left.join(to.select(F.col("at").alias("a"), F.col("to").alias("a2")), "a")
        moved = moved.join(to.select(F.col("at").alias("b"), F.col("to").alias("b2")), "b")
        moved = moved.where("a2 <> b2").select(
            F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b")
        )
        left = materialise(moved.distinct(), "edges")
    lowest = materialise(label.groupBy("at").agg(F.min("node").alias("component")), "lowest")
    return materialise(label.join(lowest, "at").select("node", "component"), "components")
