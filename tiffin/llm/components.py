"""Connected components by alternating large-star and small-star rounds.

A large-star round links the larger neighbours of every node to the smallest node around it; a
small-star round does so for the smaller ones and the node itself. Rounds alternate until no edge
changes; then every edge leads from a node to the smallest node of its component. Every round is a
written table, and joins with the smallest neighbours are spread, as a star's centre has a row for
every member.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiffin.llm.scratch import Scratch
from tiffin.operators.joins import spread_join


def connected_components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """``(node, root)`` for every node of ``edges`` (``a``, ``b``); the root is its smallest node."""
    a, b = F.col("a"), F.col("b")
    current = scratch.store(
        edges.filter(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(),
        f"{name}-0",
    )
    state, turn = _state(current), 0
    while state[0]:
        starred = scratch.store(_small_star(_large_star(current)), f"{name}-{turn + 1}")
        scratch.drop(f"{name}-{turn}")
        current, turn = starred, turn + 1
        before, state = state, _state(current)
        if state == before:
            break
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(roots)


def _state(edges: DataFrame) -> tuple:
    mark = F.xxhash64("a", "b").cast("decimal(38,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(mark)).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    smallest = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    linked = spread_join(both.filter("b > a"), smallest, "a")
    return linked.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    smallest = edges.groupBy("a").agg(F.min("b").alias("m"))
    linked = spread_join(edges, smallest, "a").filter("b > m")
    return (
        linked.select(F.col("b").alias("a"), F.col("m").alias("b"))
        .unionAll(smallest.select("a", F.col("m").alias("b")))
        .distinct()
    )
