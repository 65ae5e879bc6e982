"""Connected components as joins and aggregates."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from facetmill.session import materialise


def connect(edges: DataFrame) -> DataFrame:
    """(node, component) for all nodes of ``edges`` (a, b): the smallest node that each one reaches.

    The edges of a task are contracted first, which is what a partial aggregate is
    to a sum. Then large-star and small-star steps alternate: every node hangs its
    larger, then its smaller neighbours onto the smallest one it knows, until
    nothing moves. Each step is written to the shared scratch folder.
    """
    now = materialise(_contracted(edges).distinct(), "edges")
    state = _state(now)
    while True:
        large = _star(now.unionByName(now.select(F.col("low").alias("high"), F.col("high").alias("low"))), "large")
        small = _star(large.select(F.col("low"), F.col("high")), "small")
        now = materialise(small.distinct(), "edges")
        before, state = state, _state(now)
        if state == before:
            break
    # All edges are now stars: each node but a smallest one has a single edge.
    return now.select(F.col("high").alias("node"), F.col("low").alias("component")).unionByName(
        now.select(F.col("low").alias("node"), F.col("low").alias("component")).distinct()
    )


def extend(labels: DataFrame | None, edges: DataFrame) -> DataFrame:
    """``labels`` (node, component) after new edges (a, b): only what they join is connected anew."""
    if labels is None:
        return materialise(connect(edges), "components")
    side = lambda c: labels.select(F.col("node").alias(c), F.col("component").alias(f"c{c}"))
    met = edges.join(side("a"), "a", "left").join(side("b"), "b", "left")
    met = met.select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    joined = connect(met).withColumnsRenamed({"node": "old", "component": "new"})
    moved = labels.join(joined, F.col("component") == F.col("old"), "left").select("node", F.coalesce("new", "component").alias("component"))
    fresh = joined.join(labels.select(F.col("node").alias("old")), "old", "left_anti")
    return materialise(moved.unionByName(fresh.select(F.col("old").alias("node"), F.col("new").alias("component"))), "components")


def _state(edges: DataFrame) -> tuple:
    """What two equal sets of edges have in common, and different ones do not."""
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("low", "high")), F.sum(F.xxhash64("high", "low") % 1_000_003)).first())


def _contracted(edges: DataFrame) -> DataFrame:
    """(low, high) stars with the same components, task by task."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            top = x
            while (up := parent.setdefault(top, top)) != top:
                top = up
            while parent[x] != top:
                parent[x], x = top, parent[x]
            return top

        for batch in batches:
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
                a, b = root(a), root(b)
                if a != b:
                    parent[max(a, b)] = min(a, b)
        nodes = [x for x in parent if root(x) != x]
        yield pa.RecordBatch.from_arrays([pa.array([root(x) for x in nodes], pa.int64()), pa.array(nodes, pa.int64())], ["low", "high"])

    return edges.select(F.col("a").cast("long"), F.col("b").cast("long")).mapInArrow(work, "low long, high long")


def _star(pairs: DataFrame, kind: str) -> DataFrame:
    """``pairs`` (high, low) are a node and its neighbour; neighbours are hung onto the node's smallest one.

    Large: the neighbours above the node, onto the smallest of neighbours and node.
    Small: the node and its neighbours, all of them below it, onto the smallest.
    """
    least = pairs.groupBy("high").agg(F.min("low").alias("least")).select("high", F.least("least", "high").alias("least"))
    met = pairs.join(least, "high")
    if kind == "large":
        hung = met.filter(F.col("low") > F.col("high")).select(F.col("least").alias("low"), F.col("low").alias("high"))
    else:
        hung = met.select(F.col("least").alias("low"), F.explode(F.array("high", "low")).alias("high"))
    return hung.filter("low < high")
