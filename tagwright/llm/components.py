"""Connected components of a link table, by hooking and pointer jumping over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagwright.session import written


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links`` ``(a, b)``; the root is the least node reachable.

    Each round every root takes the least root next to it, then all nodes jump to their root's root until
    nothing moves. Trees only ever hook to smaller roots, so there are no cycles; the rounds grow with the
    logarithm of the longest path. Minima are reduced in the tasks before they are shuffled, and all tables
    are written, so a root with very many nodes is a skewed join at most. Self-links and nulls are left out.
    """
    pairs = links.where(F.col("a") != F.col("b"))
    edges = written(
        pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "component-links"
    )
    nodes = edges.select(F.col("a").alias("node")).union(edges.select(F.col("b").alias("node"))).distinct()
    roots = written(nodes.withColumn("root", F.col("node")), "component-roots")
    while not edges.isEmpty():
        # every edge joins two roots, a > b: the greater one hooks to the least it sees
        hooks = written(edges.groupBy("a").agg(F.min("b").alias("b")), "component-hooks")
        hooks = _flattened(hooks)
        roots = written(_moved(roots, hooks, "root"), "component-roots")
        ends = _moved(_moved(edges, hooks, "a"), hooks, "b").where(F.col("a") != F.col("b"))
        ends = ends.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        edges = written(ends, "component-links")
    return roots


def _moved(df: DataFrame, hooks: DataFrame, name: str) -> DataFrame:
    """``df`` with ``name`` replaced by what it hooks to."""
    to = hooks.select(F.col("a").alias("hook_from"), F.col("b").alias("hook_to"))
    joined = df.join(to, F.col(name) == F.col("hook_from"), "left")
    return joined.withColumn(name, F.coalesce("hook_to", name)).drop("hook_from", "hook_to")


def _flattened(hooks: DataFrame) -> DataFrame:
    """Hooks that all point to the end of their chain."""
    while True:
        ends = hooks.select(F.col("a").alias("end_from"), F.col("b").alias("end_to"))
        jumped = hooks.join(ends, F.col("b") == F.col("end_from"), "left")
        moved = written(
            jumped.select("a", F.coalesce("end_to", "b").alias("b"), F.col("end_to").isNotNull().alias("jumped")),
            "component-hooks",
        )
        hooks = moved.select("a", "b")
        if moved.where("jumped").isEmpty():
            return hooks
