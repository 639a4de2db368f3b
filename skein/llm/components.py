"""Connected components by repeated hooking to the least neighbour and contraction, all in joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, stored


def components(links: DataFrame) -> DataFrame:
    """``links(a long, b long)`` to ``(node, component)``, the least node that each linked node reaches.

    Each round hooks every node to its least neighbour, shortens the chains once and renames the links, which
    leaves at most half of the nodes; rounds are logarithmic in the nodes. A hub's links meet as partial minima
    before any shuffle, and joins on a hub are sort-merge joins that adaptive execution splits. Null ends and
    self-links are left out; no links give no rows. The least node of a component is never renamed, so it names it.
    """
    edges = stored(links.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).where("a <> b").distinct(), "links")
    names = None
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        hook = stored(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("up")), "hooks")
        over = hook.select(F.col("node").alias("up"), F.col("up").alias("top"))
        step = stored(hook.join(over, "up").select("node", "top"), "steps")
        if names is None:
            names = step.select("node", F.col("top").alias("component"))
        else:
            new = stored(names.join(step.select(F.col("node").alias("component"), "top"), "component", "left").select("node", F.coalesce("top", "component").alias("component")), "names")
            discard(names)
            names = new
        left, right = step.select(F.col("node").alias("a"), F.col("top").alias("x")), step.select(F.col("node").alias("b"), F.col("top").alias("y"))
        shrunk = stored(edges.join(left, "a").join(right, "b").where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "links")
        discard(edges, hook)
        edges = shrunk
    discard(edges)
    if names is None:
        return links.sparkSession.createDataFrame([], "node long, component long")
    return names
