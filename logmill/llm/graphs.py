"""Connected components of a table of links, by contraction: nodes hang on their smallest neighbour, and links go on between the roots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dropped, written


def _roots(up: DataFrame) -> DataFrame:
    """node, root of a forest (node, up), where ``up`` is no larger than its node: pointers jump to the pointers of their ends until none moves."""
    while True:
        twice = up
        for _ in range(2):
            twice = twice.join(up.select(F.col("node").alias("up"), F.col("up").alias("further")), "up").select("node", F.col("further").alias("up"))
        new = written(twice.join(up.select("node", F.col("up").alias("old")), "node"), "roots")
        moved = new.where("up <> old").limit(1).count()
        dropped(up)
        up = new.select("node", "up")
        up._scratch = new._scratch
        if not moved:
            return up


def components(links: DataFrame) -> DataFrame:
    """node, component (its smallest node) for every node of ``links`` (columns a, b, long). Equal and repeated links do no harm.

    Each round leaves at most half of the nodes that still have links, and only links between roots, so all rounds together cost little more
    than the first one. Rounds are written to the shared folder and removed once the next one is.
    """
    once = lambda df, a, b: df.where(f"{a} <> {b}").select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct()
    edges = written(once(links, "a", "b"), "links")
    labels: DataFrame | None = None
    while True:
        lower = edges.groupBy("a").agg(F.min("b").alias("up")).select(F.col("a").alias("node"), "up")
        ends = edges.select(F.col("b").alias("node"), F.col("b").alias("up"))
        roots = _roots(written(lower.union(ends).groupBy("node").agg(F.min("up").alias("up")), "up"))
        if labels is None:
            new = roots.withColumnRenamed("up", "component")
        else:
            met = labels.join(roots.select(F.col("node").alias("component"), "up"), "component", "left")
            new = met.select("node", F.coalesce("up", "component").alias("component"))
        new = written(new, "labels")
        ends = edges.join(roots.select(F.col("node").alias("a"), F.col("up").alias("x")), "a").join(roots.select(F.col("node").alias("b"), F.col("up").alias("y")), "b")
        left = written(once(ends, "x", "y"), "links")
        for done in (edges, roots, labels):
            if done is not None:
                dropped(done)
        labels, edges = new, left
        if edges.isEmpty():
            dropped(edges)
            return labels
