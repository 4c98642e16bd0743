"""Connected components of a table of links, in rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sanitaria.llm.common import Scratch


def connected_components(links: DataFrame, most_rounds: int = 60, scratch: Scratch | None = None) -> DataFrame:
    """``node, component``: of every linked node the smallest node it is connected with.

    Input: ``a, b``; direction, repeats and loops do not matter.  In each round a node takes the
    smallest label of itself and its neighbours and then that label's own label, so labels reach
    over distances that double; links whose ends agree with their labels' labels are
    contracted to links between labels.  Rounds end when no link joins two labels.  Labels live in
    written tables, each deleted when the next one stands; only a count comes to the driver.
    """
    scratch = scratch or Scratch()
    ends = links.select("a", "b").filter("a <> b")
    both = ends.unionByName(ends.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # Nodes with their smallest neighbour or themselves: a forest that points to smaller nodes.
    labels = scratch.written(both.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("node"), F.least("a", "m").alias("component")), "component-labels")
    rest = both.filter("a < b")
    for _ in range(most_rounds):
        labels = _jumped(labels, scratch)
        near = labels.select(F.col("node").alias("a"), F.col("component").alias("ca"))
        far = labels.select(F.col("node").alias("b"), F.col("component").alias("cb"))
        crossing = rest.join(near, "a").join(far, "b").filter("ca <> cb")
        earlier, rest = rest, scratch.written(
            crossing.select(F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b")).distinct(),
            "component-links",
        )
        scratch.drop(earlier)
        if rest.isEmpty():
            scratch.drop(rest)
            return labels
        # Each label that is left hangs itself below its smallest neighbour.
        back = rest.unionByName(rest.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hung = back.groupBy("a").agg(F.min("b").alias("m")).select(
            F.col("a").alias("component"), F.least("a", "m").alias("below"))
        earlier, labels = labels, scratch.written(
            labels.join(hung, "component", "left").select("node", F.coalesce("below", "component").alias("component")),
            "component-labels",
        )
        scratch.drop(earlier)
    raise RuntimeError("components did not settle")


def _jumped(labels: DataFrame, scratch: Scratch, most_rounds: int = 60) -> DataFrame:
    """Labels followed to their ends, two steps becoming one in each round."""
    before = labels
    for _ in range(most_rounds):
        above = labels.select(F.col("node").alias("component"), F.col("component").alias("next"))
        moved = labels.join(above, "component", "left").select(
            "node", F.coalesce("next", "component").alias("component"),
            (F.coalesce("next", "component") != F.col("component")).cast("int").alias("moved"),
        )
        moved = scratch.written(moved, "component-labels")
        scratch.drop(before)
        before = moved
        labels = moved.select("node", "component")
        if not moved.agg(F.max("moved")).first()[0]:
            return labels
    raise RuntimeError("labels did not settle")
