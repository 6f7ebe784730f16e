"""Connected components of a stored edge table by contraction, all in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a long, b long): the least node that it is connected to.

    Each round points every node to its least neighbour, follows the pointers to their ends by doubling, and merges
    each tree into its end, so the edges left are few after the first round. Every step is stored; the driver sees
    whether any row changed. Null ends, loops and repeated edges change nothing.
    """
    edges = stored(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    labels: DataFrame | None = None
    while True:
        ends = edges.select(F.col("b").alias("node"), F.col("a").alias("to")).union(edges.select(F.col("a").alias("node"), F.col("a").alias("to")))
        pointers = _to_the_end(stored(ends.groupBy("node").agg(F.min("to").alias("to")), "pointers"))
        if labels is None:
            labels = pointers.select("node", F.col("to").alias("label"))
        else:
            moved = pointers.select(F.col("node").alias("label"), "to")
            labels = stored(labels.join(moved, "label", "left").select("node", F.coalesce("to", "label").alias("label")), "labels")
        left = edges.join(pointers.select(F.col("node").alias("a"), F.col("to").alias("end_a")), "a")
        left = left.join(pointers.select(F.col("node").alias("b"), F.col("to").alias("end_b")), "b").where("end_a <> end_b")
        edges = stored(left.select(F.least("end_a", "end_b").alias("a"), F.greatest("end_a", "end_b").alias("b")).distinct(), "edges")
        if edges.isEmpty():
            return labels


def _to_the_end(pointers: DataFrame) -> DataFrame:
    """(node, to) with each pointer followed until a node that points to itself."""
    while True:
        onward = pointers.select(F.col("node").alias("to"), F.col("to").alias("further"))
        doubled = stored(pointers.join(onward, "to").select("node", "further", (F.col("further") != F.col("to")).alias("moved")), "pointers")
        pointers = doubled.select("node", F.col("further").alias("to"))
        if doubled.where("moved").isEmpty():
            return pointers
