"""Connected components by contraction, without collecting a node's neighbours anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Steps


def components(steps: Steps, links: DataFrame, name: str = "links") -> DataFrame:
    """node and root for each node of ``links`` (a, b): equal roots, and only those, are connected.

    In every round each node steps to the one of itself and its neighbours that comes first in that round's random
    order (a minimum, so Spark combines it before the shuffle), and links are rewritten to the nodes stepped to. A link
    to the node stepped to is rewritten like any other, so no connection is lost, and the random order leaves about
    half of the nodes even of long chains. The rounds end when no link is left.
    """
    edges = steps.keep(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
                       f"{name}-0")
    roots, turn = None, 0
    while not edges.isEmpty():
        order = lambda node, turn=turn: F.struct(F.xxhash64(F.lit(turn), F.col(node)), F.col(node).alias("node"))
        ends = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        first = ends.groupBy("a").agg(F.min(order("b")).alias("first"))
        step = first.select(F.col("a").alias("node"), F.least("first", order("a"))["node"].alias("root"))
        step = steps.keep(step, f"{name}-step-{turn}")
        if roots is None:
            roots = step
        else:
            onward = step.select(F.col("node").alias("root"), F.col("root").alias("next"))
            roots = roots.join(onward, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
        left = edges.join(step.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a")
        both = left.join(step.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b").where("ra <> rb")
        turn += 1
        edges = steps.keep(both.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(),
                           f"{name}-{turn}")
    if roots is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return steps.keep(roots, f"{name}-roots")
