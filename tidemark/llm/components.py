"""Connected components by contraction, as joins and aggregates.

In each round every node joins the neighbour (or itself) with the smallest hash. The order of hashes is a random
one, so long chains shrink by a constant share, and stars are gone after two rounds. Tables are written between rounds, and only their emptiness is looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import discard, stored


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of edges(a, b), written; nodes that are connected have the same root.

    Loops and repeated edges do no harm; an empty table of edges gives no rows.
    """
    e = stored(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    steps: list[DataFrame] = []
    while not e.isEmpty():
        order = F.xxhash64("b")
        near = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b"))).groupBy("a").agg(F.min(F.struct(order.alias("h"), F.col("b").alias("b"))).alias("near"))
        step = near.select(F.col("a").alias("node"), F.when(F.col("near.h") < F.xxhash64("a"), F.col("near.b")).otherwise(F.col("a")).alias("root"))
        step = stored(step, "step")
        steps.append(step)
        left = step.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        right = step.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        moved = e.join(left, "a").join(right, "b").where("ra <> rb")
        fewer = stored(moved.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "edges")
        discard(e)
        e = fewer
    found = steps[-1] if steps else e.select(F.col("a").alias("node"), F.col("b").alias("root"))
    for step in reversed(steps[:-1]):
        later = found.select(F.col("node").alias("root"), F.col("root").alias("_last"))
        found = step.join(later, "root", "left").select("node", F.coalesce("_last", "root").alias("root"))
    found = stored(found, "components")
    discard(e, *steps)
    return found


def grown(found: DataFrame, links: DataFrame) -> DataFrame:
    """The components found, joined up by more links(a, b); written, and found is deleted.

    Only links between different components are followed, as links of their roots.
    """
    a = found.select(F.col("node").alias("a"), F.col("root").alias("ra"))
    b = found.select(F.col("node").alias("b"), F.col("root").alias("rb"))
    between = links.join(a, "a", "left").join(b, "b", "left").select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b"))
    more = components(between)
    later = more.select(F.col("node").alias("root"), F.col("root").alias("_last"))
    old = found.join(later, "root", "left").select("node", F.coalesce("_last", "root").alias("root"))
    whole = stored(old.unionByName(more.join(found.select("node"), "node", "left_anti")), "components")
    discard(found, more)
    return whole
