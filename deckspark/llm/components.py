"""Connected components of an edge table, as Spark joins only.

Each round every node points at the neighbour that comes first in a random
order (a hash that changes with the round), pointers are followed once, and
the edges are rewritten between the nodes pointed at.  A constant share of
the nodes disappears per round in expectation, so the rounds grow with the
logarithm of the input whatever the graph's shape.  Each round's tables are
written to the shared folder; joins read written tables, which lets adaptive
execution split a hub's rows over tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import cut_lineage


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) of every node of an edge that joins two different nodes;
    nodes of one component have the same root, one of its nodes."""
    e = cut_lineage(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v").distinct(), "edges")
    steps: list[DataFrame] = []
    while not e.isEmpty():
        order = lambda c, k=len(steps): F.struct(F.xxhash64(F.col(c), F.lit(k)).alias("h"), F.col(c).alias("n"))
        both = e.union(e.select("v", "u"))
        first = both.groupBy("u").agg(F.least(order("u"), F.min(order("v")))["n"].alias("p"))
        first = cut_lineage(first.select(F.col("u").alias("node"), "p"), "pointers")
        jump = first.select(F.col("node").alias("p"), F.col("p").alias("root"))
        step = cut_lineage(first.join(jump, "p").select("node", "root"), "roots")
        steps.append(step)
        to_u = step.select(F.col("node").alias("u"), F.col("root").alias("ru"))
        to_v = step.select(F.col("node").alias("v"), F.col("root").alias("rv"))
        half = e.join(to_u, "u").select("v", "ru")
        e = cut_lineage(half.join(to_v, "v").select(F.col("ru").alias("u"), F.col("rv").alias("v")).where("u <> v").distinct(), "edges")
    if not steps:
        return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    label = steps[-1]
    for step in reversed(steps[:-1]):
        later = label.select(F.col("node").alias("root"), F.col("root").alias("last"))
        label = step.join(later, "root", "left").select("node", F.coalesce("last", "root").alias("root"))
    return cut_lineage(label, "components")
