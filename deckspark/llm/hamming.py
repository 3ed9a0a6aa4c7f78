"""Grouping 64-bit fingerprints so that all pairs within a radius meet.

A node is a bit mask with a pattern of the masked bits.  The root level has
``radius + 1`` nodes' masks, one block of bits each: of two fingerprints that
differ in at most ``radius`` bits, at least one block is equal, so they meet
in a node.  A node with more than ``limit`` members is replaced by children
whose masks add one of ``radius + 1`` blocks of the bits still free, which
keeps the guarantee; the free bits run out, so every node ends below
``limit`` as soon as ``2 ** free bits`` does.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import cut_lineage

BITS = 64


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def child_masks(mask: int, radius: int) -> list[int]:
    """``radius + 1`` masks that add to ``mask`` one block of its free bits."""
    mask &= (1 << BITS) - 1
    free = [b for b in range(BITS - 1, -1, -1) if not mask >> b & 1]
    k, cut = radius + 1, []
    for i in range(k):
        block = free[i * len(free) // k : (i + 1) * len(free) // k]
        cut.append(_signed(mask | sum(1 << b for b in block)))
    return cut


def nodes(fingerprints: DataFrame, radius: int, limit: int) -> list[DataFrame]:
    """(mask, pattern, fp) tables, one per level, of the nodes that have at
    most ``limit`` members.  ``fingerprints`` is a written table of distinct
    ``fp``; a level's row count is at most ``radius + 1`` times the members
    of the large nodes above it."""
    level = fingerprints.select("fp", F.explode(F.array(*[F.lit(m).cast("long") for m in child_masks(0, radius)])).alias("mask"))
    out = []
    while True:
        level = level.withColumn("pattern", F.col("fp").bitwiseAND(F.col("mask")))
        large = cut_lineage(level.groupBy("mask", "pattern").count().where(F.col("count") > limit).drop("count"), "large-nodes")
        masks = [r[0] for r in large.select("mask").distinct().collect()]  # at most (radius + 1) ** level
        if not masks:
            out.append(level)
            return out
        out.append(level.join(large, ["mask", "pattern"], "left_anti"))
        into = F.create_map(*[x for m in masks for x in (F.lit(m).cast("long"), F.array(*[F.lit(c).cast("long") for c in child_masks(m, radius)]))])
        hot = level.join(large, ["mask", "pattern"], "left_semi")
        level = cut_lineage(hot.select("fp", F.explode(into[F.col("mask")]).alias("mask")), "node-level")


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def union(labels: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Join the classes of i and j in ``labels`` (class = smallest member)."""
    while len(i):
        a, b = labels[i], labels[j]
        off = a != b
        if not off.any():
            return
        i, j, a, b = i[off], j[off], a[off], b[off]
        np.minimum.at(labels, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = labels[labels]
            if np.array_equal(up, labels):
                break
            labels[:] = up
