"""Connected components of a link table, by alternating stars over joins."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import stored


def _changed(before: tuple | None, now: tuple) -> bool:
    return before is None or tuple(before) != tuple(now)


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, component`` (smallest node reachable) of the long columns ``a, b``.

    Only nodes with a link to another node are returned; links of a node to
    itself and repeated links are harmless, none at all gives an empty table.
    Each round hangs the larger neighbours of every node, then the node and
    its smaller neighbours, on the smallest one. A node's smallest neighbour
    is an aggregate and goes back by a join, so no neighbour list is ever
    gathered. Rounds are cut by stored tables.
    """
    a, b = F.least("a", "b"), F.greatest("a", "b")
    now = stored(edges.filter("a <> b").select(b.alias("u"), a.alias("v")).distinct(), "links")
    state = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stored(large, "stars")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = stored(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "links")
        digest = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if not _changed(state, digest):
            break
        state = digest
    roots = now.select(F.col("v").alias("node")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.withColumn("component", F.col("node"))
    )


def merge_labels(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Joins the groups of ``a[i]`` and ``b[i]`` in place; a label is the smallest index of its group."""
    while len(a):
        la, lb = labels[a], labels[b]
        apart = la != lb
        a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
        np.minimum.at(labels, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            shorter = labels[labels]
            if np.array_equal(shorter, labels):
                break
            labels[:] = shorter
