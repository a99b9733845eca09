"""Connected components of an edge table, as joins and grouped minima."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from punctua.llm.common import Workspace


def local_forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, least id of its component) for the components of the given edges.

    As many edges as nodes at most: what a task needs to send of any number of links.
    """
    if not len(a):
        return a, b
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = at[: len(a)], at[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[i], label[j])
        before = label.copy()
        np.minimum.at(label, i, low)
        np.minimum.at(label, j, low)
        np.minimum.at(label, before[i], low)
        np.minimum.at(label, before[j], low)
        label = label[label]
        if (label == before).all():
            break
    keep = label != np.arange(len(nodes))
    return nodes[keep], nodes[label[keep]]


def components(edges: DataFrame, work: Workspace) -> DataFrame:
    """``(id, component)`` for every node of ``edges(a, b)``; component is the least id.

    Alternates two steps until nothing changes: every node hands its larger
    neighbours to the least neighbour, then its smaller ones.  Each step is a grouped
    minimum and an equality join; no neighbour list is ever gathered, and the driver
    only sees a count and a checksum.  Null ends and loops are left out.
    """
    cur = work.store(
        edges.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "edges",
    )
    seen = None
    while True:
        both = cur.union(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = (
            both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        )
        large = work.store(large.distinct(), "large")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            low.select("u", F.col("m").alias("v"))
        )
        nxt = work.store(small.where("u <> v").distinct(), "small")
        now = nxt.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        work.drop(cur, large)
        cur = nxt
        if now == seen:
            break
        seen = now
    found = cur.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return found.union(found.select(F.col("component").alias("id"), "component").distinct())
