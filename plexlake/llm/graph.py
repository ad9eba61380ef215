"""Connected components of a link table, by bounded contraction in tasks and rounds of joins."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plexlake.llm.stage import keep

TASK_LINKS = 1_000_000  # what one task contracts


def roots(n: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Smallest index reachable over the edges, by passing minima and jumping."""
    root = np.arange(n)
    while True:
        least = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, x, least)
        np.minimum.at(new, y, least)
        new = np.minimum(new, new[new])
        if (new == root).all():
            return root
        root = new


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of a task as stars around the smallest node of each of its components."""
    u, v = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        u, v = np.concatenate([u, batch.column(0).to_numpy()]), np.concatenate([v, batch.column(1).to_numpy()])
        nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
        root = roots(len(nodes), at[: len(u)], at[len(u) :])
        moved = np.flatnonzero(root != np.arange(len(nodes)))
        u, v = nodes[moved], nodes[root[moved]]
    if len(u):
        yield pa.record_batch([pa.array(u), pa.array(v)], names=["u", "v"])


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node sends its larger neighbours to its smallest one. ``edges`` has u > v."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = keep(both.groupBy("u").agg(F.least(F.first("u"), F.min("v")).alias("m")), "stars")
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours go to the smallest of them."""
    least = keep(edges.groupBy("u").agg(F.min("v").alias("m")), "stars")
    others = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return others.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(links: DataFrame, task_links: int = TASK_LINKS) -> DataFrame:
    """(node, component) of all nodes in ``links`` (a, b); a component is named by its smallest node.

    Tasks first contract up to ``task_links`` links each. Where that took several tasks, their stars
    are joined by alternating large and small stars (Kiveris et al. 2014): few rounds whatever the
    diameter, each a partial aggregate and a join. Every round is written to shared storage; only a count
    and a checksum come to the driver. NULL nodes are left out.
    """
    a, b = F.col("a"), F.col("b")
    edges = keep(links.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "links")
    tasks = -(-edges.count() // task_links) or 1
    edges = keep(edges.coalesce(tasks).mapInArrow(_contract, "u long, v long"), "links")
    before = None
    while tasks > 1:
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            break
        before = now
        edges = keep(_small_star(keep(_large_star(edges), "links")), "links")
    members = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return members.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
