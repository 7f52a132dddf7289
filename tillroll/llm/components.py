"""Connected components of a link table, by alternating large and small stars.

Each round is two group-bys with a join each (Kiveris et al., Connected
Components in MapReduce and Beyond, 2014); rows move to the least id of their
neighbourhood until nothing changes. A node with any number of links is
aggregated map-side first, and its join is one that Spark can split, so no
group of links ever has to fit in one task.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.scratch import Scratch


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One star step: links (a, b) with a > b; a large star may repeat some."""
    if large:
        both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        out = both.join(least, both.a == least.u).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        least = links.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "u")
        moved = links.join(least, links.a == least.u).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        out = moved.union(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.where("a <> b") if large else out.where("a <> b").distinct()


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component) of every node of ``links`` (columns a, b: long); the
    component is the least node reachable. Nodes without links have no row.
    Rows with a null or with a = b are no links."""
    now = scratch.keep(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    state = None
    while True:
        after = scratch.keep(_star(_star(now, large=True), large=False))
        new = after.agg(
            F.count("*").alias("n"),
            F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h"),
            F.max("b").alias("x"),
        ).first()
        scratch.drop(now)
        now = after
        if state == new:
            break
        state = new
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least node of each of ``n`` nodes' component, in memory (for a tile's links)."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
        open_ = root[a] != root[b]
        a, b = a[open_], b[open_]
    return root
