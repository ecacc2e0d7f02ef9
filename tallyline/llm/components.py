"""Connected components of a graph whose edges are rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.common import cut, drop, first, size

#: Edges up to which the driver joins the components (16 MB of ends), as each distributed step is several small stages.
LOCAL = 1 << 20


def _joined(a: np.ndarray, b: np.ndarray) -> pa.Table:
    """``node, component`` of a graph that fits in memory: roots are hooked to smaller ones until no edge joins two."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    first, second = ends[: len(a)], ends[len(a) :]
    root = np.arange(len(nodes))
    while len(first):
        one, two = root[first], root[second]
        np.minimum.at(root, np.maximum(one, two), np.minimum(one, two))
        while (root[root] != root).any():
            root = root[root]
        apart = root[first] != root[second]
        first, second = first[apart], second[apart]
    return pa.table({"node": nodes.astype(np.int64), "component": nodes[root].astype(np.int64)})


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node reachable) for every node of ``edges`` (longs ``a, b``).

    Alternating large-star and small-star contraction: each step links every neighbour to the smallest,
    until nothing changes. Only edges move; minima are aggregated before they are shuffled, and the
    joins can be split where a node has very many edges. Loops and repeated edges do no harm; null ends
    are dropped; no edges give no rows.
    """
    now = cut(edges.select("a", "b").where("a <> b").distinct())
    if size(now) <= LOCAL:
        table = now.toArrow()
        return now.sparkSession.createDataFrame(_joined(*(table.column(c).to_numpy() for c in "ab")), "node long, component long")
    before = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("u"), F.least("a", "m").alias("v"))
        down = large.where("u <> v").distinct()
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u").where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
        last, now = now, cut(small.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct())
        drop(last)
        seen = first(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))))
        if seen == before:
            break
        before = seen
    # every node but the smallest of its component now has one edge, to the smallest
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
