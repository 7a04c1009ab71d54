"""Connected components of a table of links, by alternating large-star and small-star steps.

Every step is an aggregation with map-side minima and a join that adaptive execution
can split at a hot node; its result is written to the shared folder. Nothing of the graph is collected. A graph counted
to be small is joined up in one task instead.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.common import discard, saved


#: Links up to this count go through one task; more take the distributed steps. Both give the same.
ONE_TASK_LINKS = 100_000


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union by smallest node, with path halving."""
    up: dict[int, int] = {}

    def root(x: int) -> int:
        while up.setdefault(x, x) != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for batch in batches:
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = root(u), root(v)
            up[max(a, b)] = min(a, b)
    nodes = list(up)
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([root(x) for x in nodes], pa.int64())], ["node", "component"])


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """node and component (the smallest node reachable) of every node of links (columns u, v of long), once each."""
    edges = saved(links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    if edges.count() <= ONE_TASK_LINKS:
        return edges.coalesce(1).mapInArrow(_joined, "node long, component long")
    before = None
    while (now := _mark(edges)) != before:
        before = now
        # Large star: the larger neighbours of each node go to the smallest of it and its neighbours.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = saved(both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        discard(edges)
        # Small star: a node and its smaller neighbours go to the smallest of these.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = saved(moved.unionByName(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())
        discard(large)
    stars = edges.groupBy("u").agg(F.min("v").alias("component")).select(F.col("u").alias("node"), "component")
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())
