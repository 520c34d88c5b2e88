"""Connected components by alternating large-star and small-star steps of DataFrame joins.

Before that each task replaces at most STAR_EDGES edges at a time by stars, twice, so that few steps are left, and
none where all edges are that few.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duelframe.llm.base import discard, materialize

#: Far more rounds than any graph needs: a path of n nodes takes about log2(n).
MOST_ROUNDS = 200
#: Edges that a task replaces by stars at a time.
STAR_EDGES = 1 << 17


def stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges (u, v) from each node to the smallest that it reaches by a part of the edges, for part after part."""
    smaller: dict[int, int] = {}

    def end(x: int) -> int:
        while (y := smaller.get(x, x)) != x:
            smaller[x] = smaller.get(y, y)
            x = y
        return x

    def made() -> pa.RecordBatch:
        nodes = list(smaller)
        return pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([end(x) for x in nodes], pa.int64())], ["u", "v"])

    read = 0
    for batch in batches:
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            u, v = end(u), end(v)
            if u != v:
                smaller[max(u, v)] = min(u, v)
        read += len(batch)
        if read >= STAR_EDGES:
            yield made()
            smaller.clear()
            read = 0
    yield made()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (a, b): the smallest node that can be reached.

    Each round writes its edges to the shared folder, so a lost executor costs one round at most. Nodes with
    very many edges are no hot keys: smallest neighbours are found by partial sums and written, so that Spark
    can split the large side of the joins with them. More than MOST_ROUNDS rounds are an error.
    """
    edges = materialize(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v"), "edges")
    for _ in range(2):
        parts = math.ceil(edges.count() / STAR_EDGES)
        given, edges = edges, materialize(edges.coalesce(max(parts, 1)).mapInArrow(stars, "u long, v long"), "edges")
        discard(given)
        if parts <= 1:
            return with_roots(edges)
    was = None
    for _ in range(MOST_ROUNDS):
        # the set of edges by count and two sums over 64-bit hashes: equal only if no edge changed
        now = tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first())
        if now == was or not now[0]:
            break
        was = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "least")
        large = materialize(both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large")
        discard(least, edges)
        least = materialize(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        star = large.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        edges = materialize(star.filter("u != v").distinct(), "edges")
        discard(least, large)
    else:
        raise RuntimeError(f"components have not settled after {MOST_ROUNDS} rounds")
    return with_roots(edges)


def with_roots(edges: DataFrame) -> DataFrame:
    """(node, component) of stars (u, v)."""
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
