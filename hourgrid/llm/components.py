"""Connected components of an edge table: blocks contracted inside tasks, large and small stars between them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from hourgrid.llm.frames import stored

#: Edges of one block, a few megabytes.
BLOCK_EDGES = 1 << 18


def contracted(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of edges, each node that is not the smallest that it reaches by them, and that smallest."""
    nodes, ids = np.unique(np.concatenate([u, v]), return_inverse=True)
    root, a, b = np.arange(len(nodes)), ids[: len(u)], ids[len(u) :]
    while len(a):
        a, b = root[a], root[b]
        apart = a != b
        a, b = a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root[root] != root).any():
            root = root[root]
    moved = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[moved], nodes[root[moved]]


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0

    def out() -> pa.RecordBatch:
        u, v = (np.concatenate([x.column(c).to_numpy() for x in held]) for c in ("u", "v"))
        return pa.RecordBatch.from_arrays([pa.array(x) for x in contracted(u, v)], names=["u", "v"])

    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size > 4 * BLOCK_EDGES:  # of uneven files one task may read several blocks
            yield out()
            held, size = [], 0
    if size:
        yield out()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges (u, v)``; the root is the smallest node reachable.

    Tasks first contract their block of the edges, as they lie in their files, to stars; edges
    of one block are then done. Otherwise a round follows that shuffles what is left a few times,
    sums map-side first, and is written to the shared folder; rounds grow with the logarithm of
    a component's size. The driver sees one fingerprint of the edges a round.
    """
    now = stored(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    print_of = lambda df: df.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).head()
    before = print_of(now)
    while before[0]:
        blocks = -(-before[0] // BLOCK_EDGES)
        now = stored(now.coalesce(blocks).mapInArrow(_contracted, "u long, v long"), "edges")
        if blocks == 1:
            break
        now = stored(_small_star(_large_star(now)), "edges")
        after = print_of(now)
        if after == before:
            break
        before = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
