"""Connected components of a link table: every task contracts the links it holds, large-star
and small-star steps join what lies in different tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import drop_table, materialise

#: Nodes with more links than this are handled as hubs; at most HUBS of them, as the limit grows with the links.
HUB_LINKS = 256
HUBS = 1 << 16
#: Links that a task contracts at once.
BLOCK = 1 << 19


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(u, v) links -> links of the same nodes and components, every node to the smallest one of its part of a block."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        held.append(b)
        if sum(x.num_rows for x in held) >= BLOCK:
            yield _stars_of(held)
            held = []
    if held:
        yield _stars_of(held)


def _stars_of(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    t = pa.Table.from_batches(held)
    nodes, at = np.unique(np.concatenate([t["u"].to_numpy(), t["v"].to_numpy()]), return_inverse=True)
    a, b = at[:t.num_rows], at[t.num_rows:]
    root = np.arange(len(nodes))
    while (root[a] != root[b]).any():
        # The larger root of a link hangs below the smaller one, then all chains are shortened.
        high, low = np.maximum(root[a], root[b]), np.minimum(root[a], root[b])
        np.minimum.at(root, high, low)
        while (root != root[root]).any():
            root = root[root]
    member = np.flatnonzero(root != np.arange(len(nodes)))
    return pa.RecordBatch.from_arrays([pa.array(nodes[member]), pa.array(nodes[root[member]])], names=["u", "v"])


def _stars_only(links: DataFrame) -> bool:
    """Whether every node has one smaller neighbour at most, or is such a neighbour itself."""
    ends = links.select(F.col("u").alias("node"), F.col("v").alias("to")).unionByName(
        links.select(F.col("v").alias("node"), F.lit(None).cast("long").alias("to")))
    nodes = ends.groupBy("node").agg(F.min("to").alias("lo"), F.max("to").alias("hi"), F.count_if(F.col("to").isNull()).alias("centre"))
    return nodes.filter("lo <> hi or (lo is not null and centre > 0)").isEmpty()


def _to_least(links: DataFrame, least: DataFrame, n_links: int) -> DataFrame:
    """(u, v) links with the smallest node m of u's group; `least` has a row (u, m, n) per node, n its links.

    The links of one node would meet in one task.  Nodes with more than
    max(HUB_LINKS, links / HUBS) links are at most HUBS, so their rows, two longs
    each, are broadcast and their links stay where they are; all others
    have few links, and meet their row by a join on the node."""
    limit = max(HUB_LINKS, -(-n_links // HUBS))
    hubs = F.broadcast(least.filter(F.col("n") > limit).select("u", "m"))
    few = least.filter(F.col("n") <= limit).select("u", "m")
    return links.join(hubs, "u").unionByName(links.join(hubs.select("u"), "u", "left_anti").join(few, "u"))


def components(links: DataFrame, name: str) -> DataFrame:
    """(a, b) links between longs -> (node, root), the smallest node reachable, for every linked node.

    Within a task the links are contracted, so that what a few tasks hold needs no
    round.  Each round every node then hands its larger neighbours, then its smaller
    ones, to the smallest node it knows; rounds grow with the logarithm of the longest
    chain.  Every round is written to the shared folder, so lineage stays short.
    """
    far, near = F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")

    def contracted(rows: DataFrame) -> DataFrame:
        return materialise(rows.distinct().mapInArrow(_contract, "u long, v long"), name)

    now = contracted(links.select(far, near).filter("u <> v"))
    while not _stars_only(now):
        n_links = now.count()
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = materialise(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"), F.count(F.lit(1)).alias("n")), name)
        large = _to_least(both, least, 2 * n_links).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        large = materialise(large, name)  # repeats are dropped once a round, below
        low = materialise(large.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")), name)
        small = _to_least(large, low, 2 * n_links).select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        step = contracted(small.unionByName(low.select("u", F.col("m").alias("v"))))
        for scratch in (now, least, large, low):
            drop_table(scratch)
        now = step
    stars = now.distinct()
    return stars.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        stars.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
