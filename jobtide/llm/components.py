"""Connected components of a table of links, without gathering links or components anywhere."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide.llm.scratch import written
from jobtide.llm.texts import ship

#: Links a task looks at together before it hands on what connects them.
TOGETHER = 1 << 18


def star_forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes that these links tie to a smaller one, and the smallest node they tie each to."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    left, right = at[: len(u)], at[len(u) :]
    root = np.arange(len(nodes))
    while len(left):
        low, high = np.minimum(root[left], root[right]), np.maximum(root[left], root[right])
        apart = low < high
        left, right = left[apart], right[apart]
        np.minimum.at(root, high[apart], low[apart])
        while (root[root] != root).any():
            root = root[root]
    tied = np.flatnonzero(root < np.arange(len(nodes)))
    return nodes[tied], nodes[root[tied]]


def fewer_links(links: DataFrame) -> DataFrame:
    """Links (u, v) that connect the same nodes as these: in each task only stars, without rings and repeats."""

    def run(batches):
        held, size = [], 0
        for batch in batches:
            held.append([batch.column(k).to_numpy(zero_copy_only=False) for k in range(2)])
            size += batch.num_rows
            if size >= TOGETHER:
                yield stars(held)
                held, size = [], 0
        if size:
            yield stars(held)

    def stars(held):
        found = star_forest(*(np.concatenate(column) for column in zip(*held)))
        return pa.RecordBatch.from_arrays([pa.array(x) for x in found], ["u", "v"])

    ship(links.sparkSession)
    return links.select("u", "v").mapInArrow(run, "u long, v long")


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """(node, label) for every node with a link; nodes have one label if links connect them.

    Each task first replaces the links it reads by stars.  Each round points every node to the first of itself and its neighbours and contracts the graph to
    those pointed at, until no link is left between different nodes.  The first round takes the
    smallest id, which settles groups linked to their smallest member; later rounds take the order
    of a hash, a new one each round, so that a long chain shrinks by a constant factor whatever its
    ids.  Each round's tables are written, so lineage stays short; a hot node is summed up in the
    tasks that read its links.
    """
    edges = links.select(F.col(left).alias("u"), F.col(right).alias("v")).where("u <> v")
    edges = written(fewer_links(written(edges, "cc-links")), "cc-edges")
    labels, turn = None, 0
    while True:
        both = edges.union(edges.select("v", "u"))
        rank = F.col("v") if turn == 0 else F.xxhash64("v", F.lit(turn))
        own = F.col("u") if turn == 0 else F.xxhash64("u", F.lit(turn))
        first = both.groupBy("u").agg(F.min(F.struct(rank.alias("r"), F.col("v").alias("v"))).alias("m"))
        here = F.struct(own.alias("r"), F.col("u").alias("v"))
        points = written(first.select(F.col("u").alias("node"), F.least("m", here)["v"].alias("to")), "cc-points")
        if labels is None:
            labels = points.select("node", F.col("to").alias("label"))
        else:
            moved = labels.join(points.withColumnRenamed("node", "label"), "label", "left")
            labels = written(moved.select("node", F.coalesce("to", "label").alias("label")), "cc-labels")
        ahead = edges.join(points.withColumnsRenamed({"node": "u", "to": "pu"}), "u")
        ahead = ahead.join(points.withColumnsRenamed({"node": "v", "to": "pv"}), "v")
        ahead = ahead.where("pu <> pv").select(F.least("pu", "pv").alias("u"), F.greatest("pu", "pv").alias("v"))
        edges = written(fewer_links(ahead), "cc-edges")
        if edges.isEmpty():
            return labels
        turn += 1
