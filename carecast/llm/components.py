"""Connected components of a large edge table: forests of its parts, then alternating stars.

The edges are dealt to tasks of ``edges_a_task``, and each replaces its own by stars that
connect the same nodes, as long as no task meets another. If there is more than one, the
stars of all go on in rounds. Every round rewires each node's neighbours to the smallest one it knows
(large star, then small star); the table is written after each round, so the
lineage stays short and lost executors reread files. The smallest neighbours are
written before they are joined: a hub's edges may then be split over tasks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

EDGES_A_TASK = 200_000


def smallest_connected(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """For each of the nodes 0 .. n-1 the smallest that edges ``u`` - ``v`` connect it with."""
    root = np.arange(n)
    while True:
        low, high = np.minimum(root[u], root[v]), np.maximum(root[u], root[v])
        apart = low < high
        if not apart.any():
            return root
        np.minimum.at(root, high[apart], low[apart])  # roots go below smaller ones
        while (root[root] != root).any():
            root = root[root]


def numbered_nodes(nodes: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Each node's number in their order, and where each number stands first."""
    columns = nodes.flatten() if pa.types.is_struct(nodes.type) else [nodes]
    names = [str(k) for k in range(len(columns))]
    order = pc.sort_indices(pa.table(columns, names), [(k, "ascending") for k in names]).to_numpy()
    new = np.arange(len(order)) == 0
    for c in columns:
        c = c.to_numpy(zero_copy_only=False)[order]
        new[1:] |= c[1:] != c[:-1]
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(new) - 1
    return number, order[new]


def forests(edges: DataFrame, tasks: int) -> DataFrame:
    """Stars (u, v) in place of each task's edges (u, v), each centre with an edge to itself."""

    def run(batches):
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        nodes = pa.concat_arrays([b.column(c) for c in ("u", "v") for b in held])
        number, first = numbered_nodes(nodes)
        half = len(number) // 2
        root = smallest_connected(len(first), number[:half], number[half:])
        for k in range(0, len(first), 50_000):
            own = slice(k, k + 50_000)
            yield pa.RecordBatch.from_arrays([nodes.take(pa.array(first[own])), nodes.take(pa.array(first[root[own]]))], names=["u", "v"])

    return edges.select("u", "v").repartition(tasks).mapInArrow(run, edges.select("u", "v").schema)


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large(edges: DataFrame) -> DataFrame:
    near = _both(edges)
    least = materialize(near.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m")), "components-least")
    return near.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = materialize(down.groupBy("u").agg(F.min("v").alias("m")), "components-least")
    moved = down.join(least, "u")
    return (moved.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
            .unionByName(least.select("u", F.col("m").alias("v"))).distinct())


def components(edges: DataFrame, max_rounds: int = 50, edges_a_task: int = EDGES_A_TASK) -> DataFrame:
    """(node, component) of every node of ``edges`` (u, v; a written table, which is read twice); a component is named by its smallest node.

    Nodes of any orderable type without nulls. Isolated nodes have no edges and aren't listed.
    """
    joined = edges.where("u <> v")
    tasks = max(1, -(-joined.count() // edges_a_task))
    stars = materialize(forests(joined, tasks), "components-forests")
    if tasks > 1:
        stars = _settled(stars.where("u <> v").distinct(), max_rounds)
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component"))


def _settled(now: DataFrame, max_rounds: int) -> DataFrame:
    """The stars (u, v) of all components, each centre with an edge to itself."""
    state = None
    for _ in range(max_rounds):
        now = materialize(_small(materialize(_large(now), "components-large")), "components")
        # equal sums of hashes in two rounds: the stars have settled
        new = tuple(now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u", F.lit(1)))).first())
        if new == state:
            break
        state = new
    else:
        raise RuntimeError("components did not settle")
    return now.unionByName(now.select(F.col("v").alias("u"), "v").distinct())
