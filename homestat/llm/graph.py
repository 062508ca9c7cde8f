"""Connected components of an edge table, without collecting edges or labels."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from homestat.llm.common import stored

#: Edges contracted at once inside a task.
RUN_EDGES = 1_000_000


def local_roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, smallest node of each one's component) of some edges."""
    nodes, ends = np.unique(np.concatenate((a, b)), return_inverse=True)
    left, right = ends[:len(a)], ends[len(a):]
    parent = np.arange(len(nodes))
    while True:
        x, y = parent[left], parent[right]
        open_ = x != y
        if not open_.any():
            return nodes, nodes[parent]
        left, right, x, y = left[open_], right[open_], x[open_], y[open_]
        np.minimum.at(parent, np.maximum(x, y), np.minimum(x, y))
        while (parent != parent[parent]).any():
            parent = parent[parent]


def stars(edges: DataFrame) -> DataFrame:
    """Edges with the same components: every task ties the nodes it meets to the smallest it knows of."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def close() -> pa.RecordBatch:
            pairs = [np.concatenate([b.column(k).to_numpy() for b in held]) for k in (0, 1)]
            nodes, roots = local_roots(*pairs)
            other = nodes != roots
            return pa.RecordBatch.from_arrays([pa.array(roots[other]), pa.array(nodes[other])], names=["a", "b"])

        for batch in batches:
            held.append(batch)
            size += len(batch)
            if size >= RUN_EDGES:
                yield close()
                held, size = [], 0
        if size:
            yield close()

    return edges.select("a", "b").mapInArrow(run, "a long, b long")


def components(edges: DataFrame, name: str = "cc") -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); root is the component's smallest node.

    Contraction: in each round every node joins a neighbour (or stays), and the edges are rewritten
    between the joined nodes. Rounds take turns: to the smallest neighbour, which ends stars at once,
    and to the neighbour of least hashed priority, which takes a constant share of the nodes, so long
    chains need few rounds too. Before a round's edges are written, tasks contract what they hold. The
    neighbour chosen is pre-aggregated in the map tasks, so a hub costs no more than other nodes. A
    round writes its joins and its edges to the shared folder; the driver sees one flag a round.
    """
    left = stored(stars(edges.where(F.col("a") != F.col("b"))), name)
    joins = []
    while not left.isEmpty():
        turn = len(joins)
        rank = lambda c: F.struct((F.xxhash64(c, F.lit(turn)) if turn % 2 else F.lit(0)).alias("p"), c.alias("to"))
        both = left.select(F.col("a").alias("at"), rank(F.col("b")).alias("r")).union(
            left.select(F.col("b").alias("at"), rank(F.col("a")).alias("r")))
        best = both.groupBy("at").agg(F.min("r").alias("r"))
        joined = stored(best.select("at", F.least(F.col("r"), rank(F.col("at")))["to"].alias("to")), f"{name}-joined")
        joins.append(joined)
        to_a = joined.select(F.col("at").alias("a"), F.col("to").alias("na"))
        to_b = joined.select(F.col("at").alias("b"), F.col("to").alias("nb"))
        moved = left.join(to_a, "a").join(to_b, "b").where(F.col("na") != F.col("nb"))
        left = stored(stars(moved.select(F.col("na").alias("a"), F.col("nb").alias("b"))), name)
    if not joins:
        return left.select(F.col("a").alias("node"), F.col("a").alias("root"))
    labels = joins[0].select(F.col("at").alias("node"), F.col("to").alias("at"))
    for joined in joins[1:]:
        labels = labels.join(joined, "at", "left").select("node", F.coalesce("to", "at").alias("at"))
    if len(joins) > 1:
        labels = stored(labels, f"{name}-labels")
    least = labels.groupBy("at").agg(F.min("node").alias("root"))
    return labels.join(least, "at").select("node", "root")
