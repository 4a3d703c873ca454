"""Connected components of a graph given by its edges."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placemill.llm.common import stream_batches
from placemill.session import stable

FOREST_EDGES = 1 << 18  # edges that a task contracts at a time


def first_of_component(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The least node of each node's component, of nodes 0 to n - 1 with edges (a, b)."""
    label = np.arange(n)
    while True:
        of_a, of_b = label[a], label[b]
        if (of_a == of_b).all():
            return label
        np.minimum.at(label, np.maximum(of_a, of_b), np.minimum(of_a, of_b))
        while (label != (further := label[label])).any():
            label = further


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges (a, b, order_a, order_b), contracted in chunks of ``FOREST_EDGES``: each node with its chunk's first one in order."""
    def contracted(chunk: list[pa.RecordBatch]) -> pa.RecordBatch:
        a, b, order_a, order_b = (np.concatenate([c.column(i).to_numpy() for c in chunk]) for i in range(4))
        node, at, index = np.unique(np.concatenate([a, b]), return_index=True, return_inverse=True)
        by_order = np.lexsort((node, np.concatenate([order_a, order_b])[at]))
        place = np.empty(len(node), np.int64)
        place[by_order] = np.arange(len(node))
        ends = place[index]
        first = first_of_component(ends[:len(a)], ends[len(a):], len(node))
        moved = np.flatnonzero(first != np.arange(len(node)))
        return pa.record_batch([node[by_order[moved]], node[by_order[first[moved]]]], names=["a", "b"])

    chunk, held = [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, FOREST_EDGES):
            part = batch.slice(at, FOREST_EDGES)
            if held + part.num_rows > FOREST_EDGES:
                yield contracted(chunk)
                chunk, held = [], 0
            chunk.append(part)
            held += part.num_rows
    if held:
        yield contracted(chunk)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that has an edge to another; ``root`` is one node of its component.

    ``edges`` has two long columns (a, b). Each round draws an order of all nodes by hash. First, tasks contract their own edges
    to stars, in chunks of at most ``FOREST_EDGES``: each node of a chunk is tied to the first of those it is connected
    with. Then every node moves to the first among itself and those it is tied to, and the edges are contracted: a constant share of
    nodes vanishes, whatever the shape, and stars of one chunk vanish at once. A node's first neighbour is an aggregate with
    map-side combine, so a node with very many edges is no hot task. Rounds are written to the shared folder; their moves are
    joined up at the end.
    """
    current = stable(edges.where("a <> b").select("a", "b"), "edges")
    moves: list[DataFrame] = []
    while n := current.count():
        draw = lambda c, turn=len(moves): F.xxhash64(F.col(c), F.lit(turn))
        order = lambda c: F.struct(draw(c).alias("order"), F.col(c).alias("to"))
        drawn = current.select("a", "b", draw("a").alias("order_a"), draw("b").alias("order_b")).coalesce(-(-n // FOREST_EDGES))
        stars = stable(stream_batches(drawn, _stars, "a long, b long"), "stars")
        both = F.explode(F.array(F.struct(F.col("a").alias("node"), order("b").alias("other")),
                                 F.struct(F.col("b").alias("node"), order("a").alias("other")))).alias("e")
        first = stars.select(both).select("e.*").groupBy("node").agg(F.min("other").alias("other"))
        moved = stable(first.select("node", F.least(order("node"), "other")["to"].alias("root")), "moves")
        end = lambda c: moved.select(F.col("node").alias(c), F.col("root").alias(f"{c}_root"))
        a, b = F.col("a_root"), F.col("b_root")
        contracted = stars.join(end("a"), "a").join(end("b"), "b").where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
        current = stable(contracted.distinct(), "edges")
        moves.append(moved)

    def follow(sofar: DataFrame, moved: DataFrame) -> DataFrame:
        further = moved.select(F.col("node").alias("root"), F.col("root").alias("further"))
        return sofar.join(further, "root", "left").select("node", F.coalesce("further", "root").alias("root"))

    if not moves:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).where("false")
    return stable(reduce(follow, moves), "components")
