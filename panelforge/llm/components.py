"""Connected components of an edge table by alternating large-star and small-star steps, all in joins and grouping.

Each task first joins the edges that it holds into stars, in bounded memory, so that few rounds over all edges are left.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_written, written


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node links its larger neighbours to the smallest of its neighbours and itself."""
    arcs = _both_ways(edges)
    least = arcs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return arcs.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node links itself and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


#: Edges that a task joins at a time.
_HELD = 1 << 18


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For every _HELD edges of a task: each node with the smallest node that it reaches by them."""

    def joined(us: list[int], vs: list[int]) -> pa.RecordBatch:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while parent.setdefault(x, x) != x:
                parent[x] = x = parent[parent[x]]
            return x

        for u, v in zip(us, vs):
            a, b = root(u), root(v)
            parent[max(a, b)] = min(a, b)
        ends = {x: root(x) for x in parent}
        stars = [(x, r) for x, r in ends.items() if x != r]
        return pa.RecordBatch.from_arrays([pa.array([x for x, _ in stars], pa.int64()), pa.array([r for _, r in stars], pa.int64())], ["u", "v"])

    held: tuple[list[int], list[int]] = ([], [])
    for batch in itertools.chain(batches, [None]):
        if batch is not None:
            held[0].extend(batch.column(0).to_pylist())
            held[1].extend(batch.column(1).to_pylist())
        if held[0] and (batch is None or len(held[0]) >= _HELD):
            yield joined(*held)
            held = ([], [])


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v), longs that are not null: component is the smallest reachable.

    Each round ends in a table in the shared folder. No node's neighbours are
    ever gathered: a round only takes minima, so a node with very many edges costs no more memory than another. The
    result reads a table that ``drop_written`` of the result deletes.
    """
    rows = edges.where("u <> v").select(F.col("u").cast("long").alias("u"), F.col("v").cast("long").alias("v"))
    current = written(rows.mapInArrow(_stars, "u long, v long").distinct(), "edges")
    before = None
    for _ in range(most_rounds):
        stars = _small_star(_large_star(current).where("u <> v").distinct()).where("u <> v").distinct()
        after = written(stars, "edges")
        now = after.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        drop_written(current)
        current = after
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    out = current.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
    out._written_path = current._written_path
    return out
