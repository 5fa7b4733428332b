"""Connected components of a graph given as edges, by union-find in each task and star steps between tasks."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyspark.sql.functions as F
from pyspark.sql import DataFrame

from ..operators.staging import materialize
from .common import few_files

# Nodes that a task's union-find holds before it hands on what it has.
MOST_NODES = 500_000


def _forest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each node of a task's edges with the smallest node it is connected with there."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while (up := parent.setdefault(top, top)) != top:
            top = up
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    def told() -> pd.DataFrame:
        found = [(x, root(x)) for x in parent]
        return pd.DataFrame([f for f in found if f[0] != f[1]], columns=["u", "v"], dtype="int64")

    for batch in batches:
        for a, b in zip(batch["a"].tolist(), batch["b"].tolist(), strict=True):
            x, y = root(a), root(b)
            if x != y:
                parent[max(x, y)] = min(x, y)
        if len(parent) > MOST_NODES:
            yield told()
            parent.clear()
    yield told()


def _linked(edges: DataFrame, least: DataFrame) -> DataFrame:
    """Edges with the smallest neighbour of their first node; ``least`` is a table, so a hot node can be split."""
    return edges.join(least, edges["u"] == least["node"]).select("u", "v", "least")


def _large_star(edges: DataFrame, count: int) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("m")).select(
        "node", F.least("node", "m").alias("least")
    )
    least = materialize(few_files(least, 2 * count), "large-star")
    return (
        _linked(both, least).filter("v > u").select(F.col("v").alias("u"), F.col("least").alias("v"))
        .filter("u <> v").distinct()
    )


def _small_star(edges: DataFrame, count: int) -> DataFrame:
    least = edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("least"))
    least = materialize(few_files(least, 2 * count), "small-star")
    found = _linked(edges, least)
    moved = found.select(F.explode(F.array("u", "v")).alias("u"), F.col("least").alias("v"))
    return moved.filter("u <> v").distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` of every node with an edge, ``label`` being the smallest node that it can reach.

    ``edges`` has two longs ``a`` and ``b``; loops and repeated edges do no harm. Edges are stored after each round in
    the shared folder. The rounds grow with the logarithm of the number of nodes, not with the length of paths.
    """
    given = edges.count()
    stars = edges.mapInPandas(_forest, "u long, v long").distinct()
    stars = materialize(few_files(stars, 2 * given), "forest")
    state = _state(stars)
    while state[0]:
        moved = _small_star(_large_star(stars, state[0]), state[0])
        stars = materialize(few_files(moved, 2 * state[0]), "stars")
        before, state = state, _state(stars)
        if state == before:
            break
    leaves = stars.select(F.col("u").alias("node"), F.col("v").alias("label"))
    roots = stars.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return leaves.unionByName(roots)
