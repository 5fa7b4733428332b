"""Exact search for the largest inner products with cover trees over queries and vectors.

Vectors and queries are dealt into blocks around places that a bounded sample chooses as the top of a cover tree, and
each block gets a cover tree once. Every query block first meets the block whose centre promises most. After that a pair
of blocks meets only if their balls may hold a product that reaches the worst kth score of the query block; the others
are left out before any tree is copied. A task takes one block of queries and a run of vector blocks and walks both
trees together. A pair of nodes is left out if no inner product between their balls, bounded by centres and covering
radii, reaches the worst kth score within the query group.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame, SparkSession, Window

from ..operators.staging import materialize

BLOCK_ROWS, QUERY_ROWS = 4096, 1024
# Vector blocks that one task compares with one query block, one after the other.
RUN = 64
# Vectors of a length that choose the places of blocks, and their bytes, at most; places; lengths that have any (the most
# frequent ones, the others are dealt by hash alone). Results do not depend on them.
SAMPLE_ROWS, SAMPLE_BYTES, MOST_PLACES, MOST_LENGTHS = 4096, 1 << 23, 256, 16
# Parts that a place may have.
_PART_BITS = 22
# A node is not divided if it is small or needs more balls of half its radius than this.
LEAF, MOST_CHILDREN = 64, 32
# Beyond this inner products are not exact as doubles; whole numbers decide then, after bounds by doubles.
EXACT = 2.0**52
# Ends of the range of a result.
LEAST, MOST = -(2**63), 2**63 - 1


@dataclass
class Node:
    """A ball around row ``centre`` that covers the rows ``low`` to ``high``; children cover parts of them."""

    centre: int
    radius: float
    low: int
    high: int
    children: list[Node]


@dataclass
class Tree:
    """Rows in the order of the tree, with ids and the place of each id among those of the block.

    ``points`` are doubles, ``whole`` the same components as whole numbers.
    """

    ids: np.ndarray
    rank: np.ndarray
    points: np.ndarray
    norms: np.ndarray
    root: Node
    whole: np.ndarray

    @classmethod
    def build(cls, ids: np.ndarray, points: np.ndarray) -> Tree:
        whole, points = points, points.astype(np.float64)
        order: list[int] = []

        def place(rows: np.ndarray, centre: int) -> Node:
            away = np.sqrt(((points[rows] - points[centre]) ** 2).sum(axis=1))
            radius, low = float(away.max()), len(order)
            groups = _balls(points, rows, centre, away, radius / 2) if len(rows) > LEAF and radius > 0 else []
            if not groups:
                order.extend(rows.tolist())
            children = [place(held, c) for c, held in groups]
            return Node(centre, radius, low, len(order), children)

        middle = int(((points - points.mean(axis=0)) ** 2).sum(axis=1).argmin())
        root = place(np.arange(len(ids)), middle)
        took = np.array(order)
        where = np.empty_like(took)
        where[took] = np.arange(len(took))

        def renumber(node: Node) -> None:
            node.centre = int(where[node.centre])
            for child in node.children:
                renumber(child)

        renumber(root)
        rank = np.argsort(np.argsort(ids, kind="stable"), kind="stable")
        return cls(ids[took], rank[took], points[took], np.sqrt((points[took] ** 2).sum(axis=1)), root, whole[took])


def _balls(points: np.ndarray, rows: np.ndarray, centre: int, away: np.ndarray, radius: float) -> list:
    """Groups of rows around centres more than ``radius`` apart, the node's own centre first; each row is with its
    nearest centre. Empty if that takes too many."""
    centres, nearest, owner = [centre], away.copy(), np.zeros(len(rows), dtype=int)
    while nearest.max() > radius:
        if len(centres) == MOST_CHILDREN:
            return []
        centres.append(int(rows[int(nearest.argmax())]))
        other = np.sqrt(((points[rows] - points[centres[-1]]) ** 2).sum(axis=1))
        closer = other < nearest
        nearest[closer], owner[closer] = other[closer], len(centres) - 1
    return [(c, rows[owner == k]) for k, c in enumerate(centres)]


class Best:
    """The k best of each query so far.

    Once inner products may be too large for doubles, ``exact`` holds them as whole numbers, and ``scores`` no more than
    bounds of the worst ones.
    """

    def __init__(self, queries: Tree, k: int, floor: float = -np.inf) -> None:
        """``floor``: the worst kth score that is known already; lower ones are of no use."""
        self.queries, self.k, self.floor = queries, k, floor
        self.scores = np.full((len(queries.ids), k), -np.inf)
        self.ids = np.full((len(queries.ids), k), np.iinfo(np.int64).max)
        self.exact: list[list[tuple[int, int]]] | None = None

    def meet(self, vectors: Tree) -> None:
        """Walk both trees, the most promising pairs of nodes first."""
        if self.exact is None and self.queries.norms.max() * vectors.norms.max() > EXACT:
            self.exact = [
                [(-int(s), int(i)) for s, i in zip(*row, strict=True) if np.isfinite(s)]
                for row in zip(self.scores, self.ids, strict=True)
            ]
        waiting = [(self.queries.root, vectors.root)]
        while waiting:
            mine, theirs = waiting.pop()
            if self._bound(vectors, mine, theirs) < max(self.floor, self.scores[mine.low : mine.high, -1].min()):
                continue
            if not mine.children and not theirs.children:
                self._compare(vectors, mine, theirs)
                continue
            split_theirs = theirs.children and (not mine.children or theirs.radius >= mine.radius)
            pairs = [(mine, t) for t in theirs.children] if split_theirs else [(m, theirs) for m in mine.children]
            waiting += sorted(pairs, key=lambda p: self._bound(vectors, *p))

    def _bound(self, vectors: Tree, mine: Node, theirs: Node) -> float:
        q, v = self.queries.points[mine.centre], vectors.points[theirs.centre]
        product = float(q @ v) + mine.radius * vectors.norms[theirs.centre] + theirs.radius * (
            self.queries.norms[mine.centre] + mine.radius
        )
        # Rounding must not lose a tie.
        rounding = 1e-9 * (1.0 + abs(product)) + 1e-12 * self.queries.norms[mine.centre] * vectors.norms[theirs.centre]
        return min(product + rounding, float(MOST))

    def _compare_whole(self, vectors: Tree, mine: Node, theirs: Node) -> None:
        """Doubles with the bound of their error choose the candidates, whole numbers their order."""
        at, to = slice(mine.low, mine.high), slice(theirs.low, theirs.high)
        scores = self.queries.points[at] @ vectors.points[to].T
        error = (scores.shape[1] + vectors.points.shape[1] + 8) * 2.0**-52 * np.outer(self.queries.norms[at], vectors.norms[to])
        high, low = (np.clip(scores + e, LEAST, MOST) for e in (error, -error))
        other = self.queries.ids[at, None] != vectors.ids[None, to]
        for i in range(mine.high - mine.low):
            able = np.nonzero(other[i] & (high[i] >= max(self.floor, self.scores[mine.low + i, -1])))[0]
            if len(able) > self.k:
                able = able[high[i, able] >= np.partition(low[i, able], -self.k)[-self.k]]
            if len(able):
                query = self.queries.whole[mine.low + i].astype(object)
                products = vectors.whole[to][able].astype(object) @ query
                found = [(-min(max(int(p), LEAST), MOST), int(v)) for p, v in zip(products, vectors.ids[to][able], strict=True)]
                best = self.exact[mine.low + i] = sorted(self.exact[mine.low + i] + found)[: self.k]
                if len(best) == self.k:
                    worst = float(-best[-1][0])
                    self.scores[mine.low + i, -1] = worst - abs(worst) * 2.0**-50

    def _compare(self, vectors: Tree, mine: Node, theirs: Node) -> None:
        if self.exact is not None:
            self._compare_whole(vectors, mine, theirs)
            return
        at, to = slice(mine.low, mine.high), slice(theirs.low, theirs.high)
        scores = self.queries.points[at] @ vectors.points[to].T
        scores[self.queries.ids[at, None] == vectors.ids[None, to]] = -np.inf
        able = np.nonzero(scores.max(axis=1) >= np.maximum(self.scores[at, -1], self.floor))[0]
        if not len(able):
            return
        scores = scores[able]
        order = np.argsort(vectors.rank[to], kind="stable")
        scores = scores[:, order]
        if scores.shape[1] > 4 * self.k:
            # Smaller ids come first here, so a stable choice among equals keeps the right ones.
            worst = -np.partition(-scores, self.k - 1, axis=1)[:, self.k - 1 : self.k]
            above, equal = scores > worst, scores == worst
            room = self.k - above.sum(axis=1, keepdims=True)
            chosen = above | (equal & (np.cumsum(equal, axis=1) <= room))
            columns = np.nonzero(chosen)[1].reshape(len(able), self.k)
            scores = np.take_along_axis(scores, columns, axis=1)
            ids = vectors.ids[to][order][columns]
        else:
            ids = np.broadcast_to(vectors.ids[to][order], scores.shape)
        rows = mine.low + able
        scores = np.concatenate((self.scores[rows], scores), axis=1)
        ids = np.concatenate((self.ids[rows], ids), axis=1)
        best = np.lexsort((ids, -scores), axis=1)[:, : self.k]
        self.scores[rows] = np.take_along_axis(scores, best, axis=1)
        self.ids[rows] = np.take_along_axis(ids, best, axis=1)

    def rows(self) -> pd.DataFrame:
        """The best of each query row, and the number of that row in its block."""
        names = ["row", "query_id", "vec_id", "score"]
        if self.exact is not None:
            found = [(r, int(self.queries.ids[r]), i, -s) for r, best in enumerate(self.exact) for s, i in best]
            return pd.DataFrame(found, columns=names, dtype=np.int64)
        at, column = np.nonzero(np.isfinite(self.scores))
        held = at, self.queries.ids[at], self.ids[at, column], self.scores[at, column].astype(np.int64)
        return pd.DataFrame(dict(zip(names, held, strict=True)))


def _tree(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("id", kind="stable")
    tree = Tree.build(rows["id"].to_numpy(), np.stack(rows["vector"].to_list()))
    state = (tree.ids, tree.rank, tree.whole.astype(_narrow(tree.whole)), _plain(tree.root))
    known = {name: [int(rows[name].iloc[0])] for name in ("size", "block")}
    centre = tree.points[tree.root.centre]
    ball = {"centre": [centre], "radius": [tree.root.radius], "norm": [float(np.sqrt((centre**2).sum()))], "n": [len(tree.ids)]}
    return pd.DataFrame(known | ball | {"tree": [pickle.dumps(state)]})


def _narrow(whole: np.ndarray) -> type:
    return next(t for t in (np.int16, np.int32, np.int64) if np.iinfo(t).min <= whole.min() and whole.max() <= np.iinfo(t).max)


def _plain(node: Node) -> tuple:
    return node.centre, node.radius, node.low, node.high, [_plain(c) for c in node.children]


def _read(blob: bytes) -> Tree:
    ids, rank, whole, root = pickle.loads(blob)
    points = whole.astype(np.float64)

    def node(plain: tuple) -> Node:
        return Node(*plain[:4], [node(c) for c in plain[4]])

    return Tree(ids, rank, points, np.sqrt((points**2).sum(axis=1)), node(root), whole)


def _searched(k: int):
    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows come sorted: the tree of a query block, then the vector trees of its run."""
        best, known = None, {}
        for batch in batches:
            for row in batch.itertuples(index=False):
                if row.block < 0:
                    if best is not None:
                        yield best.rows().assign(**known)
                    floor = -np.inf if row.floor is None or np.isnan(row.floor) else float(row.floor)
                    best, known = Best(_read(row.tree), k, floor), {"size": row.size, "asker": row.asker}
                else:
                    best.meet(_read(row.tree))
        if best is not None:
            yield best.rows().assign(**known)

    return search


@contextmanager
def batches_of(spark: SparkSession, rows: int):
    """Arrow batches of so few rows while the block runs."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def places_of(sample: np.ndarray, wanted: int) -> np.ndarray:
    """Centres far from each other: the one in the middle, then again and again the vector farthest from all."""
    sample = sample.astype(np.float64)
    chosen = [int(((sample - sample.mean(axis=0)) ** 2).sum(axis=1).argmin())]
    away = ((sample - sample[chosen[0]]) ** 2).sum(axis=1)
    while len(chosen) < wanted and away.max() > 0:
        chosen.append(int(away.argmax()))
        away = np.minimum(away, ((sample - sample[chosen[-1]]) ** 2).sum(axis=1))
    return sample[chosen]


def _places(rows: DataFrame) -> dict[int, np.ndarray]:
    """Places by length, from a sample of the vectors of the most frequent lengths."""
    counted = rows.groupBy("size").count().filter(F.col("count") > BLOCK_ROWS)
    found = {}
    for size, count in counted.orderBy(F.desc("count"), "size").limit(MOST_LENGTHS).collect():
        most = max(1, min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * size)))
        mine = rows.filter(F.col("size") == size)
        share = min(1.0, most / count)
        early = F.pmod(F.xxhash64("place"), F.lit(1 << 30)) < int(share * (1 << 30))
        drawn = mine.filter(early).select("place", "vector").toArrow().sort_by("place").column("vector").combine_chunks()
        sample = drawn.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
        if len(sample):
            found[size] = places_of(sample, min(MOST_PLACES, -(-count // BLOCK_ROWS)))
    return found


def _nearest_place(places: dict[int, np.ndarray]):
    def spots(sizes: pd.Series, vectors: pd.Series) -> pd.Series:
        out = np.zeros(len(sizes), dtype=np.int32)
        for size, centres in places.items():
            here = np.nonzero(sizes.to_numpy() == size)[0]
            if len(here):
                mine = np.stack(vectors.iloc[here].to_list()).astype(np.float64)
                out[here] = ((centres**2).sum(axis=1)[None] - 2 * (mine @ centres.T)).argmin(axis=1)
        return pd.Series(out)

    return spots


def _trees(rows: DataFrame, block_rows: int, label: str) -> DataFrame:
    """One row per block, with its ball. Vectors of different length or place are in different blocks."""
    sizes = rows.groupBy("size", "spot").agg(F.ceil(F.count("*") / block_rows).alias("parts"))
    part = F.pmod(F.xxhash64("place"), F.col("parts")).cast("int")
    dealt = rows.join(sizes, ["size", "spot"]).withColumn("block", F.shiftleft("spot", _PART_BITS) + part)
    kinds = "size int, block int, centre array<double>, radius double, norm double, n long, tree binary"
    return materialize(dealt.drop("parts", "spot").groupBy("size", "block").applyInPandas(_tree, kinds), label)


def _bounds(askers: DataFrame, data: DataFrame) -> DataFrame:
    """Pairs of blocks of one length, without trees: what their balls may reach, and the product of their centres."""
    balls = [F.col(c) for c in ("centre", "radius", "norm")]
    mine = askers.select("size", F.col("block").alias("asker"), *(c.alias(f"q{i}") for i, c in enumerate(balls)))
    theirs = data.select("size", "block", *(c.alias(f"v{i}") for i, c in enumerate(balls)))
    middle = F.aggregate(F.zip_with("q0", "v0", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    reach = F.col("q1") * F.col("v2") + F.col("v1") * (F.col("q2") + F.col("q1"))
    # Rounding must not lose a tie.
    slack = 1e-9 * (1.0 + F.abs("middle") + F.col("q2") * F.col("v2"))
    met = mine.join(theirs, "size").withColumn("middle", middle)
    return met.select("size", "asker", "block", "middle", F.least(F.col("middle") + reach + slack, F.lit(float(MOST))).alias("bound"))


def _met(pairs: DataFrame, asked: DataFrame, data: DataFrame, k: int) -> DataFrame:
    """The best of the pairs ``size, asker, block, bound, floor``, in runs of blocks, the most promising first."""
    turn = F.row_number().over(Window.partitionBy("size", "asker").orderBy(F.desc("bound"), "block")) - 1
    runs = pairs.withColumn("turn", turn).withColumn("run", F.floor(F.col("turn") / RUN).cast("int"))
    theirs = runs.join(data, ["size", "block"]).select("size", "asker", "run", "turn", "block", "tree")
    tasks = runs.select("size", "asker", "run", "floor").distinct()
    mine = tasks.join(asked.withColumnRenamed("block", "asker"), ["size", "asker"]).select(
        "size", "asker", "run", F.lit(-1).alias("turn"), F.lit(-1).alias("block"), "tree", "floor")
    meetings = mine.unionByName(theirs, allowMissingColumns=True).repartition(max(1, tasks.count()), "size", "asker", "run")
    ordered = meetings.sortWithinPartitions("size", "asker", "run", "turn").select("size", "asker", "block", "tree", "floor")
    kinds = "row long, query_id long, vec_id long, score long, size int, asker int"
    with batches_of(data.sparkSession, 8):
        return materialize(ordered.mapInPandas(_searched(k), kinds), "found")


def nearest(vectors: DataFrame, k: int, is_query: Column, id_col: str = "vec_id", vector_col: str = "vector"
            ) -> DataFrame:
    """The ``k`` largest inner products of each query with the rows of other ids: ``query_id, rank, vec_id, score``.

    Vectors are arrays of whole numbers. Ties go to the smaller id; a query with fewer than ``k`` other rows gets all.
    Vectors that are NULL, empty or hold a NULL, and rows without an id, take no part; a query meets the vectors of its
    own length. Rows of one id count as that many rows, and none is a result of a query of the same id. Inner products
    are exact, whatever their size; beyond the range of a long they count as its ends. An empty table gives an empty
    result.
    """
    spark = vectors.sparkSession
    vector = F.col(vector_col)
    whole = materialize(
        vectors.select(F.col(id_col).cast("bigint").alias("id"), vector.cast("array<bigint>").alias("vector"),
                       F.coalesce(is_query, F.lit(False)).alias("asks"), F.monotonically_increasing_id().alias("place"))
        .filter(F.col("id").isNotNull() & (F.size("vector") > 0) & ~F.exists("vector", F.isnull)), "vectors",
    )
    sized = whole.withColumn("size", F.size("vector"))
    spot = F.pandas_udf(_nearest_place(_places(sized)), "int")
    with batches_of(spark, 1000):
        dealt = materialize(sized.withColumn("spot", spot("size", "vector")), "placed").select(
            "size", "spot", "id", "vector", "place", "asks")
    data = _trees(dealt.drop("asks"), BLOCK_ROWS, "vector-trees")
    asked = _trees(dealt.filter("asks").drop("asks"), QUERY_ROWS, "query-trees")
    pairs = materialize(_bounds(asked, data), "pairs")
    promise = F.row_number().over(Window.partitionBy("size", "asker").orderBy(F.desc("middle"), "block"))
    ranked = pairs.withColumn("promise", promise)
    first = _met(ranked.filter("promise = 1").withColumn("floor", F.lit(None).cast("double")), asked, data, k)
    # The worst kth score of each query block, if every query has k of them.
    worst = first.groupBy("size", "asker", "row").agg(F.count("*").alias("held"), F.min("score").alias("least"))
    worst = worst.filter(F.col("held") == k).groupBy("size", "asker").agg(F.count("*").alias("full"), F.min("least").alias("least"))
    sizes = asked.select("size", F.col("block").alias("asker"), "n")
    floors = sizes.join(worst, ["size", "asker"]).filter(F.col("full") == F.col("n"))
    # As a double it must not be above the score.
    floor = F.col("least").cast("double") - F.abs(F.col("least").cast("double")) * 2.0**-50
    floors = floors.select("size", "asker", floor.alias("floor"))
    rest = ranked.filter("promise > 1").join(floors, ["size", "asker"], "left")
    left = materialize(rest.filter("floor IS NULL OR bound >= floor").drop("middle", "promise"), "meetings")
    found = first.unionByName(_met(left, asked, data, k)).select("query_id", "vec_id", "score")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
