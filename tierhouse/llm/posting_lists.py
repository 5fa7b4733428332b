"""Approximate search for the largest inner products with balanced posting lists.

With one more component, which brings all vectors to the largest norm, the largest inner product is the smallest
distance. A bounded sample is halved along its main direction until there are as many equal parts as lists; their means
are the centroids, joined to a small graph that every task walks in memory. A vector goes to the list of its nearest
centroid, and at a boundary to further ones. A query searches the lists whose centroids are not much farther than the
nearest one; how much is found from the sample. Lists are compared in blocks, and the best are ordered by exact scores.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame, Window

from ..operators.staging import materialize
from .cover_tree import batches_of

# Vectors the index is fitted on at most (give or take what a hash's share varies by), and their bytes; vectors per list, and sampled vectors per list at least.
SAMPLE_ROWS, SAMPLE_BYTES = 65_536, 1 << 25
LIST_ROWS, SAMPLED_PER_LIST = 1024, 16
# Links of a centroid, and where a walk begins.
LINKS, DOORS = 16, 8
# A vector is in this many lists at most, whose centroids are at most so much farther than the nearest.
MOST_COPIES, BOUNDARY = 4, 1.1
# Share of the sample's nearest vectors that the searched lists shall hold, and sampled queries that decide it.
AIM, TRIAL_QUERIES = 0.97, 128
# Bytes of a block of vectors, and blocks of lists that a block of queries meets in one task, one after the other.
BLOCK_BYTES, RUN = 1 << 19, 64


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    square = (a**2).sum(axis=1)[:, None] + (b**2).sum(axis=1)[None] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(square, 0))


def _halved(points: np.ndarray, rows: np.ndarray, lists: int) -> list[np.ndarray]:
    """``lists`` parts of about equal size, cut across the main direction of each."""
    if lists == 1:
        return [rows]
    mine = points[rows] - points[rows].mean(axis=0)
    axis = mine[np.argmax((mine**2).sum(axis=1))]
    for _ in range(8):  # power iteration
        axis = mine.T @ (mine @ axis)
        axis /= np.linalg.norm(axis) or 1.0
    order = rows[np.argsort(mine @ axis, kind="stable")]
    first = lists // 2
    cut = len(rows) * first // lists
    return _halved(points, order[:cut], first) + _halved(points, order[cut:], lists - first)


@dataclass
class Lists:
    """Centroids in the space with one more component, their graph, and what a search does."""

    scale: float
    norm: float
    centroids: np.ndarray
    links: np.ndarray
    apart: np.ndarray
    ratio: float = 1.0
    beam: int = 1

    @classmethod
    def fit(cls, sample: np.ndarray, scale: float, norm: float, lists: int, k: int) -> Lists:
        made = cls(scale, norm, np.zeros((0, 0)), np.zeros((0, 0), dtype=int), np.zeros((0, 0)))
        points = made.lifted(sample)
        parts = _halved(points, np.arange(len(points)), lists)
        made.centroids = np.stack([points[p].mean(axis=0) for p in parts])
        made.apart = _distances(made.centroids, made.centroids)
        # The nearest centroids, and the neighbours in the order of the cuts, so that no part of the graph is cut off.
        near = np.argsort(made.apart, axis=1, kind="stable")[:, 1 : 1 + LINKS]
        place = np.arange(lists)[:, None]
        made.links = np.concatenate((near, (place + 1) % lists, (place - 1) % lists), axis=1)
        made._try(sample, k)
        return made

    def lifted(self, vectors: np.ndarray) -> np.ndarray:
        small = vectors * self.scale
        return np.column_stack((small, np.sqrt(np.maximum(0, self.norm**2 - (small**2).sum(axis=1)))))

    def asking(self, vectors: np.ndarray) -> np.ndarray:
        """Queries have no further component; only their direction counts."""
        small = vectors * self.scale
        small *= self.norm / np.sqrt((small**2).sum(axis=1, keepdims=True))
        return np.column_stack((small, np.zeros(len(small))))

    def walk(self, points: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """The nearest centroids found by best-first walks of all points at once: numbers and distances, ascending."""
        count, lists = len(points), len(self.centroids)
        beam = min(beam, lists)
        doors = np.unique(np.linspace(0, lists - 1, DOORS).astype(int))
        seen = np.zeros((count, lists), dtype=bool)
        seen[:, doors] = True
        away = _distances(points, self.centroids[doors])
        held = np.broadcast_to(doors, away.shape)
        done = np.zeros(away.shape, dtype=bool)
        able = np.arange(count)
        while len(able):
            waiting = np.where(done[able], np.inf, away[able])
            at = waiting.argmin(axis=1)
            able, at = able[np.isfinite(waiting[np.arange(len(able)), at])], at[np.isfinite(waiting.min(axis=1))]
            if not len(able):
                break
            done[able, at] = True
            nodes = self.links[held[able, at]]
            fresh = ~seen[able[:, None], nodes]
            seen[able[:, None], nodes] = True
            # A node can stand twice among the links; the second one is no news.
            order = np.argsort(nodes, axis=1, kind="stable")
            twice = np.zeros(nodes.shape, dtype=bool)
            same = np.diff(np.take_along_axis(nodes, order, axis=1), axis=1) == 0
            np.put_along_axis(twice, order[:, 1:], same, axis=1)
            gap = self.centroids[nodes] - points[able][:, None, :]
            far = np.where(fresh & ~twice, np.sqrt((gap**2).sum(axis=2)), np.inf)
            more = np.full((count, nodes.shape[1]), np.inf)
            more[able] = far
            names = np.zeros(more.shape, dtype=int)
            names[able] = nodes
            away = np.concatenate((away, more), axis=1)
            held = np.concatenate((held, names), axis=1)
            done = np.concatenate((done, ~np.isfinite(more)), axis=1)
            best = np.argsort(away, axis=1, kind="stable")[:, :beam]
            away, held, done = (np.take_along_axis(x, best, axis=1) for x in (away, held, done))
        order = np.argsort(away, axis=1, kind="stable")[:, :beam]
        return np.take_along_axis(held, order, axis=1), np.take_along_axis(away, order, axis=1)

    def homes(self, vectors: np.ndarray) -> np.ndarray:
        """Per vector the lists that hold it, -1 where it is in fewer. A further centroid counts only if no nearer one
        already chosen is closer to it than the vector is."""
        found, away = self.walk(self.lifted(vectors), 2 * MOST_COPIES)
        chosen = np.full((len(vectors), MOST_COPIES), -1)
        chosen[:, 0] = found[:, 0]
        taken = np.ones(len(vectors), dtype=int)
        for j in range(1, found.shape[1]):
            near = (away[:, j] <= BOUNDARY * away[:, 0]) & (taken < MOST_COPIES)
            for i in range(MOST_COPIES):
                known = chosen[:, i] >= 0
                near &= ~known | (self.apart[chosen[:, i], found[:, j]] >= away[:, j])
            chosen[near, taken[near]] = found[near, j]
            taken += near
        return chosen

    def lists_of(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lists that queries search, as pairs of row and list."""
        found, away = self.walk(self.asking(vectors), self.beam)
        return np.nonzero(away <= self.ratio * away[:, :1] + 1e-12)[0], found[away <= self.ratio * away[:, :1] + 1e-12]

    def _try(self, sample: np.ndarray, k: int) -> None:
        """Choose the ratio of distances, and the width of walks, that reach most of the nearest vectors of the sample."""
        rows = np.arange(min(TRIAL_QUERIES, len(sample)))
        k = max(1, min(k, len(sample) - 1))
        nearest = np.zeros((len(rows), k), dtype=int)
        for i in rows:
            scores = sample @ sample[i]
            scores[i] = -np.inf
            nearest[i] = np.argpartition(-scores, k - 1)[:k]
        wanted, where = np.unique(nearest, return_inverse=True)
        homes = np.concatenate([self.homes(part) for part in np.array_split(sample[wanted], -(-len(wanted) // 1000))])
        away = _distances(self.asking(sample[rows]), self.centroids)
        own = homes[where.reshape(nearest.shape)]
        gap = np.where(own >= 0, away[rows[:, None, None], own], np.inf).min(axis=2)
        least = away.min(axis=1, keepdims=True)
        needed = np.sort((gap / np.maximum(least, 1e-300)).ravel())
        self.ratio = float(max(1.0, needed[int(np.ceil(AIM * len(needed))) - 1]))
        within = (away <= self.ratio * least).sum(axis=1)
        self.beam = int(min(len(self.centroids), max(2 * MOST_COPIES, within.max() * 5 // 4 + 1)))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_list()).astype(np.float64)


def _homes(index: Lists):
    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                rows, column = np.nonzero((homes := index.homes(_matrix(batch["vector"]))) >= 0)
                yield batch.iloc[rows].assign(list=homes[rows, column])

    return assign


def _searched(index: Lists):
    def choose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                rows, lists = index.lists_of(_matrix(batch["vector"]))
                own = np.split(lists.astype(np.int32), np.searchsorted(rows, np.arange(1, len(batch))))
                yield batch.assign(list=[int(x[0]) for x in own], lists=[np.sort(x) for x in own])

    return choose


def _block(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("entry", kind="stable")
    return pd.DataFrame({
        "list": [int(rows["list"].iloc[0])], "part": [int(rows["part"].iloc[0])],
        "entries": [rows["entry"].to_numpy(dtype=np.int64).tobytes()],
        "firsts": [rows["first"].to_numpy(dtype=np.int64).tobytes()], "vectors": [_matrix(rows["vector"]).tobytes()],
    })


def _asking_block(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("entry", kind="stable")
    lists = rows["lists"].to_list()
    places = np.concatenate([np.full(len(x), i, dtype=np.int32) for i, x in enumerate(lists)])
    return pd.DataFrame({
        "asker": [int(rows["asker"].iloc[0])], "entries": [rows["entry"].to_numpy(dtype=np.int64).tobytes()],
        "vectors": [_matrix(rows["vector"]).tobytes()], "places": [places.tobytes()],
        "wanted": [np.concatenate(lists).astype(np.int32).tobytes()], "lists": [np.unique(np.concatenate(lists))],
    })


class _Best:
    """The ``k`` best entries of each query of a block so far, ties to the smaller first id."""

    def __init__(self, row, k: int) -> None:
        self.k = k
        self.askers = np.frombuffer(row.entries, dtype=np.int64)
        self.queries = np.frombuffer(row.vectors).reshape(len(self.askers), -1)
        self.largest = np.abs(self.queries)
        places, wanted = (np.frombuffer(x, dtype=np.int32) for x in (row.places, row.wanted))
        order = np.argsort(wanted, kind="stable")
        names, starts = np.unique(wanted[order], return_index=True)
        self.of = dict(zip(names.tolist(), np.split(places[order], starts[1:]), strict=True))
        self.held = [(np.empty(0), np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64))] * len(self.askers)
        self.worst = np.full(len(self.askers), -np.inf)

    def meet(self, row) -> None:
        rows = self.of.get(row.list, np.empty(0, dtype=int))
        entries, firsts = (np.frombuffer(x, dtype=np.int64) for x in (row.entries, row.firsts))
        vectors = np.frombuffer(row.vectors).reshape(len(entries), -1)
        scores = self.queries[rows] @ vectors.T
        # The quick product is rounded in another way than the sums that count.
        slack = 1e-12 * (self.largest[rows] @ np.abs(vectors).max(axis=0))
        least = self.worst[rows]
        if len(entries) > self.k:
            least = np.maximum(least, np.partition(scores, -self.k, axis=1)[:, -self.k])
        able = scores >= (least - slack)[:, None]
        for i in np.nonzero(able.any(axis=1))[0]:
            place, found = rows[i], np.nonzero(able[i])[0]
            exact = (vectors[found] * self.queries[place]).sum(axis=1)
            score, entry, first = (np.concatenate(c) for c in zip(self.held[place], (exact, entries[found], firsts[found])))
            # An entry that stands in several lists has one score.
            _, only = np.unique(entry, return_index=True)
            best = only[np.lexsort((first[only], -score[only]))[: self.k]]
            self.held[place] = score[best], entry[best], first[best]
            if len(best) == self.k:
                self.worst[place] = score[best[-1]]

    def rows(self) -> pd.DataFrame:
        sizes = [len(h[0]) for h in self.held]
        score, entry, first = (np.concatenate(c) for c in zip(*self.held, strict=True))
        return pd.DataFrame({"asker": np.repeat(self.askers, sizes), "entry": entry, "first": first, "score": score})


def _compared(k: int):
    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows come sorted: a block of queries, then the blocks of lists of its run."""
        best = None
        for batch in batches:
            for row in batch.itertuples(index=False):
                if row.list < 0:
                    if best is not None:
                        yield best.rows()
                    best = _Best(row, k)
                else:
                    best.meet(row)
        if best is not None:
            yield best.rows()

    return compare


def _blocks(rows: DataFrame, block_rows: int) -> DataFrame:
    """Rows of a list in blocks of about ``block_rows``; a row per list (a bounded number) tells how many."""
    sizes = rows.groupBy("list").agg(F.ceil(F.count("*") / block_rows).cast("int").alias("parts"))
    dealt = rows.join(F.broadcast(sizes), "list").withColumn(
        "part", F.pmod(F.xxhash64("entry"), F.col("parts")).cast("int"))
    kinds = "list int, part int, entries binary, firsts binary, vectors binary"
    return dealt.select("list", "part", "entry", "first", "vector").groupBy("list", "part").applyInPandas(_block, kinds)


def _asking_blocks(rows: DataFrame, block_rows: int) -> DataFrame:
    """Queries in blocks of about ``block_rows``, with others of the same list or of lists near it.

    Lists are numbered along the cuts, so neighbours have near numbers; a row per list tells how many queries it has.
    """
    sizes = rows.groupBy("list").agg(F.count("*").alias("n"))
    before = Window.orderBy("list").rowsBetween(Window.unboundedPreceding, -1)
    placed = sizes.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    place = F.col("before") + F.col("n") * F.pmod(F.xxhash64("entry"), F.lit(1 << 20)) / (1 << 20)
    dealt = rows.join(F.broadcast(placed), "list").withColumn("asker", F.floor(place / block_rows))
    kinds = "asker bigint, entries binary, vectors binary, places binary, wanted binary, lists array<int>"
    return dealt.select("asker", "entry", "vector", "lists").groupBy("asker").applyInPandas(_asking_block, kinds)


def _whole(vectors: DataFrame, is_query: Column, id_col: str, vector_col: str) -> DataFrame:
    """Usable rows as ``id, vector, asks``, padded with zeros to one length."""
    vector = F.col(f"`{vector_col}`").cast("array<double>")
    usable = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), vector.alias("vector"),
                          F.coalesce(is_query, F.lit(False)).alias("asks"), usable.alias("usable"))
    return rows.filter("usable AND id IS NOT NULL").filter(F.exists("vector", lambda x: x != 0)).drop("usable")


def nearest(vectors: DataFrame, k: int, is_query: Column, id_col: str = "vec_id", vector_col: str = "vector",
            watch: Callable[[Lists], None] | None = None) -> DataFrame:
    """The ``k`` largest inner products found for each query among rows of other ids: ``query_id, rank, vec_id, score``.

    Scores are exact double-precision inner products; ties go to the smaller id, and a query with fewer than ``k`` other
    rows gets all that its lists hold. Vectors that are NULL, empty or all zero, or hold NULLs or non-finite components,
    and rows without an id, take no part. Shorter vectors count as padded with zeros. Rows of one id count as that many
    rows, and none is a result of a query of the same id; equal rows that ask are one query. Equal vectors share an
    entry of the index; of its ids the ``k + 1`` smallest are kept, as no query can get another one. An empty table, or
    one without queries, gives an empty result. The index is fitted on about ``SAMPLE_ROWS`` distinct vectors, the
    first by hash, or fewer if they are long; all vectors are in it. ``watch`` gets the fitted index.
    """
    spark = vectors.sparkSession
    kinds = "query_id bigint, rank int, vec_id bigint, score double"
    rows = _whole(vectors, is_query, id_col, vector_col)
    shape = rows.agg(F.max(F.size("vector")), F.max(F.array_max(F.transform("vector", F.abs)))).first()
    if shape[0] is None:
        return spark.createDataFrame([], kinds)
    dim, largest = shape
    padded = rows.withColumn("vector", F.concat("vector", F.array_repeat(F.lit(0.0), F.lit(dim) - F.size("vector"))))
    # Two hashes that begin differently: 128 bits stand for a vector.
    key = F.concat(*(F.lpad(F.hex(F.xxhash64(F.lit(seed), "vector")), 16, "0") for seed in (1, 2)))
    pairs = materialize(
        padded.withColumn("key", key).groupBy("key", "id").agg(
            F.count("*").alias("n"), F.bool_or("asks").alias("asks"), F.any_value("vector").alias("vector")), "vectors")
    queries = pairs.filter("asks").select(F.col("id").alias("query_id"), "key")
    place = F.row_number().over(Window.partitionBy("key").orderBy("id"))
    kept = pairs.withColumn("place", place).filter(F.col("place") <= k + 1)
    ids = F.array_sort(F.collect_list(F.struct("id", "n")))
    entries = materialize(
        kept.groupBy("key").agg(ids.alias("ids"), F.any_value("vector").alias("vector"))
        .withColumn("first", F.col("ids")[0]["id"]).withColumn("entry", F.monotonically_increasing_id()), "entries")

    scale = 1.0 / largest
    square = F.aggregate("vector", F.lit(0.0), lambda s, x: s + (x * scale) * (x * scale))
    count, norm = entries.agg(F.count("*"), F.sqrt(F.max(square))).first()
    most = max(1, min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * dim)))
    share = min(1.0, most / count)
    early = entries if share == 1.0 else entries.filter(F.col("key") < f"{int(share * 2**64):016X}")
    early = early if not early.isEmpty() else entries.orderBy("key").limit(1)
    drawn = early.select("key", "vector").toArrow().sort_by("key").column("vector").combine_chunks()
    sample = drawn.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
    lists = max(1, min(-(-count // LIST_ROWS), len(sample) // SAMPLED_PER_LIST))
    index = Lists.fit(sample, scale, norm, lists, k)
    if watch:
        watch(index)

    block_rows = max(1, BLOCK_BYTES // (8 * dim))
    asked = entries.join(queries.select("key").distinct(), "key", "left_semi")
    fields = "entry bigint, first bigint, vector array<double>, list int"
    with batches_of(spark, 1000):
        posted = materialize(entries.select("entry", "first", "vector").mapInPandas(_homes(index), fields), "postings")
        probes = materialize(asked.select("entry", "vector").mapInPandas(
            _searched(index), "entry bigint, vector array<double>, list int, lists array<int>"), "probes")
    with batches_of(spark, block_rows):
        posting_blocks = materialize(_blocks(posted, block_rows), "posting-blocks")
        askers = materialize(_asking_blocks(probes, block_rows), "asking-blocks")
    # Which blocks meet, by number; runs of them become tasks.
    wanted = askers.select("asker", F.explode("lists").alias("list")).join(posting_blocks.select("list", "part"), "list")
    place = F.row_number().over(Window.partitionBy("asker").orderBy("list", "part")) - 1
    pairs = wanted.select("asker", "list", "part", F.floor(place / RUN).cast("int").alias("run"))
    theirs = pairs.join(posting_blocks, ["list", "part"])
    mine = pairs.select("asker", "run").distinct().join(askers, "asker").withColumn("list", F.lit(-1))
    both = theirs.unionByName(mine.drop("lists"), allowMissingColumns=True).repartition("asker", "run")
    ordered = both.sortWithinPartitions("asker", "run", "list", "part")
    with batches_of(spark, 4):
        found = materialize(
            ordered.select("list", "entries", "firsts", "vectors", "places", "wanted")
            .mapInPandas(_compared(k + 1), "asker bigint, entry bigint, first bigint, score double"), "found")

    once = found.groupBy("asker", "entry", "first").agg(F.max("score").alias("score"))
    by_score = Window.partitionBy("asker").orderBy(F.desc("score"), "first")
    best = once.withColumn("place", F.row_number().over(by_score)).filter(F.col("place") <= k + 1)
    with_ids = best.join(entries.select("entry", "ids"), "entry").select("asker", "score", F.explode("ids").alias("i"))
    ordered = Window.partitionBy("asker").orderBy(F.desc("score"), "i.id")
    top = with_ids.withColumn("place", F.row_number().over(ordered)).filter(F.col("place") <= k + 1)
    results = F.array_sort(F.collect_list(F.struct("place", "i.id", "i.n", "score")))
    answers = top.groupBy("asker").agg(results.alias("results")).join(
        asked.select(F.col("entry").alias("asker"), "key"), "asker").select("key", "results")
    others = F.filter("results", lambda r: r["id"] != F.col("query_id"))
    copies = F.flatten(F.transform(others, lambda r: F.array_repeat(r, F.least(r["n"], F.lit(k)).cast("int"))))
    told = queries.join(answers, "key").select("query_id", F.posexplode(F.slice(copies, 1, k)).alias("at", "r"))
    return told.select("query_id", (F.col("at") + 1).alias("rank"), F.col("r.id").alias("vec_id"), "r.score")
