"""Near-duplicate documents: SuperMinHash signatures, banding, verification on full shingle sets, union-find.

SuperMinHash ranks the registers of a signature by one random permutation per shingle. A shingle offers its first
register a value in [0, 1), its second one a value in [1, 2), and so on; a register keeps the smallest. Once every
register of a document lies below a level, higher levels cannot change it and the work stops, mostly after a few.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import DataFrame

from ..operators.staging import materialize
from .common import TASK_DOCUMENTS, all_equal, few_files, packed, possibly_in, shingles, small_batches, text_hash, unpacked
from .components import components

# 45 bands of 6 registers miss a pair of similarity 0.8 with probability 1e-6 at most.
BANDS, ROWS = 45, 6
REGISTERS = BANDS * ROWS
# Of 270 registers, 216 agree on average at similarity 0.8; fewer than this many do with probability below 1e-9.
LEAST_AGREEING = 173
WIDTH, SIMILARITY = 5, 80
# Rounds in which each node's likeliest partner is verified before all pairs that are left.
BEST_ROUNDS = 2
# Shingles ranked at a time; bounds a task's memory to some 10 MB for permutations.
CHUNK = 20_000


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit hash of 64-bit numbers."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _offer(registers: np.ndarray, items: np.ndarray, owner: np.ndarray) -> None:
    """Let shingles (``owner``: row of ``registers``) offer their values."""
    m = registers.shape[1]
    flat = registers.reshape(-1)
    order = np.tile(np.arange(m, dtype=np.int16), (len(items), 1))
    at = np.arange(len(items))
    for level in range(m):
        wanting = (registers.max(axis=1) >= level)[owner]
        if not wanting.all():
            at, items, owner = at[wanting], items[wanting], owner[wanting]
        if not len(items):
            return
        drawn = mixed(items + np.uint64(level * 0x632BE59BD9B4E019 & 0xFFFFFFFFFFFFFFFF))
        value = (drawn >> np.uint64(32)).astype(np.float64) / 2.0**32 + level
        pick = level + ((drawn & np.uint64(0xFFFFFFFF)) * np.uint64(m - level) >> np.uint64(32)).astype(np.int64)
        chosen = order[at, pick]
        order[at, pick] = order[at, level]
        np.minimum.at(flat, owner * m + chosen, value)


def signatures(items: np.ndarray, ends: np.ndarray, m: int = REGISTERS) -> np.ndarray:
    """One row of ``m`` registers per set; set k holds ``items[ends[k]:ends[k + 1]]``."""
    sets = len(ends) - 1
    registers = np.full((sets, m), float(m))
    k = 0
    while k < sets:
        stop = max(k + 1, int(np.searchsorted(ends, ends[k] + CHUNK, "right")) - 1)
        for begin in range(int(ends[k]), int(ends[stop]), CHUNK):  # more than once for one very long set only
            end = min(begin + CHUNK, int(ends[stop]))
            owner = np.searchsorted(ends[k : stop + 1], np.arange(begin, end), "right") - 1
            _offer(registers[k:stop], mixed(items[begin:end]), owner)
        k = stop
    return registers


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("items")
        ends = lists.offsets.to_numpy().astype(np.int64)
        items = lists.values.to_numpy(zero_copy_only=False).view(np.uint64)[ends[0] : ends[-1]]
        ends = ends - ends[0]
        sizes = np.diff(ends)
        registers = signatures(items, ends)
        bits = mixed(registers.view(np.uint64))
        bands = np.zeros((len(sizes), BANDS), dtype=np.uint64)
        for j in range(ROWS):
            bands = mixed(bands ^ bits[:, j::ROWS])
        bands = mixed(bands + np.arange(BANDS, dtype=np.uint64)[None, :])
        sketch = (bits >> np.uint64(56)).astype(np.uint8)
        totals = [np.concatenate((np.zeros(1, np.uint64), np.cumsum(mixed(items ^ np.uint64(s))))) for s in (1, 2)]
        sums = [(t[ends[1:]] - t[ends[:-1]]).view(np.int64) for t in totals]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("id"), batch.column("hash"), pa.array(sizes), pa.array(sums[0]), pa.array(sums[1]),
                pa.ListArray.from_arrays(
                    pa.array(np.arange(len(sizes) + 1, dtype=np.int32) * BANDS), pa.array(bands.view(np.int64).ravel())
                ),
                pa.array([row.tobytes() for row in sketch], type=pa.binary()),
            ],
            names=["id", "hash", "n", "set_a", "set_b", "bands", "sketch"],
        )


def _agreeing(first: DataFrame) -> DataFrame:
    """Pairs with the number of registers that agree in their sketches, ``x`` and ``y``.

    The function is marked as nondeterministic, or Spark would copy it into filters on the number, each copy with a
    Python worker of its own for every task.
    """

    @F.pandas_udf("int")
    def agree(x, y):
        import pandas as pd

        if not len(x):
            return pd.Series([], dtype="int32")
        left = np.frombuffer(b"".join(x), dtype=np.uint8).reshape(len(x), -1)
        right = np.frombuffer(b"".join(y), dtype=np.uint8).reshape(len(y), -1)
        return pd.Series((left == right).sum(axis=1).astype(np.int32))

    return first.withColumn("agreeing", agree.asNondeterministic()("x", "y"))


def _close(a: str, b: str, similarity: int):
    """Sizes that allow the similarity."""
    return (F.col(a) * 100 >= F.col(b) * similarity) & (F.col(b) * 100 >= F.col(a) * similarity)


class _Search:
    """Steps of one search for links; each keeps what later steps read in the shared folder."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, width: int, similarity: int) -> None:
        if not 80 <= similarity <= 100:
            raise ValueError("similarity must be between 80 and 100 percent")
        self.width, self.similarity = width, similarity
        small_batches(docs.sparkSession)
        self.texts = docs.select(
            F.col(id_col).cast("bigint").alias("id"), text_hash(F.col(text_col)).alias("hash"),
            F.col(text_col).alias("text"),
        )
        sets = self.texts.select("id", "hash", shingles(F.col("text"), width).alias("items"))
        signed = sets.mapInArrow(
            _signed,
            "id long, hash long, n long, set_a long, set_b long, bands array<long>, sketch binary",
        )
        self.signed = materialize(signed.withColumn("row", F.monotonically_increasing_id()), "signatures")
        self.documents = self.signed.count()
        # One node per set of shingles: the number of one of its rows.
        self.classes = self._kept(
            self.signed.filter("n > 0").groupBy("set_a", "set_b", "n")
            .agg(F.min("row").alias("node"), F.min("id").alias("least_id")), "classes",
        )
        nodes = self.classes.select("node")
        self.nodes = self._kept(
            self.signed.join(nodes, F.col("row") == F.col("node"))
            .select("node", "id", "hash", "n", "bands", "sketch"), "nodes",
        )

    def _kept(self, df: DataFrame, label: str) -> DataFrame:
        """Stored rows, in files of which there are no more than the number of documents asks for."""
        return materialize(few_files(df, self.documents, TASK_DOCUMENTS), label)

    def labels(self) -> DataFrame:
        """Components of all links between nodes: ``node, label``, without the nodes that are alone."""
        self.buckets = self.nodes.select("node", F.explode("bands").alias("band"))
        # Every bucket has a leader of its own, the smallest number after mixing with the band's hash: a node of a
        # large group then meets many leaders, and is alone only if it is far from all of them.
        mixed_least = F.min(F.col("node").bitwiseXOR(F.col("band")))
        shared = self._kept(
            self.buckets.groupBy("band").agg(mixed_least.alias("least"), F.count("*").alias("size"))
            .filter("size > 1")
            .select(F.col("band").alias("in_band"), F.col("least").bitwiseXOR(F.col("band")).alias("leader")), "buckets",
        )
        self.members = self._kept(
            self.buckets.join(shared, F.col("band") == F.col("in_band")).select("node", "band", "leader"), "members"
        )
        stars = self.members.filter("node <> leader").select(
            F.least("leader", "node").alias("a"), F.greatest("leader", "node").alias("b"), "node"
        )
        # ``node`` is the one of the two that asks; a pair that both ask for is kept once.
        stars = stars.groupBy("a", "b").agg(F.max("node").alias("node"))
        left = self._kept(self._likely(stars), "star-pairs")
        self.edges, labels = None, None
        # First the likeliest partner of each node, then the next one, then whatever could still connect components.
        for _ in range(BEST_ROUNDS):
            best = left.groupBy("node").agg(F.max(F.struct("agreeing", "a", "b")).alias("best")).select("best.a", "best.b")
            tried = self._kept(best.distinct(), "tried")
            labels = self._joined(self._verified(tried), labels)
            rest = left.join(tried.toDF("x", "y"), (F.col("a") == F.col("x")) & (F.col("b") == F.col("y")), "left_anti")
            left = self._kept(self._between(rest, labels), "left-pairs")
        labels = self._joined(self._verified(left.select("a", "b")), labels)
        return self._joined(self._open_links(labels), labels)

    def _joined(self, links: DataFrame, labels: DataFrame | None) -> DataFrame:
        """Components after the links have become edges."""
        if labels is not None and links.isEmpty():
            return labels
        self.edges = links if self.edges is None else self.edges.unionByName(links)
        return self._labels(self.edges)

    def _labels(self, edges: DataFrame) -> DataFrame:
        return self._kept(components(edges), "labels")

    def _between(self, pairs: DataFrame, labels: DataFrame) -> DataFrame:
        """Pairs of different components. ``labels`` lacks the nodes that are alone."""
        one, two = labels.toDF("na", "la"), labels.toDF("nb", "lb")
        known = pairs.join(one, F.col("a") == F.col("na"), "left").join(two, F.col("b") == F.col("nb"), "left")
        return known.filter(F.coalesce("la", "a") != F.coalesce("lb", "b")).select(*pairs.columns)

    def _likely(self, pairs: DataFrame) -> DataFrame:
        """Pairs whose sizes and sketches allow a link."""
        one = self.nodes.select(F.col("node").alias("na"), F.col("n").alias("n_a"), F.col("sketch").alias("x"))
        two = self.nodes.select(F.col("node").alias("nb"), F.col("n").alias("n_b"), F.col("sketch").alias("y"))
        sized = pairs.join(one, F.col("a") == F.col("na")).join(two, F.col("b") == F.col("nb"))
        near = _agreeing(sized.filter(_close("n_a", "n_b", self.similarity)))
        return near.filter(F.col("agreeing") >= LEAST_AGREEING).select("a", "b", "node", "agreeing")

    def _sets(self, needed: DataFrame) -> DataFrame:
        """Full shingle sets of the nodes in column ``need``: ``node, items``."""
        wanted = self._kept(
            self.nodes.join(needed.distinct(), F.col("node") == F.col("need"))
            .select("node", F.col("id").alias("own_id"), F.col("hash").alias("own_hash")), "needed",
        )
        same = all_equal([F.col("id"), F.col("hash")], [F.col("own_id"), F.col("own_hash")])
        texts = possibly_in(self.texts, ["id", "hash"], wanted, ["own_id", "own_hash"])
        one_each = texts.join(wanted, same).dropDuplicates(["node"])
        return self._kept(one_each.select("node", shingles(F.col("text"), self.width).alias("items")), "sets")

    def _linked(self, x: str, y: str):
        """Whether two full sets are similar enough."""
        common = F.size(F.array_intersect(x, y)).cast("bigint")
        return common * 100 >= (F.size(x) + F.size(y) - common) * self.similarity

    def _verified(self, pairs: DataFrame) -> DataFrame:
        """The pairs whose full sets are similar enough."""
        pairs = self._kept(pairs, "pairs")
        if pairs.isEmpty():
            return pairs.select("a", "b")
        sets = self._sets(pairs.select(F.explode(F.array("a", "b")).alias("need")))
        one, two = sets.toDF("na", "x"), sets.toDF("nb", "y")
        both = pairs.join(one, F.col("a") == F.col("na")).join(two, F.col("b") == F.col("nb"))
        return self._kept(both.filter(self._linked("x", "y")).select("a", "b"), "links")

    def _open_links(self, labels: DataFrame) -> DataFrame:
        """Links in buckets that hold more than one component.

        Of two nodes of different components one at least is outside the bucket's commonest component, so only such
        nodes are compared, with the nodes of other components; a pair counts in its first common band. Pairs with the
        leader are settled. The sets are compared within the join, which gives links only.
        """
        member = self.members.join(labels, self.members["node"] == labels["node"], "left").select(
            self.members["node"], "band", "leader", F.coalesce("label", self.members["node"]).alias("label")
        )
        sizes = member.groupBy("band", "label").agg(F.count("*").alias("size"))
        most = (
            sizes.groupBy("band").agg(
                F.max(F.struct("size", "label")).alias("most"), F.count("*").alias("kinds"), F.sum("size").alias("all")
            )
            .filter("kinds > 1 and all > 2")
            .select(F.col("band").alias("open_band"), F.col("most.label").alias("main"))
        )
        there = self._kept(
            member.join(self._kept(most, "open-buckets"), F.col("band") == F.col("open_band"))
            .filter("node <> leader").select("node", "band", "label", "main"), "open-members",
        )
        if there.isEmpty():
            return there.select(F.col("node").alias("a"), F.col("node").alias("b"))
        sets = self._sets(there.select(F.col("node").alias("need"))).withColumnRenamed("node", "own")
        known = self.nodes.select(F.col("node").alias("same"), "n", "bands")
        full = there.join(known, F.col("node") == F.col("same")).join(sets, F.col("node") == F.col("own"))
        full = self._kept(full.select("node", "band", "label", "main", "n", "bands", "items"), "open-sets")
        left = full.filter("label <> main").select(*(F.col(c).alias(f"{c}_a") for c in full.columns))
        right = full.select(*(F.col(c).alias(f"{c}_b") for c in full.columns))
        once = (F.col("label_b") == F.col("main_b")) | (F.col("node_a") < F.col("node_b"))
        first = F.get(F.array_intersect("bands_a", "bands_b"), F.lit(0))
        links = left.join(
            right,
            (F.col("band_a") == F.col("band_b")) & (F.col("label_a") != F.col("label_b")) & once
            & _close("n_a", "n_b", self.similarity) & (first == F.col("band_a")) & self._linked("items_a", "items_b"),
        )
        return self._kept(links.select(F.col("node_a").alias("a"), F.col("node_b").alias("b")), "open-links")


def _same_set():
    return (F.col("set_a") == F.col("a")) & (F.col("set_b") == F.col("b")) & (F.col("n") == F.col("size"))


def _settled(search: _Search, *more: str) -> DataFrame:
    """Every set of shingles with the smallest id of its component: ``a, b, size, component``, and ``label`` if asked."""
    labels = search.labels().toDF("own", "label")
    labelled = search._kept(
        search.classes.join(labels, F.col("node") == F.col("own"), "left")
        .withColumn("label", F.coalesce("label", "node")).select("set_a", "set_b", "n", "label", "least_id"),
        "labelled-classes",
    )
    least = search._kept(
        labelled.groupBy(F.col("label").alias("of")).agg(F.min("least_id").alias("component")), "least-ids"
    )
    return search._kept(
        labelled.join(least, F.col("label") == F.col("of")).select(
            F.col("set_a").alias("a"), F.col("set_b").alias("b"), F.col("n").alias("size"), "component", *more
        ), "components",
    )


def near_duplicates(
    docs: DataFrame, width: int = WIDTH, similarity: int = SIMILARITY, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """All rows with ``n_shingles``, ``component_id`` (the smallest id linked with the row's, directly or through
    others) and ``kept`` (whether the two ids are equal).

    Words are runs of anything but white space, A-Z lower-cased. Two documents are linked if the sets of their distinct
    ``width``-word shingles share at least ``similarity`` percent of their union; shorter texts make one shingle. Equal
    sets are one node; a link between other nodes is missed with probability 1e-6 at most, and every link used is
    confirmed on the full sets. ``similarity`` below 80 is refused, as the bands are made for 80 and above. Texts that
    are NULL or have no words are linked with nothing. Rows equal in id and text get the same result; a NULL id counts
    as larger than any other. Columns with the names of results are replaced; an empty table gives an empty result.
    """
    search = _Search(docs, id_col, text_col, width, similarity)
    settled = _settled(search)
    found = search._kept(
        search.signed.select("id", "hash", "n", "set_a", "set_b").join(settled, _same_set(), "left")
        .select(F.col("id").alias("own_id"), F.col("hash").alias("own_hash"), "n", "component")
        .dropDuplicates(["own_id", "own_hash"]), "found",
    )
    rows = docs.select(packed(docs), F.col(id_col).cast("bigint").alias("id"), text_hash(F.col(text_col)).alias("hash"))
    told = rows.join(found, all_equal([F.col("id"), F.col("hash")], [F.col("own_id"), F.col("own_hash")]), "left")
    component = F.coalesce(F.when(F.col("n") > 0, F.col("component")), F.col("id"))
    return unpacked(
        told, docs.columns,
        replaced={"n_shingles": F.col("n"), "component_id": component, "kept": F.col("id").eqNullSafe(component)},
    )


def without_near_duplicates(
    docs: DataFrame, width: int = WIDTH, similarity: int = SIMILARITY, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of which one stays per component of ``near_duplicates``, with the columns of ``docs``.

    It is the row with the smallest id (NULL last), then the smallest hash of its text; of rows equal in both, one
    stays. Rows without words are linked with nothing and all stay.
    """
    search = _Search(docs, id_col, text_col, width, similarity)
    found = search._kept(
        search.signed.select("id", "hash", "n", "set_a", "set_b").join(_settled(search, "label"), _same_set(), "left")
        .groupBy(F.col("id").alias("own_id"), F.col("hash").alias("own_hash"))
        .agg(F.max("n").alias("n"), F.max("component").alias("component"), F.max("label").alias("label"),
             F.count("*").alias("copies")), "found",
    )
    first = found.filter(F.col("n") > 0).filter(F.col("own_id").eqNullSafe(F.col("component"))).groupBy("label").agg(
        F.max("component").alias("own_id"), F.min("own_hash").alias("least_hash"),
        F.min_by("copies", "own_hash").alias("copies"),
    )
    alone = found.filter("n = 0").select("own_id", "own_hash", F.lit(1).cast("bigint").alias("copies"))
    stays = search._kept(
        first.select("own_id", F.col("least_hash").alias("own_hash"), "copies").unionByName(alone), "stays"
    )
    rows = docs.select(packed(docs), F.col(id_col).cast("bigint").alias("id"), text_hash(F.col(text_col)).alias("hash"))
    told = rows.join(stays, all_equal([F.col("id"), F.col("hash")], [F.col("own_id"), F.col("own_hash")]))
    if not stays.filter("copies > 1").isEmpty():
        # The number that tells equal rows apart is stored, so that it is the same wherever it is read.
        told = materialize(
            told.select("row", "id", "hash", "copies", F.monotonically_increasing_id().alias("number")), "first-rows"
        )
        repeated = told.filter("copies > 1")
        least = repeated.groupBy("id", "hash").agg(F.min("number").alias("least")).select("least")
        told = told.filter("copies = 1").unionByName(
            repeated.join(least, F.col("number") == F.col("least"), "left_semi")
        )
    return unpacked(told, docs.columns, replaced={})
