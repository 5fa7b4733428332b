"""Benchmark items inside documents: size-partitioned MinHash search, verified by exact shingle containment.

Documents are partitioned by the power of two above their number of shingles, and a partition's signatures have eight
bins per shingle of its largest document; a bin keeps the shingle with the smallest hash. A short item therefore
leaves as many traces in the signature of a long document as in that of a short one. An item is searched by its
rarest shingles: as many as a document that contains it may lack, and ``SPARE`` more.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import DataFrame, Window

from ..operators.staging import materialize
from .common import TASK_DOCUMENTS, all_equal, few_files, packed, possibly_in, shingles, small_batches, text_hash
from .near_dedup import mixed

WIDTH, CONTAINMENT = 5, 80
# A bin loses a shingle to another one with probability 0.06, all spare ones of an item with probability 1e-9.
BINS, SPARE = 8, 8
# Items with fewer shingles are searched in all shingles of a document.
SMALL = 10
# Bits of the filter of search shingles that every task gets (8 MB, whatever their number), and bits of one of its pages.
FILTER_BITS, _PAGE = 1 << 26, 32_768


def in_signature(items: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Which of the ``chosen`` places of a document's shingles are kept by the document's bins."""
    bins = np.uint64(BINS << max(len(items) - 1, 0).bit_length()) - np.uint64(1)
    drawn = mixed(items)
    order = np.lexsort((items, drawn >> np.uint64(20), drawn & bins))
    slots = (drawn & bins)[order]
    first = np.concatenate(([True], slots[1:] != slots[:-1]))
    kept = np.zeros(len(items), dtype=bool)
    kept[order[first]] = True
    return kept[chosen]


def _filter_of(keys: DataFrame) -> np.ndarray:
    """Bits at the lowest places of hashed shingles; the executors make pages of it."""
    place = F.col("key").bitwiseAND(F.lit(FILTER_BITS - 1))
    pages = keys.select(place.alias("place")).groupBy(F.floor(F.col("place") / _PAGE).alias("page")).agg(
        F.bitmap_construct_agg(F.pmod("place", F.lit(_PAGE))).alias("bits"))
    held = np.zeros(FILTER_BITS // 8, dtype=np.uint8)
    for row in pages.collect():
        held[row["page"] * _PAGE // 8 : (row["page"] + 1) * _PAGE // 8] = np.frombuffer(row["bits"], dtype=np.uint8)
    return held


def _traces(wanted: np.ndarray, small: np.ndarray):
    """Rows of document and shingle that may be a search shingle, of its signature or of a small item."""

    def likely(held: np.ndarray, items: np.ndarray) -> np.ndarray:
        place = items & np.uint64(FILTER_BITS - 1)
        return (held[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("items")
            ends = lists.offsets.to_numpy()
            items = lists.values.to_numpy(zero_copy_only=False).view(np.uint64)
            at = ends[0] + np.nonzero(likely(wanted, items[ends[0] : ends[-1]]))[0]
            doc = np.searchsorted(ends, at, "right") - 1
            keep = likely(small, items[at])
            for k in np.unique(doc):
                here = doc == k
                keep[here] |= in_signature(items[ends[k] : ends[k + 1]], at[here] - ends[k])
            docs = pa.array(doc[keep])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(docs), batch.column("hash").take(docs),
                 pa.array(items[at[keep]].view(np.int64))], names=["id", "hash", "key"],
            )

    return find


def _search_keys(sets: DataFrame, containment: int) -> DataFrame:
    """``item, key, small``: the rarest shingles of each item."""
    each = sets.select("item", "n", F.explode("items").alias("key"))
    common = each.groupBy(F.col("key").alias("of")).agg(F.count("*").alias("held"))
    rank = F.row_number().over(Window.partitionBy("item").orderBy("held", "key"))
    needed = F.floor(F.col("n") * (100 - containment) / 100) + SPARE
    return (
        each.join(common, F.col("key") == F.col("of")).withColumn("rank", rank).filter(F.col("rank") <= needed)
        .select("item", "key", (F.col("n") < SMALL).alias("small"))
    )


def contained_items(
    docs: DataFrame, items: DataFrame, width: int = WIDTH, containment: int = CONTAINMENT, id_col: str = "doc_id",
    text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """Pairs of document and item where the document holds ``containment`` percent of the item's distinct shingles.

    Returns all columns of the document but the text, then ``item_id``, ``n_item`` (shingles of the item) and
    ``n_common`` (how many of them the document holds), which replace columns of these names. Words are runs of
    anything but white space, A-Z lower-cased; a text with fewer than ``width`` words makes one shingle, one that is
    NULL or has no words none and is in no pair. Repeated rows of either table give repeated pairs. Every pair is
    verified on full sets; one is missed with probability 1e-9 at most. Without items or documents there are no pairs.
    """
    spark = docs.sparkSession
    small_batches(spark)
    sets = materialize(
        items.select(F.col(item_col).alias("item_id"), shingles(F.col(item_text_col), width).alias("items"))
        .filter(F.size("items") > 0)
        .select("item_id", F.size("items").alias("n"), "items", F.monotonically_increasing_id().alias("item")),
        "items",
    )
    documents, listed = docs.count(), sets.count()
    keys = materialize(few_files(_search_keys(sets, containment), listed, TASK_DOCUMENTS), "item-keys")
    texts = docs.select(F.col(id_col).alias("id"), text_hash(F.col(text_col)).alias("hash"), F.col(text_col).alias("text"))
    found = texts.select("id", "hash", shingles(F.col("text"), width).alias("items"))
    find = _traces(_filter_of(keys), _filter_of(keys.filter("small")))
    id_type = texts.schema["id"].dataType.simpleString()
    # What passes the filter by chance is left out by the join with the search shingles.
    traces = found.mapInArrow(find, f"id {id_type}, hash long, key long")
    met = traces.join(keys.select(F.col("key").alias("of"), "item"), F.col("key") == F.col("of"))
    pairs = met.select(
        F.col("id").alias("own_id"), F.col("hash").alias("own_hash"), F.col("item").alias("own_item")
    ).distinct()
    pairs = materialize(few_files(pairs, documents, TASK_DOCUMENTS), "item-candidates")
    rows = docs.select(packed(docs), F.col(id_col).alias("id"), text_hash(F.col(text_col)).alias("hash"))
    met_docs = pairs.select("own_id", "own_hash").distinct()
    met_docs = materialize(few_files(met_docs, documents, TASK_DOCUMENTS), "met-documents")
    full = materialize(
        possibly_in(rows, ["id", "hash"], met_docs, ["own_id", "own_hash"]).join(met_docs, all_equal([F.col("id"), F.col("hash")], [F.col("own_id"), F.col("own_hash")]))
        .select("row", "id", "hash", shingles(F.col("row").getField(text_col), width).alias("found")), "met-sets",
    )
    both = full.join(pairs, all_equal([F.col("id"), F.col("hash")], [F.col("own_id"), F.col("own_hash")])).join(
        sets, F.col("own_item") == F.col("item")
    )
    common = F.size(F.array_intersect("found", "items"))
    counted = both.select("row", "item_id", F.col("n").alias("n_item"), common.alias("n_common"))
    names = [c for c in docs.columns if c not in (text_col, "item_id", "n_item", "n_common")]
    return counted.filter(F.col("n_common") * 100 >= F.col("n_item") * containment).select(
        *(F.col("row").getField(c).alias(c) for c in names), "item_id", "n_item", "n_common"
    )


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **search) -> DataFrame:
    """The documents that hold no item; ``search`` as for ``contained_items``."""
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), text_hash(F.col(text_col)).alias("hash"))
    pairs = contained_items(own, items, id_col="id", **search)
    hit = pairs.select(F.col("id").alias("own_id"), F.col("hash").alias("own_hash")).distinct()
    documents = docs.count()
    hit = materialize(few_files(hit, documents, TASK_DOCUMENTS), "hit")
    rows = docs.select(packed(docs), F.col(id_col).alias("id"), text_hash(F.col(text_col)).alias("hash"))
    same = all_equal([F.col("id"), F.col("hash")], [F.col("own_id"), F.col("own_hash")])
    return rows.join(hit, same, "left_anti").select("row.*")
