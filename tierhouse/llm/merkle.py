"""Merkle manifest of a dataset: a digest per row, a tree per group, a tree over the groups, and a proof per row.

The rank of a row within its group is written in digits of base ``FANOUT``. Blocks of ``FANOUT ** DIGITS`` consecutive
rows are rolled up on their own: the digit columns are grouped away one after the other, and each grouping nests the
structs of the children in the struct of their parent. The blocks' digests are the rows of the next round, until each
group is one block. On the way back a block meets the path above it in one grouping, and transforms and explodes take
it apart again into rows with their proofs.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame

from ..operators.staging import materialize
from .ranking import ranked

# Fixed value of the tree: children of a node.
FANOUT_BITS = 4
# Digits that a block has: it holds 256 nodes at most.
DIGITS = 2
_HEX = 64  # characters of a digest
PROOF = "array<struct<left:string,right:string>>"


def digest_of(values: Sequence[Column]) -> Column:
    """Lowercase hex SHA-256 of the values one after the other: ``-`` if NULL, else byte count, ``:`` and value."""
    def part(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*map(part, values)), 256)


def siblings(proof: Column) -> Column:
    """All sibling digests of a proof as one text, level by level from the leaf, left to right."""
    return F.array_join(F.transform(proof, lambda level: F.concat(level["left"], level["right"])), "")


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and the siblings of its proof lead to."""
    def up(node: Column, level: Column) -> Column:
        return F.sha2(F.concat(level["left"], node, level["right"]), 256)

    return F.aggregate(proof, leaf, up)


def _rolled_up(nodes: DataFrame) -> DataFrame:
    """Blocks of nodes ``g, rank, digest, item``: ``g, block, digest`` and the nested children as ``item``.

    Ranks have no gaps, so a lone child whose digits above are all 0 is all that its group has; it gets no parent.
    """
    digits = [f"digit{i}" for i in range(DIGITS)]
    low = [F.shiftright("rank", FANOUT_BITS * i).bitwiseAND(F.lit((1 << FANOUT_BITS) - 1)).alias(d)
           for i, d in enumerate(digits)]
    # One shuffle: all groupings below are within a block.
    level = nodes.select("g", F.shiftright("rank", FANOUT_BITS * DIGITS).alias("block"), *low, "digest", "item")
    level = level.repartition("g", "block")
    for i, digit in enumerate(digits):
        above = ["block", *digits[i + 1 :]]
        children = F.array_sort(F.collect_list(F.struct(digit, "digest", "item"))).alias("children")
        grouped = level.groupBy("g", *above).agg(children).withColumn(
            "joined", F.array_join(F.col("children.digest"), "")
        )
        alone = (F.size("children") == 1) & (sum((F.col(c) for c in above), F.lit(0)) == 0)
        level = grouped.select(
            "g", *above, F.when(alone, F.col("joined")).otherwise(F.sha2("joined", 256)).alias("digest"),
            F.struct((~alone).alias("hashed"), "joined", F.col("children.item").alias("children")).alias("item"),
        )
    return level


def _taken_apart(blocks: DataFrame) -> DataFrame:
    """Nodes ``g, item, digest, path, ends`` of blocks ``g, item, path, ends``."""
    joined = F.col("item.joined")

    def child(item: Column, i: Column) -> Column:
        return F.struct(
            item.alias("item"), joined.substr(i * _HEX + 1, F.lit(_HEX)).alias("digest"),
            joined.substr(F.lit(1), i * _HEX).alias("left"),
            joined.substr((i + 1) * _HEX + 1, F.length(joined)).alias("right"),
        )

    rows = blocks
    for _ in range(DIGITS):
        rows = rows.select("g", "path", "ends", F.col("item.hashed").alias("hashed"),
                           F.explode(F.transform("item.children", child)).alias("c"))
        level = F.array(F.struct("c.left", "c.right"))
        rows = rows.select("g", "c.item", "c.digest", "ends",
                           F.when(F.col("hashed"), F.concat(level, "path")).otherwise(F.col("path")).alias("path"))
    return rows


def _with_paths(nodes: DataFrame, above: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Nodes ``g, rank, digest, item`` with the ``path`` to the top and its ``ends``: ``g, item, digest, path, ends``.

    ``above`` gives ``g, path, ends`` for the digests ``g, digest`` of whole groups.
    """
    blocks = materialize(_rolled_up(nodes), "blocks")
    if blocks.filter("block > 0").isEmpty():
        tops = above(blocks.select("g", "digest")).select("g", F.lit(0).cast("bigint").alias("block"), "path", "ends")
    else:
        numbered = blocks.select("g", F.col("block").alias("rank"), "digest", F.struct("block").alias("item"))
        tops = _with_paths(numbered, above).select("g", "item.block", "path", "ends")
    # A block and the path above it are the two rows of their group.
    both = blocks.select("g", "block", "item").unionByName(tops, allowMissingColumns=True)
    whole = both.groupBy("g", "block").agg(*(F.any_value(c, ignoreNulls=True).alias(c) for c in ("item", "path", "ends")))
    return _taken_apart(whole)


def manifest(rows: DataFrame, columns: Sequence[str], group: str = "source", order: str = "doc_id",
             carried: Mapping[str, Column] | None = None) -> DataFrame:
    """One row per row: ``order`` and ``group`` column, ``leaf``, ``subroot``, ``root``, ``proof`` and the ``carried``.

    A leaf is the digest of ``columns`` (``digest_of``). Within a group leaves ascend by ``order``; groups ascend, too;
    16 consecutive nodes, the last run maybe fewer, make one above them, until one is left. The proof lists the siblings
    level by level: those to the left and those to the right of the path, each as one text of 64 characters a digest. A
    level at which the node is alone in its run is listed with two empty texts. ``carried`` names further values that
    come along (computed from ``rows``; they must be sortable).

    NULL is a group of its own and comes first, as does a NULL in ``order``; rows that tie ascend by their leaf, and
    copies are leaves of their own. Columns outside ``columns`` are not read. An empty table gives no rows.
    """
    carried = dict(carried or {})
    leaf = digest_of([F.col(f"`{c}`") for c in columns])
    kept = F.struct(F.col(f"`{order}`").alias("order"), *(v.alias(f"c{i}") for i, v in enumerate(carried.values())))
    leaves = materialize(rows.select(F.col(f"`{group}`").alias("g"), leaf.alias("digest"), kept.alias("item")), "leaves")
    by_order = leaves.withColumn("o", F.col("item.order"))
    numbered = ranked(by_order, "g", ["o", "digest"])

    def over_groups(tops: DataFrame) -> DataFrame:
        """The tree over the groups: its nodes are their digests."""
        known = materialize(tops.select(F.lit(0).alias("g"), F.col("g").alias("group"), "digest",
                                        F.struct(F.col("g").alias("group"), F.col("digest").alias("subroot")).alias("item")),
                            "groups")
        placed = ranked(known, "g", ["group"])

        def end(root: DataFrame) -> DataFrame:
            return root.select("g", F.array().cast(PROOF).alias("path"), F.struct(F.col("digest").alias("root")).alias("ends"))

        found = _with_paths(placed.select("g", "rank", "digest", "item"), end)
        return found.select(F.col("item.group").alias("g"), "path",
                            F.struct(F.col("item.subroot"), F.col("ends.root")).alias("ends"))

    found = _with_paths(numbered.select("g", "rank", "digest", "item"), over_groups)
    return found.select(
        F.col("item.order").alias(order), F.col("g").alias(group), F.col("digest").alias("leaf"), "ends.subroot",
        "ends.root", F.col("path").alias("proof"), *(F.col(f"item.c{i}").alias(name) for i, name in enumerate(carried)),
    )
