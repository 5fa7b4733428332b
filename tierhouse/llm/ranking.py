"""Gapless ranks within groups of any size."""

from __future__ import annotations

import pyspark.sql.functions as F
from pyspark.sql import DataFrame, Window

from ..operators.staging import materialize

# Rows that one task sorts.
TASK_ROWS = 100_000
# monotonically_increasing_id() keeps the row position in its low 33 bits.
_POSITION = (1 << 33) - 1


def ranked(rows: DataFrame, group: str, order: list[str], name: str = "rank", task_rows: int = TASK_ROWS) -> DataFrame:
    """Add ``name``: 0, 1, ... within each ``group`` in ascending ``order`` (NULLs first; NULL is a group, too).

    All rows are sorted once over ranges of group and order, so a group with most of the rows is spread like the others.
    Each range is written with the positions of its rows; the counts per range and group, a small table, give the rest.
    Rows that tie are told apart by their input partition only, so give an order that leaves none but copies.
    ``rows`` should be a stored table, as it is counted and sampled.
    """
    parts = max(1, -(-rows.count() // task_rows))
    sorted_rows = (
        rows.withColumn("__from", F.spark_partition_id())
        .repartitionByRange(parts, group, *order, "__from")
        .sortWithinPartitions(group, *order)
        .select(*rows.columns, F.spark_partition_id().alias("__part"),
                F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION)).alias("__place"))
    )
    staged = materialize(sorted_rows, "ranked")
    before = Window.partitionBy(group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = staged.groupBy("__part", group).agg(F.min("__place").alias("low"), F.count("*").alias("n"))
    shifts = ranges.select(F.col("__part").alias("__p"), F.col(group).alias("__g"),
                           (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("low")).alias("__shift"))
    met = (F.col("__part") == F.col("__p")) & F.col(group).eqNullSafe(F.col("__g"))
    rank = (F.col("__place") + F.col("__shift")).cast("bigint")
    return staged.join(shifts, met).select(*rows.columns, rank.alias(name))
