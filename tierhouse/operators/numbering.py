"""Dense numbering and next-row access without putting all rows, or one key, into one task."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .lookups import HOT_ROWS, hot_keys, key_hash
from .staging import materialize, row_hash

# Rows that one task sorts and writes, unless that made more tasks than this.
TASK_ROWS, MOST_TASKS = 500_000, 20_000
# monotonically_increasing_id() keeps the row position in its low 33 bits.
_POSITION = (1 << 33) - 1


def surrogate_key(
    df: DataFrame,
    order: Sequence[str | Column],
    name: str = "surrogate_key",
    start: int = 1,
    rows: int | None = None,
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """Add ``name``: ``start``, ``start + 1``, ... over the global ``order``.

    Same numbers as ``row_number()`` over an unpartitioned window. The rows are range-partitioned
    and sorted once, written with their position in the partition, and shifted by the row counts of
    the partitions before. Rows that tie are ordered by a hash of the whole row; exact copies are
    told apart by their input partition, so that even those spread over many partitions.

    ``rows`` is the approximate row count where it is known; otherwise the rows are counted, which
    for a table reads file footers only. The count and the sampling for the sort read the input
    again, so write an expensive one first (``materialize``).
    """
    if name in df.columns:
        raise ValueError(f"column {name} is already present")
    # A fixed number of partitions: merging them by size would put well-compressed copies together.
    parts = min(MOST_TASKS, max(1, math.ceil((df.count() if rows is None else rows) / task_rows)))
    tagged = df.withColumns({"__tie": row_hash(df), "__source": F.spark_partition_id()})
    placed = (
        tagged.repartitionByRange(parts, *order, "__tie", "__source")
        .sortWithinPartitions(*order, "__tie")
        .select(
            *[F.col(f"`{c}`") for c in df.columns],
            F.spark_partition_id().alias("__part"),
            F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION)).alias("__position"),
        )
    )
    staged = materialize(placed, "numbered")
    # One row per partition of the sort.
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        staged.groupBy("__part")
        .agg((F.max("__position") + 1).alias("__rows"))
        .select("__part", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__shift"))
    )
    number = (F.col("__shift") + F.col("__position") + F.lit(start)).cast("bigint")
    return staged.join(shifts, "__part").select(
        number.alias(name), *[F.col(f"`{c}`") for c in df.columns]
    )


def neighbours(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    values: Mapping[str, tuple[str, int]],
    min_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add columns of other rows with the same ``keys``: name to (column, steps ahead in ascending ``order``).

    Ordinary keys use a window per key. Keys with very many rows are numbered across partitions
    and each row is joined to the ones with the wanted numbers.
    """
    keys, order = list(keys), list(order)
    window = Window.partitionBy(*keys).orderBy(*order)

    def in_window(rows: DataFrame) -> DataFrame:
        return rows.withColumns({n: F.lead(c, s).over(window) for n, (c, s) in values.items()})

    hot = hot_keys(df, keys, min_rows)
    if not hot:
        return in_window(df)

    is_hot = key_hash(keys).isin(list(hot))
    numbered = surrogate_key(df.where(is_hot), [*keys, *order], "__n", rows=sum(hot.values()))
    chained = numbered
    for step in sorted({s for _, s in values.values()}):
        taken = {n: c for n, (c, s) in values.items() if s == step}
        other = numbered.select(
            (F.col("__n") - step).alias("__m"), *[F.col(k).alias(f"__near{i}") for i, k in enumerate(keys)],
            *[F.col(c).alias(n) for n, c in taken.items()],
        )
        match = F.col("__n") == F.col("__m")
        for i, k in enumerate(keys):
            match = match & F.col(k).eqNullSafe(F.col(f"__near{i}"))
        chained = chained.join(other, match, "left").drop("__m", *[f"__near{i}" for i in range(len(keys))])
    return in_window(df.where(~is_hot)).unionByName(chained.select(*df.columns, *values))


def next_value(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    name: str,
    min_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add ``name``: ``value`` of the next row with the same ``keys`` in ascending ``order``."""
    return neighbours(df, keys, order, {name: (value, 1)}, min_rows)


def fill_keys(df: DataFrame, name: str, order: Sequence[str | Column]) -> DataFrame:
    """Number the rows whose ``name`` is NULL, continuing after the highest number in use."""
    df = df.withColumn(name, F.col(name).cast("bigint"))
    highest = df.agg(F.max(name)).first()[0] or 0
    fresh = surrogate_key(df.where(F.col(name).isNull()).drop(name), order, name, highest + 1)
    return df.where(F.col(name).isNotNull()).unionByName(fresh)
