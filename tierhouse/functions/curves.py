"""Space-filling-curve keys for co-locating rows by several columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def interleave_bits(buckets: Sequence[Column], bits: int) -> Column:
    """Z-order key: bit ``i`` of bucket ``j`` lands on bit ``i * len(buckets) + j``."""
    width = len(buckets)
    if bits * width > 62:
        raise ValueError("the interleaved key must fit into a signed 64-bit integer")
    key = F.lit(0).cast("bigint")
    for i in range(bits):
        for j, bucket in enumerate(buckets):
            bit = F.shiftright(bucket.cast("bigint"), i).bitwiseAND(F.lit(1).cast("bigint"))
            key = key + F.shiftleft(bit, i * width + j)
    return key


def bucket_of(column: str, bounds: Sequence) -> Column:
    """Number of sorted ``bounds`` that are <= the column, as a balanced tree of comparisons.

    The tree stays inside generated code and costs log2(len(bounds)) comparisons per row. NULL
    falls into bucket 0.
    """

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        reached = F.col(f"`{column}`") >= F.lit(bounds[middle])
        return F.when(reached, search(middle + 1, high)).otherwise(search(low, middle))

    return search(0, len(bounds))
