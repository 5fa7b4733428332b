"""Key lookups that stay balanced when one key, or NULL, holds a large share of the rows.

How two sides meet is left to Spark: it broadcasts a side that its statistics show to be small, also at
run time, and splits skewed partitions of a sort-merge join. Where the rows of single keys are too many even
so, a sketch finds these keys first; they are spread over several partitions, with the matching rows of the
other side copied once per partition.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A key with more rows than this is split into parts of about this size.
HOT_ROWS = 2_000_000
# Keys that the frequency sketch reports, and keys it tracks while it runs: with these every key
# with at least a thousandth of the rows is found.
TOP_KEYS, TRACKED_KEYS = 1000, 10_000

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows in which none of the columns is NULL (NaN is a value and stays)."""
    return df.where(functools.reduce(Column.__and__, [F.col(c).isNotNull() for c in columns]))


def key_hash(keys: Sequence[str | Column]) -> Column:
    return F.xxhash64(*[F.col(k) if isinstance(k, str) else k for k in keys])


def _any_null(keys: Sequence[Column]) -> Column:
    return functools.reduce(Column.__or__, [k.isNull() for k in keys])


def frequent(df: DataFrame, hashes: Sequence[Column], min_rows: int = HOT_ROWS) -> list[dict[int | None, int]]:
    """For each column the values with more than ``min_rows`` rows, and their approximate row counts.

    One pass for all columns with a sketch of bounded size per task; at most ``TOP_KEYS`` values per
    column come back. The result only steers how work is spread: operators give the same rows
    whatever it contains.
    """
    named = df.select(*[h.alias(f"h{i}") for i, h in enumerate(hashes)])
    sketches = [f"approx_top_k(h{i}, {TOP_KEYS}, {TRACKED_KEYS}) AS h{i}" for i in range(len(hashes))]
    found = named.agg(*[F.expr(s) for s in sketches]).first()
    return [{hit["item"]: hit["count"] for hit in hits if hit["count"] > min_rows} for hits in found]


def hot_keys(df: DataFrame, keys: Sequence[str], min_rows: int = HOT_ROWS) -> dict[int, int]:
    """Hash and approximate rows of the keys with more than ``min_rows`` rows; NULL counts as a value."""
    return frequent(df, [key_hash(keys)], min_rows)[0]


def spread(columns: Sequence[Column], parts: Column) -> Column:
    """A part number below ``parts`` per row, from its input partition and the given columns.

    The partition separates even exact copies of a row. A repeated task gives the same numbers
    again, whatever order its rows arrive in.
    """
    return F.pmod(F.xxhash64(F.spark_partition_id(), *columns), parts)


def _same_type(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]]) -> tuple[list[Column], list[Column]]:
    """Key columns of both sides in one type, as equal keys must also hash equally."""
    ls, rs = [], []
    for l, r in pairs:
        lt, rt = left.schema[l].dataType, right.schema[r].dataType
        if lt == rt:
            ls.append(F.col(l)), rs.append(F.col(r))
        elif isinstance(lt, _WHOLE) and isinstance(rt, _WHOLE):
            ls.append(F.col(l).cast("bigint")), rs.append(F.col(r).cast("bigint"))
        else:
            raise TypeError(f"cast {l} ({lt.simpleString()}) and {r} ({rt.simpleString()}) to one type first")
    return ls, rs


class _Side:
    """The looked-up rows, cut down to keys and wanted columns, and how they meet the left rows."""

    def __init__(self, left: DataFrame, right: DataFrame, on, take, how: str):
        pairs = list(on.items()) if isinstance(on, Mapping) else [(k, k) for k in on]
        take = dict(take) if isinstance(take, Mapping) else {c: c for c in take}
        self.how = how
        self.added = list(take.values()) if how in ("left", "inner") else []
        self.left_keys, right_keys = _same_type(left, right, pairs)
        self.names = [f"__right{i}" for i in range(len(pairs))]
        rows = right.select(
            *[k.alias(n) for k, n in zip(right_keys, self.names)], *[F.col(c).alias(n) for c, n in take.items()]
        )
        self.rows = not_null(rows, self.names)

    def match(self) -> Column:
        return functools.reduce(Column.__and__, [k == F.col(n) for k, n in zip(self.left_keys, self.names)])

    def hash(self) -> Column:
        """Hash of the left key; NULL for rows without a key."""
        return F.when(~_any_null(self.left_keys), key_hash(self.left_keys))

    def join(
        self, left: DataFrame, hot: dict[int | None, int], min_rows: int | None, spread_by: Sequence[Column]
    ) -> DataFrame:
        result = left.columns + self.added
        if not hot:
            return left.join(self.rows, self.match(), self.how).select(*result)
        parts = {h: math.ceil(n / min_rows) for h, n in hot.items()}
        without_key = parts.pop(None, 1)
        keyed, rows, number = left, self.rows, F.lit(1)
        if parts:
            # At most TOP_KEYS rows.
            plan = F.broadcast(left.sparkSession.createDataFrame(list(parts.items()), "__hash bigint, __parts bigint"))
            keyed = keyed.withColumn("__hash", self.hash()).join(plan, "__hash", "left")
            rows = rows.withColumn("__hash", key_hash(self.names)).join(plan, "__hash", "left")
            number = F.coalesce(F.col("__parts"), F.lit(1))
        # Rows without a key match nothing, so they may go to any part.
        split = F.when(_any_null(self.left_keys), F.lit(without_key)).otherwise(number)
        part = F.when(split > 1, spread(spread_by, split)).otherwise(F.lit(0)).cast("bigint")
        copies = F.explode(F.sequence(F.lit(0).cast("bigint"), number.cast("bigint") - 1))
        match = self.match() & (F.col("__part") == F.col("__copy"))
        keyed = keyed.withColumn("__part", part)
        return keyed.join(rows.select(*self.names, *self.added, copies.alias("__copy")), match, self.how).select(*result)


def lookup_all(
    left: DataFrame,
    steps: Sequence[tuple],
    min_rows: int | None = None,
    spread_by: Sequence[str] = (),
) -> DataFrame:
    """Several lookups into one frame; each step is (right, on, take) or (right, on, take, how).

    All keys are columns of ``left``. With ``min_rows``, keys with more rows than that are found first, for all steps in
    one pass over the key columns of ``left``, and spread; so are rows without a key. Give it for large facts that are
    stored, as a computed ``left`` would run twice (``materialize`` stores one). Rows of a frequent key are spread by
    their input partition, the keys of all steps and the ``spread_by`` columns; further columns would have to be read
    for nothing where the result does not use them.
    """
    sides = [_Side(left, step[0], step[1], step[2], step[3] if len(step) > 3 else "left") for step in steps]
    names = [*left.columns, *[c for side in sides for c in side.added]]
    clash = {n for n in names if names.count(n) > 1}
    if clash:
        raise ValueError(f"columns would occur twice: {sorted(clash)}")
    hot = frequent(left, [side.hash() for side in sides], min_rows) if min_rows else [{} for _ in sides]
    columns = [k for side in sides for k in side.left_keys] + [F.col(c) for c in spread_by]
    for side, found in zip(sides, hot, strict=True):
        left = side.join(left, found, min_rows, columns)
    return left


def lookup(
    left: DataFrame,
    right: DataFrame,
    on: Mapping[str, str] | Sequence[str],
    take: Mapping[str, str] | Sequence[str] = (),
    how: str = "left",
    min_rows: int | None = None,
) -> DataFrame:
    """Join ``right`` to ``left`` on equal keys and add the ``take`` columns.

    ``on`` maps left to right key names, ``take`` maps right names to result names. ``how`` is
    left, inner, left_semi or left_anti. A right key that occurs more than once gives one row each,
    as in any join. ``min_rows`` as in ``lookup_all``.
    """
    return lookup_all(left, [(right, on, take, how)], min_rows)
