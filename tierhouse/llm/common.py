"""Words, shingles and row identity, shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame, SparkSession

WORD_BREAK = "[ \\t-\\r]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


# Rows of a batch that goes to a Python worker; documents can be long, and a batch is held whole.
BATCH_ROWS = 500


def small_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batch size to ``BATCH_ROWS`` unless it is lower already."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


# Documents, and rows of small tables such as links, that a task writes at least where it can.
TASK_DOCUMENTS, TASK_ROWS = 5_000, 200_000


def few_files(df: DataFrame, rows: int, task_rows: int = TASK_ROWS) -> DataFrame:
    """``df``, which has some ``rows`` rows, dealt to as few tasks as tasks of ``task_rows`` rows make.

    Small tables that are written between steps then have few files, however many partitions a shuffle has. Where that
    would be no fewer than a shuffle's, nothing is dealt anew. (Merging partitions without a shuffle would keep the
    memory of all their sorts and joins until the one task ends.)
    """
    tasks = max(1, -(-rows // task_rows))
    return df.repartition(tasks) if tasks < int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once, also where ``body`` uses it within a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def packed(docs: DataFrame) -> Column:
    """The whole row as one column, so that its columns clash with none of an operator's own."""
    return F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("row")


def unpacked(df: DataFrame, names: list[str], *, replaced: dict[str, Column]) -> DataFrame:
    """The columns of a packed row again; those in ``replaced`` are replaced or added at the end."""
    known = [replaced[n].alias(n) if n in replaced else F.col("row").getField(n).alias(n) for n in names]
    return df.select(*known, *(c.alias(n) for n, c in replaced.items() if n not in names))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def words(text: Column) -> Column:
    """Runs of anything but space, tab, line ends, vertical tab and form feed, with A-Z lower-cased; NULL for NULL."""
    return F.array_remove(F.split(ascii_lower(text), WORD_BREAK), "")


def shingles(text: Column, width: int) -> Column:
    """Distinct 64-bit hashes of the runs of ``width`` words of a text.

    Fewer words make one shingle, the whole sequence; no words, or NULL, make none.
    """
    empty = F.array().cast("array<bigint>")

    def of(found: Column) -> Column:
        def one(i: Column) -> Column:
            return F.xxhash64(*(F.get(found, i + F.lit(j)) for j in range(width)))

        short = F.array(F.xxhash64(F.array_join(found, " ")))
        full = F.array_distinct(F.transform(F.sequence(F.lit(0), F.size(found) - F.lit(width)), one))
        return F.when(F.size(found) == 0, empty).when(F.size(found) < width, short).otherwise(full)

    return F.coalesce(bound(words(text), of), empty)


def text_hash(text: Column) -> Column:
    return F.xxhash64(text)


# Bits of a row filter: per row looked for, and at most (32 MB).
BITS_PER_ROW, MOST_BITS = 16, 1 << 28
_PAGE = 32_768  # bits of one bitmap of Spark's bitmap functions


def possibly_in(rows: DataFrame, keys: list[str], wanted: DataFrame, wanted_keys: list[str]) -> DataFrame:
    """The rows whose keys may be among the wanted ones: all that are, and some others.

    A bitmap of hashed keys is broadcast, so that a join with few of many rows need not shuffle them all. Its size
    follows the number of wanted rows up to ``MOST_BITS``; beyond, more and more other rows pass.
    """
    count = wanted.count()
    bits = 1 << max(16, (BITS_PER_ROW * count).bit_length())
    bits = min(bits, MOST_BITS)
    place = F.pmod(F.xxhash64(*wanted_keys), F.lit(bits))
    bitmaps = (
        wanted.select(place.alias("place"))
        .groupBy(F.floor(F.col("place") / _PAGE).alias("page"))
        .agg(F.bitmap_construct_agg(F.pmod("place", F.lit(_PAGE))).alias("bitmap"))
    )
    own = F.pmod(F.xxhash64(*keys), F.lit(bits))
    spot = F.pmod(own, F.lit(_PAGE))
    byte = F.conv(F.hex(F.substring("bitmap", F.floor(spot / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    held = F.getbit(byte, F.pmod(spot, F.lit(8)).cast("int")) == 1
    met = rows.join(F.broadcast(bitmaps), F.floor(own / _PAGE) == F.col("page"))
    return met.filter(held).select(*rows.columns)


def all_equal(left: list[Column], right: list[Column]) -> Column:
    """Null-safe equality of several columns."""
    return reduce(lambda a, b: a & b, (x.eqNullSafe(y) for x, y in zip(left, right, strict=True)))


def renamed(df: DataFrame, prefix: str) -> DataFrame:
    return df.toDF(*(prefix + name for name in df.columns))
