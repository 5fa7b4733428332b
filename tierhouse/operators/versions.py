"""Row filters and slowly-changing-dimension versions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from .lookups import HOT_ROWS, hot_keys, key_hash, not_null
from .numbering import next_value, surrogate_key


def require_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows in which any of the columns is NULL."""
    return not_null(df, columns)


def current_rows(df: DataFrame, flag: str = "is_current", end: str | None = None) -> DataFrame:
    """Only the active versions: by flag, or by a NULL ``end`` column if that is named."""
    return df.where(F.col(end).isNull() if end else F.col(flag))


def with_current_flag(df: DataFrame, end: str = "end_date", flag: str = "is_current") -> DataFrame:
    return df.withColumn(flag, F.col(end).isNull())


def with_open_version(
    df: DataFrame,
    start_date: dt.date | None = None,
    start: str = "start_date",
    end: str = "end_date",
    flag: str = "is_current",
) -> DataFrame:
    """Stamp every row as a first, open version from ``start_date`` (today unless given)."""
    begin = F.current_date() if start_date is None else F.lit(start_date)
    return df.withColumns({start: begin, end: F.lit(None).cast("date"), flag: F.lit(True)})


def latest_version(df: DataFrame, keys: Sequence[str], newest_first: Sequence[str | Column]) -> DataFrame:
    """The newest row per key; give columns in an order that puts the newest first.

    Plain names sort descending. Each task keeps one row per key before the shuffle (the planner
    limits the window group on both sides of it), so a key with many rows costs no more than others.
    """
    order = [F.desc(c) if isinstance(c, str) else c for c in newest_first]
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(window)).where("__rank = 1").drop("__rank")


def version_ranges(
    df: DataFrame,
    keys: Sequence[str],
    start: str,
    tie_breakers: Sequence[str] = (),
    end: str = "end_date",
    flag: str | None = "is_current",
    day_before: bool = False,
    min_rows: int = HOT_ROWS,
) -> DataFrame:
    """Set each version's end to the start of the next one (or the day before it).

    Replaces end dates that do not fit the start dates, as in sources that close a version before
    it began.
    """
    df = next_value(df.drop(end), keys, [start, *tie_breakers], start, end, min_rows)
    if day_before:
        df = df.withColumn(end, F.date_sub(end, 1))
    return with_current_flag(df, end, flag) if flag else df


def version_check(df: DataFrame, keys: Sequence[str], flag: str = "is_current") -> DataFrame:
    """Keys with several versions, with the number of versions and of current ones."""
    return (
        df.groupBy(*keys)
        .agg(F.count("*").alias("versions"), F.sum(F.col(flag).cast("int")).alias("current_versions"))
        .where("versions > 1")
        .orderBy(F.desc("versions"), *keys)
    )


def versions_in_conflict(df: DataFrame, keys: Sequence[str], flag: str = "is_current") -> DataFrame:
    """Keys with more than one current version; empty for a sound dimension."""
    return df.groupBy(*keys).agg(F.count_if(F.col(flag)).alias("current_versions")).where("current_versions > 1")


# Rows of a chunk in which ranges of very frequent keys are swept.
SWEEP_ROWS = 500_000


def range_conflicts(
    df: DataFrame,
    keys: Sequence[str],
    start: str = "start_date",
    end: str = "end_date",
    inclusive: bool = False,
    min_rows: int = HOT_ROWS,
    chunk_rows: int = SWEEP_ROWS,
) -> DataFrame:
    """Where the version ranges of a key overlap, leave a gap or end before they begin: keys, ``conflict``, ``low, high``.

    Ranges are swept in the order of their starts, against the latest end so far. A range that starts before that end
    gives ``overlap`` with the part up to the earlier of both ends; one that starts after it gives ``gap`` with the part
    in between; one whose end lies before its start gives ``inverted`` and takes no part in the sweep. A NULL end is
    open, and so is the ``high`` of an overlap with two open ends. Ends are the first moment that no longer belongs to
    the range, or with ``inclusive`` (dates only) its last day; ``high`` always is the first moment after the conflict.
    Ranges without any length, and rows with a NULL start, are left out; a NULL key is a key. Sound histories give no rows.

    Keys with more than ``min_rows`` ranges are sorted across partitions and swept in chunks; the latest end before a
    chunk comes from one row per chunk.
    """
    names = [f"__k{i}" for i in range(len(keys))]
    after = F.date_add(end, 1) if inclusive else F.col(end)
    ranges = df.where(F.col(start).isNotNull()).select(
        *[F.col(k).alias(n) for k, n in zip(keys, names)], F.col(start).alias("low"), after.alias("high")
    )
    inverted = ranges.where("high < low").select(*names, F.lit("inverted").alias("conflict"), "high", "low").toDF(
        *names, "conflict", "low", "high"
    )
    ranges = ranges.where("high IS NULL OR high > low")
    # Open ends are the latest ones.
    ends = F.struct(F.col("high").isNull().alias("open"), F.col("high").alias("at"))
    sized = [F.col("high").isNull(), F.col("high")]

    def before(*partition: str, order: Sequence[str | Column]) -> WindowSpec:
        return Window.partitionBy(*partition).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)

    hot = hot_keys(ranges, names, min_rows)
    is_hot = key_hash(names).isin(list(hot))
    usual = ranges.where(~is_hot) if hot else ranges
    swept = usual.withColumn("latest", F.max(ends).over(before(*names, order=["low", *sized])))
    if hot:
        numbered = surrogate_key(ranges.where(is_hot), [*names, "low", *sized], "__n", rows=sum(hot.values()))
        placed = numbered.withColumn("__chunk", F.floor(F.col("__n") / chunk_rows))
        own = placed.withColumn("own", F.max(ends).over(before(*names, "__chunk", order=["__n"])))
        chunks = placed.groupBy(*names, "__chunk").agg(F.max(ends).alias("last"))
        earlier = chunks.withColumn("earlier", F.max("last").over(before(*names, order=["__chunk"])))
        named = earlier.select(*[F.col(n).alias(f"{n}c") for n in names], F.col("__chunk").alias("__c"), "earlier")
        match = F.col("__chunk") == F.col("__c")
        for n in names:
            match = match & F.col(n).eqNullSafe(F.col(f"{n}c"))
        joined = own.join(named, match).withColumn("latest", F.greatest("own", "earlier"))
        swept = swept.unionByName(joined.select(*names, "low", "high", "latest"))
    opened, latest = F.col("latest.open"), F.col("latest.at")
    first_end = F.when(opened, F.col("high")).otherwise(F.least("high", latest))
    found = (
        F.when(opened | (F.col("low") < latest), F.struct(F.lit("overlap").alias("c"), F.col("low").alias("l"), first_end.alias("h")))
        .when(F.col("low") > latest, F.struct(F.lit("gap").alias("c"), latest.alias("l"), F.col("low").alias("h")))
    )
    told = swept.withColumn("found", found).where("found IS NOT NULL").select(*names, "found.*").toDF(
        *names, "conflict", "low", "high"
    )
    return told.unionByName(inverted).toDF(*keys, "conflict", "low", "high")
