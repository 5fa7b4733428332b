"""Versioned tables: an ordinary parquet table with one partition per version.

Every row carries the commit time and operation of its version, which cost next to nothing in columnar files, and each
version has one row more that stands for the version itself (``_is_row`` is false), so that an empty table is a version
like any other. Versions are listed by grouping, found by filtering, and restored by appending the old rows again. One
writer at a time is assumed.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .staging import folder_exists

VERSION, COMMITTED, OPERATION = "_version", "_committed_at", "_operation"
_IS_ROW = "_is_row"
_OWN = f"{COMMITTED} TIMESTAMP_NTZ, {OPERATION} STRING, {_IS_ROW} BOOLEAN"
# Fixed value: default number of hours a replaced version is kept.
RETENTION_HOURS = 168


def _moment(value: dt.datetime | str) -> Column:
    return F.lit(value).cast("timestamp_ntz")


def _rows(spark: SparkSession, path: str) -> DataFrame:
    """All rows of all versions, without the data: columns of the versions alone are read."""
    return spark.read.schema(f"{_OWN}, {VERSION} BIGINT").parquet(path)


def versions(spark: SparkSession, path: str) -> DataFrame:
    """Version numbers and commit times. Row groups of data are skipped by their statistics."""
    return _rows(spark, path).where(f"NOT {_IS_ROW}").select(VERSION, COMMITTED)


def _last(spark: SparkSession, path: str):
    return versions(spark, path).orderBy(F.desc(VERSION)).first() if folder_exists(spark, path) else None


def latest_number(spark: SparkSession, path: str) -> int | None:
    """Number of the newest version, or None if there is none yet."""
    last = _last(spark, path)
    return last[VERSION] if last else None


def append_snapshot(df: DataFrame, path: str, committed_at: dt.datetime, operation: str = "WRITE") -> int:
    """Write ``df`` as the next version and return its number (0 for the first).

    A commit time that is not later than that of the newest version is refused.
    """
    spark = df.sparkSession
    last = _last(spark, path)
    if last and committed_at <= last[COMMITTED]:
        raise ValueError(f"version {last[VERSION]} was committed at {last[COMMITTED]}, not before {committed_at}")
    version = last[VERSION] + 1 if last else 0
    own = {COMMITTED: _moment(committed_at), OPERATION: F.lit(operation)}
    itself = spark.range(1).select(*[c.alias(n) for n, c in own.items()], F.lit(False).alias(_IS_ROW))
    rows = df.withColumns({**own, _IS_ROW: F.lit(True)}).unionByName(itself, allowMissingColumns=True)
    # A try that failed before it was committed is replaced.
    rows.write.mode("overwrite").parquet(f"{path}/{VERSION}={version}")
    return version


def append_snapshots(df: DataFrame, path: str, operation: str = "WRITE") -> None:
    """Write rows that carry their version number and commit time as versions of a new table."""
    spark = df.sparkSession
    if _last(spark, path):
        raise ValueError(f"{path} already has versions")
    own = {OPERATION: F.lit(operation), _IS_ROW: F.lit(True)}
    known = df.groupBy(VERSION).agg(F.min(COMMITTED).alias(COMMITTED)).withColumns({**own, _IS_ROW: F.lit(False)})
    rows = df.withColumns(own).unionByName(known, allowMissingColumns=True)
    rows.write.partitionBy(VERSION).parquet(path)


def version_as_of(spark: SparkSession, path: str, moment: dt.datetime | str) -> int:
    """Number of the last version committed at or before ``moment``."""
    known = versions(spark, path).where(F.col(COMMITTED) <= _moment(moment))
    number = known.agg(F.max(VERSION)).first()[0]
    if number is None:
        raise LookupError(f"no version at {moment}")
    return number


def read_version(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """One version of the table, with its own columns; the newest unless a number is given."""
    number = latest_number(spark, path) if version is None else version
    folder = f"{path}/{VERSION}={number}"
    if number is None or not folder_exists(spark, folder):
        raise LookupError(f"no version {number}")
    return spark.read.parquet(folder).where(_IS_ROW).drop(COMMITTED, OPERATION, _IS_ROW)


def read_as_of(spark: SparkSession, path: str, moment: dt.datetime | str) -> DataFrame:
    """The table as it was at ``moment``."""
    return read_version(spark, path, version_as_of(spark, path, moment))


def history(spark: SparkSession, path: str) -> DataFrame:
    """Versions with commit time, operation and row count, newest first."""
    grouped = _rows(spark, path).groupBy(VERSION).agg(
        F.min(COMMITTED).alias(COMMITTED), F.min(OPERATION).alias(OPERATION), F.count_if(_IS_ROW).alias("row_count")
    )
    return grouped.orderBy(F.desc(VERSION))


def restore(spark: SparkSession, path: str, version: int, committed_at: dt.datetime) -> int:
    """Make an old version the current one: its rows are appended as a new version."""
    return append_snapshot(read_version(spark, path, version), path, committed_at, "RESTORE")


def expired_versions(
    spark: SparkSession, path: str, now: dt.datetime | str, retention_hours: int = RETENTION_HOURS
) -> DataFrame:
    """Versions a clean-up would remove; lists them and deletes nothing.

    A version expires when it was replaced more than ``retention_hours`` ago; the newest never does.
    """
    cutoff = _moment(now) - F.expr(f"INTERVAL '{int(retention_hours)}' HOUR")
    # One row per version: small whatever the size of the table.
    replaced = F.lead(COMMITTED).over(Window.orderBy(VERSION))
    known = versions(spark, path).withColumn("replaced_at", replaced)
    return known.where(F.col("replaced_at") < cutoff).select(VERSION, COMMITTED, "replaced_at")
