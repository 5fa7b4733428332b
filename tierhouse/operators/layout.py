"""File layout: compaction, clustering and write sizes."""

from __future__ import annotations

import itertools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.curves import bucket_of, interleave_bits
from .staging import row_hash, scratch_path

# Fixed value: compaction aims at files of about 1 GB.
TARGET_FILE_BYTES = 1 << 30


def files_of(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """One row per data file with its size, from the file listing (no content is read)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
    return files.load(path).select("path", "length", "modificationTime")


def file_summary(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """File count, total bytes and the smallest and largest file."""
    return files_of(spark, path, pattern).agg(
        F.count("*").alias("files"),
        F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"),
        F.min("length").alias("smallest"),
        F.max("length").alias("largest"),
    )


def compact(spark: SparkSession, source: str, target: str, file_bytes: int = TARGET_FILE_BYTES) -> None:
    """Rewrite many small parquet files as few large ones at a new path.

    Files of different schemas are merged (columns that a file lacks are NULL; types that conflict are an error), and
    partition folders stay as they are named. The scan packs files up to ``file_bytes`` into one task and each task
    writes one file, so nothing is shuffled, unless there are partition folders: then the rows are brought together by
    folder. A second session holds the settings, the caller's stays as it is.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
    session.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(file_bytes))
    session.conf.set("spark.sql.files.maxPartitionBytes", str(file_bytes))
    session.conf.set("spark.sql.files.openCostInBytes", "0")
    session.conf.set("spark.sql.files.minPartitionNum", "1")
    reader = session.read.option("mergeSchema", "true")
    rows = reader.parquet(source)
    stored = reader.option("recursiveFileLookup", "true").parquet(source).columns  # without those of folders
    folders = [c for c in rows.columns if c not in stored]
    if folders:
        sized_for_write(rows, *folders).write.partitionBy(*folders).parquet(target)
    else:
        rows.write.parquet(target)


def compaction_plan(
    spark: SparkSession, path: str, file_bytes: int = TARGET_FILE_BYTES, small_below: int | None = None,
    pattern: str = "*.parquet",
) -> DataFrame:
    """What ``compact_small`` does with each file: ``path, folder, length`` and ``bin``, NULL for files left alone.

    Files of less than ``small_below`` bytes (three quarters of ``file_bytes`` unless given) are packed folder by folder
    into bins of about ``file_bytes``, in the order of their sizes; a small file that is alone in its bin stays.
    """
    small_below = file_bytes * 3 // 4 if small_below is None else small_below
    listed = files_of(spark, path, pattern).select(
        "path", F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("folder"), "length"
    )
    small = F.col("length") < small_below
    before = Window.partitionBy("folder", small).orderBy("length", "path").rowsBetween(Window.unboundedPreceding, -1)
    place = F.floor(F.coalesce(F.sum("length").over(before), F.lit(0)) / file_bytes)
    packed = listed.withColumn("bin", F.when(small, place))
    mates = F.count("*").over(Window.partitionBy("folder", "bin"))
    return packed.withColumn("bin", F.when(mates > 1, F.col("bin")))


def compact_small(
    spark: SparkSession, source: str, target: str, file_bytes: int = TARGET_FILE_BYTES, small_below: int | None = None
) -> list[str]:
    """Pack the small files of a parquet folder into large ones below ``target``; large files are not touched.

    Returns the files that now hold the rows: those left alone, and the new ones. Folders of partitions keep their
    names below ``target``. The small files stay where they are until the caller, who knows the readers, removes them.
    Nothing is shuffled: a scan packs the files of a folder up to ``file_bytes`` into a task, which writes one file.
    """
    plan = compaction_plan(spark, source, file_bytes, small_below).orderBy("path").collect()  # a row per file
    session = spark.newSession()
    for name, value in (("maxPartitionBytes", file_bytes), ("openCostInBytes", 0), ("minPartitionNum", 1)):
        session.conf.set(f"spark.sql.files.{name}", str(value))
    packed: dict[str, list[str]] = {}
    for row in plan:
        if row["bin"] is not None:
            packed.setdefault(row["folder"], []).append(row["path"])
    for folder, files in packed.items():
        below = "/".join(itertools.takewhile(lambda part: "=" in part, reversed(folder.split("/"))))
        below = "/".join(reversed(below.split("/")))
        rows = session.read.option("mergeSchema", "true").parquet(*files)
        rows.write.mode("append").parquet(f"{target}/{below}" if below else target)
    kept = [row["path"] for row in plan if row["bin"] is None]
    return kept + [r["path"] for r in files_of(spark, target).select("path").collect()] if packed else kept


# Rows that a size estimate encodes.
SAMPLED_ROWS = 50_000


def bytes_per_row(df: DataFrame, rows: int | None = None) -> float:
    """Stored bytes of a row, from a random sample that is written and measured.

    ``rows`` is the row count where it is known. Columns that repeat values take less in larger files.
    """
    rows = df.count() if rows is None else rows
    if not rows:
        return 1.0
    drawn = df if rows <= SAMPLED_ROWS else df.sample(SAMPLED_ROWS / rows, seed=11)
    path = scratch_path(df.sparkSession, "row-sample")
    drawn.repartition(1).write.parquet(path)
    stored = file_summary(df.sparkSession, path).first()["bytes"]
    return stored / max(1, df.sparkSession.read.parquet(path).count())


def rows_within(df: DataFrame, size: int, rows: int | None = None) -> int:
    """Rows that take about ``size`` stored bytes; for ``task_rows`` of ``surrogate_key`` and rows per file."""
    return max(1, int(size / bytes_per_row(df, rows)))


def write_files(df: DataFrame, path: str, file_bytes: int = TARGET_FILE_BYTES, rows: int | None = None) -> None:
    """Write parquet files of about ``file_bytes``, by a row count that comes from the size of encoded rows."""
    rows = df.count() if rows is None else rows
    each = rows_within(df, file_bytes, rows)
    df.repartition(max(1, -(-rows // each))).write.option("maxRecordsPerFile", each * 5 // 4).parquet(path)


# Values of a text column that its bucket bounds are taken from.
SAMPLED_TEXTS = 10_000


def _rankable(df: DataFrame, name: str) -> Column:
    """The column, or a number that sorts like it."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.DateType):
        return F.unix_date(F.col(name))
    if isinstance(kind, T.TimestampNTZType):
        return F.unix_micros(F.col(name).cast("timestamp"))
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(F.col(name))
    if isinstance(kind, T.BooleanType):
        return F.col(name).cast("int")
    return F.col(name)


def with_curve_key(df: DataFrame, columns: Sequence[str], name: str, bits: int = 8) -> DataFrame:
    """Add a z-order key of the columns, each cut into at most 2**bits buckets of about equal size.

    The bucket bounds are approximate quantiles from one aggregate over those columns, for text
    those of a random sample of ``SAMPLED_TEXTS`` whole values; 2**bits numbers per column, or that
    sample, come to the driver.
    """
    ranks = {f"__rank_{c}": _rankable(df, c) for c in columns}
    steps = [i / (1 << bits) for i in range(1, 1 << bits)]
    ranked = df.withColumns(ranks)
    texts = [c for c in columns if isinstance(df.schema[c].dataType, T.StringType)]
    numbers = [f"__rank_{c}" for c in columns if c not in texts]
    found = ranked.agg(*[F.percentile_approx(r, steps, 10_000).alias(r) for r in numbers]).first() if numbers else {}
    found = {r: [b for b in found[r] or [] if b == b] for r in numbers}  # NaN sorts last and bounds nothing
    for c in texts:
        values = ranked.select(F.col(f"`{c}`").alias("v")).where("v IS NOT NULL")
        drawn = sorted(r.v for r in values.orderBy(F.rand(7)).limit(SAMPLED_TEXTS).collect())
        found[f"__rank_{c}"] = [drawn[int(s * len(drawn))] for s in steps] if drawn else []
    # The buckets are columns of their own, as the key uses each of them once per bit.
    buckets = {f"__bucket{r}": bucket_of(r, sorted(set(found[r]))) for r in ranks}
    keyed = ranked.withColumns(buckets).withColumn(name, interleave_bits([F.col(b) for b in buckets], bits))
    return keyed.drop(*ranks, *buckets)


def cluster(df: DataFrame, columns: Sequence[str], bits: int = 8) -> DataFrame:
    """Range-partition and sort along the z-order curve, ready to be written.

    Each file then covers a small range of every column, so min/max statistics skip files. Rows
    with one curve key are separated by the columns themselves and a row hash: a frequent
    combination does not end up in one file.
    """
    keyed = with_curve_key(df, columns, "__curve", bits).withColumns(
        {"__row": row_hash(df), "__source": F.spark_partition_id()}
    )
    placed = keyed.repartitionByRange("__curve", *columns, "__row", "__source")
    return placed.sortWithinPartitions("__curve", *columns).drop("__curve", "__row", "__source")


def sized_for_write(df: DataFrame, *columns: str) -> DataFrame:
    """Let adaptive execution split or merge the write tasks to its advisory size.

    With columns, rows of one value stay together as far as their size allows: a value with very
    many rows is split over several tasks.
    """
    return df.hint("rebalance", *columns)
