"""Batch reads of source files."""

from __future__ import annotations

import csv
import functools
import re
from collections import defaultdict
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .catalog import write_table


BAD_RECORD = "_bad_record"


# Files whose first lines one job reads.
_FILES_PER_JOB = 200


def header_manifest(spark: SparkSession, paths: str | Sequence[str], file_glob: str | None = None) -> dict[str, str]:
    """The first line of each file, by path. Files without a line are left out.

    The executors read one line of each file and no more: a limit of one row on one partition stops its scan. Paths and
    headers come to the driver, which lists the files to read in any case.
    """
    session = spark.newSession()
    for name in ("maxPartitionBytes", "openCostInBytes"):
        session.conf.set(f"spark.sql.files.{name}", str(1 << 50))  # a file is one partition
    listed = session.read.format("binaryFile")
    if file_glob:
        listed = listed.option("pathGlobFilter", file_glob)
    files = sorted(r["path"] for r in listed.load(paths).select("path").collect())  # reads no content
    found = {}
    for low in range(0, len(files), _FILES_PER_JOB):
        chunk = files[low : low + _FILES_PER_JOB]
        lines = [
            session.read.text(literal(f)).limit(1).select(F.lit(i).alias("file"), "value") for i, f in enumerate(chunk)
        ]
        found |= {chunk[r["file"]]: r["value"] for r in functools.reduce(DataFrame.union, lines).collect()}
    return found


def columns_of(header: str, schema: str) -> StructType:
    """The columns of ``schema`` in the order of a header line, others as text.

    Names match without regard to case.
    """
    wanted = _parsed(schema)
    names = next(csv.reader([header.removeprefix("\ufeff")]), [])
    by_name = {f.name.lower(): f for f in wanted.fields}
    missing = [f.name for f in wanted.fields if f.name.lower() not in {n.lower() for n in names}]
    if missing:
        raise ValueError(f"no column {', '.join(missing)} in the header {header!r}")
    return StructType([by_name.get(n.lower(), StructField(n, StringType())) for n in names])


def literal(path: str) -> str:
    """A path in which a reader takes no character for a pattern."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def _parsed(schema: str) -> StructType:
    return StructType.fromDDL(schema)


def with_bad_records(columns: StructType, bad_records: str) -> tuple[StructType, dict[str, str]]:
    """Read schema and reader options for a choice of what happens to rows that do not fit."""
    # Every file's header is compared with the columns: a file with other columns is an error, not misread.
    options = {"header": "true", "enforceSchema": "false"}
    if bad_records == "fail":
        return columns, options | {"mode": "FAILFAST"}
    if bad_records != "keep":
        raise ValueError("bad_records must be fail or keep")
    return columns.add(BAD_RECORD, StringType()), options | {"columnNameOfCorruptRecord": BAD_RECORD}


def read_csv(
    spark: SparkSession, path: str | Sequence[str], schema: str | None = None, file_glob: str | None = None,
    bad_records: str = "fail", metadata: bool = False,
) -> DataFrame:
    """CSV files with a header row each, read by column name into the columns of ``schema``.

    Every file is read by its own header, so the order of columns may differ from file to file; further columns are
    left out. A header without one of the columns is an error. Rows with a value that does not fit, or with too many or
    too few fields, fail the read, or with ``bad_records="keep"`` have the whole line in ``_bad_record`` (NULL in good
    rows). Without any file there are no rows. ``metadata`` adds load time and source file. Without a schema the types are inferred, at the price of a
    further scan, and all files need one header.
    """
    reader = spark.read
    told = with_ingest_metadata if metadata else lambda df: df
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)
    if not schema:
        return told(reader.option("header", "true").option("inferSchema", "true").csv(path))
    kept = [f.name for f in _parsed(schema).fields] + [BAD_RECORD] * (bad_records == "keep")
    by_header = defaultdict(list)
    for file, header in header_manifest(spark, path, file_glob).items():
        by_header[header].append(literal(file))

    def read(columns: StructType, files: str | Sequence[str]) -> DataFrame:
        columns, options = with_bad_records(columns, bad_records)
        rows = reader.options(**options).schema(columns).csv(files)
        return told(rows.select(*kept))

    if len(by_header) < 2:
        return read(columns_of(next(iter(by_header)), schema) if by_header else _parsed(schema), path)
    parts = [read(columns_of(header, schema), files) for header, files in by_header.items()]
    return functools.reduce(DataFrame.unionByName, parts)


def bad_records(df: DataFrame) -> DataFrame:
    """The rows of a stored table that did not fit their columns."""
    return df.where(F.col(BAD_RECORD).isNotNull())


def with_ingest_metadata(df: DataFrame) -> DataFrame:
    """Add load time and source file; works on one file read (not a union of some) and on file streams."""
    return df.withColumns(
        {"_ingest_timestamp": F.current_timestamp(), "_source_file": F.col("_metadata.file_path")}
    )


def ingest_all(
    spark: SparkSession, items: Iterable[Mapping[str, str]], database: str, metadata: bool = False
) -> dict[str, str]:
    """Load every item into a full-refresh table of ``database``; returns table name by item.

    Items have ``source``, ``path`` and ``table``, and may have a ``schema`` and ``bad_records`` (default ``keep``:
    rows that do not fit stay in the table with their line in ``_bad_record``).
    """
    written = {}
    for item in items:
        df = read_csv(spark, item["path"], item.get("schema"), bad_records=item.get("bad_records", "keep"), metadata=metadata)
        name = f"{database}.{item['table']}"
        write_table(df, name)
        written[item["table"]] = name
    return written
