"""Written intermediate tables in the shared folder of the cluster."""

from __future__ import annotations

import contextlib
import contextvars
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Where that is unset, the checkpoint folder given to the context counts. Only a local session
    may go without both; it then gets a temporary folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="tierhouse-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


_RUN: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("run", default=None)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    path = f"{shared_folder(spark)}/tierhouse/{label}-{uuid.uuid4().hex}"
    if (paths := _RUN.get()) is not None:
        paths.append(path)
    return path


def _located(spark: SparkSession, path: str):
    """File system and location of a path."""
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), location


def folder_exists(spark: SparkSession, path: str) -> bool:
    files, location = _located(spark, path)
    return files.exists(location)


@contextlib.contextmanager
def removed_afterwards(spark: SparkSession) -> Iterator[None]:
    """Delete the scratch paths that are handed out within the block at its end.

    Only for jobs whose results are tables by then: a frame that still reads such a path would break.
    """
    token = _RUN.set([])
    try:
        yield
    finally:
        paths = _RUN.get()
        _RUN.reset(token)
        for path in paths:
            files, location = _located(spark, path)
            files.delete(location, True)


def row_hash(df: DataFrame) -> Column:
    """Hash of all columns. Maps, which have no order, count as their sorted entries as text."""

    def hashable(field: T.StructField) -> Column:
        column = F.col(f"`{field.name}`")
        if not _has_map(field.dataType):
            return column
        if isinstance(field.dataType, T.MapType):
            return F.array_sort(F.transform(F.map_entries(column), lambda e: e.cast("string")))
        return F.to_json(F.struct(column))

    return F.xxhash64(*(hashable(f) for f in df.schema.fields))


def _has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_has_map(f.dataType) for f in kind.fields)
    return isinstance(kind, T.MapType) or isinstance(kind, T.ArrayType) and _has_map(kind.elementType)


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write the rows once and read them back: cuts lineage and survives lost executors.

    Columnar files instead of ``checkpoint()`` because later steps read few of the columns.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
