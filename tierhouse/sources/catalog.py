"""Tables, views and their metadata."""

from __future__ import annotations

import contextlib
import io
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.layout import file_summary, sized_for_write

# Rows at which a sized table starts the next file.
FILE_ROWS = 10_000_000

LAYERS = {
    "bronze": "Source rows as they were delivered",
    "silver": "One cleaned table per source table",
    "gold": "Dimensions and facts for reports",
}


def _text(value: str) -> str:
    """SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _properties(values: Mapping[str, str]) -> str:
    return ", ".join(f"{_text(k)} = {_text(v)}" for k, v in values.items())


def init_layers(spark: SparkSession, layers: Mapping[str, str] = LAYERS, catalog: str | None = None) -> None:
    """Create the schemas that are missing; ``catalog`` selects the catalog first."""
    if catalog:
        spark.catalog.setCurrentCatalog(catalog)
    for name, comment in layers.items():
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name} COMMENT {_text(comment)}")


def write_table(
    df: DataFrame,
    name: str,
    mode: str = "overwrite",
    format: str = "parquet",
    comment: str | None = None,
    properties: Mapping[str, str] | None = None,
    path: str | None = None,
    partition_by: Sequence[str] = (),
    bucket_by: tuple[int, Sequence[str]] | None = None,
    sized: bool = False,
    bloom: Sequence[str] = (),
) -> None:
    """Write a managed table, or an external one if ``path`` is given.

    ``bucket_by`` (number, columns) lets later joins on those columns skip the shuffle. ``sized``
    balances the output files: with ``partition_by`` the rows of a folder are brought together by size;
    without, no row is shuffled for it, as the tasks of a scan and of an adaptive shuffle have been sized
    already, and files are cut at ``FILE_ROWS`` rows. ``bloom`` names columns that get Bloom filters, so that a lookup of a
    value that a row group lacks does not read it, also where its range holds the value. A table cannot be overwritten from itself: write the new rows under
    another name or as a new snapshot.
    """
    writer = (sized_for_write(df, *partition_by) if sized and partition_by else df).write.mode(mode).format(format)
    if sized:
        writer = writer.option("maxRecordsPerFile", FILE_ROWS)
    for column in bloom:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    if path:
        writer = writer.option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        number, columns = bucket_by
        writer = writer.bucketBy(number, *columns).sortBy(*columns)
    writer.saveAsTable(name)
    spark = df.sparkSession
    if comment:
        spark.sql(f"COMMENT ON TABLE {name} IS {_text(comment)}")
    if properties:
        set_properties(spark, name, properties)


def replace_table(df: DataFrame, name: str, comment: str | None = None) -> None:
    """Write a managed table that takes the place of ``name`` when all its rows are written.

    The rows are written once, to a table of their own, which gets the name of the old one; the old one stays if that
    write fails. Between the removal of the old table and the renaming there is none for a moment.
    """
    spark, aside = df.sparkSession, f"{name}_{uuid.uuid4().hex}"
    try:
        write_table(df, aside, comment=comment)
    except BaseException:
        drop_table(spark, aside)
        raise
    drop_table(spark, name)
    spark.sql(f"ALTER TABLE {aside} RENAME TO {name}")


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def set_properties(spark: SparkSession, name: str, properties: Mapping[str, str]) -> None:
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({_properties(properties)})")


def unset_properties(spark: SparkSession, name: str, keys: Sequence[str]) -> None:
    spark.sql(f"ALTER TABLE {name} UNSET TBLPROPERTIES IF EXISTS ({', '.join(map(_text, keys))})")


def get_properties(spark: SparkSession, name: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}


def describe(spark: SparkSession, name: str) -> DataFrame:
    """Columns and detailed table information, among it whether the table is managed or external."""
    return spark.sql(f"DESCRIBE EXTENDED {name}")


def detail(spark: SparkSession, name: str) -> DataFrame:
    """One row: format, location, type and the number and size of the files."""
    facts = {r["col_name"]: r["data_type"] for r in describe(spark, name).collect()}
    summary = file_summary(spark, facts["Location"])
    return summary.select(
        F.lit(name).alias("name"),
        F.lit(facts["Provider"]).alias("format"),
        F.lit(facts["Type"]).alias("type"),
        F.lit(facts["Location"]).alias("location"),
        F.col("files").alias("num_files"),
        F.col("bytes").alias("size_in_bytes"),
    )


def register_view(df: DataFrame, name: str, everywhere: bool = False) -> None:
    """Name a frame for SQL, in this session or (``everywhere``) as ``global_temp.name``."""
    df.createOrReplaceGlobalTempView(name) if everywhere else df.createOrReplaceTempView(name)


def preview(df: DataFrame, rows: int = 10, order: Sequence[str | Column] = ()) -> DataFrame:
    """A few rows; with ``order`` always the same ones."""
    return (df.orderBy(*order) if order else df).limit(rows)


def field_types(df: DataFrame) -> dict[str, str]:
    """Column names and types in order."""
    return dict(df.dtypes)


def plan_text(df: DataFrame, mode: str = "extended") -> str:
    """The plans of a frame as text, without running it (modes as in ``DataFrame.explain``)."""
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain(mode=mode)
    return text.getvalue()
