"""Text cleaning: trimming, key clean-up, renaming, id normalisation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def quoted(name: str) -> Column:
    """Column reference that also works for names with dots or spaces."""
    return F.col("`" + name.replace("`", "``") + "`")


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def trim_strings(df: DataFrame) -> DataFrame:
    """Trim every string column of the schema in one projection."""
    return df.withColumns({name: F.trim(quoted(name)) for name in string_columns(df)})


def clean_keys(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    pattern: str = "-",
    replacement: str = "",
) -> DataFrame:
    """Trim and regex-replace the named columns; ``None`` means every string column.

    The all-columns form also rewrites text that is no key (a pattern ``-`` shortens
    ``Guinea-Bissau``), so name the key columns unless that is wanted.
    """
    names = string_columns(df) if columns is None else columns
    return df.withColumns(
        {name: F.regexp_replace(F.trim(quoted(name)), pattern, replacement) for name in names}
    )


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename by map. Names match case-insensitively; names that are absent are skipped."""
    return df.withColumnsRenamed(dict(names))


def strip_prefix(column: Column, prefix: str) -> Column:
    """Remove ``prefix`` only where the value starts with it."""
    rest = F.substring(column, F.lit(len(prefix) + 1), F.length(column))
    return F.when(column.startswith(prefix), rest).otherwise(column)


def normalize_id(column: Column) -> Column:
    """Upper-cased, trimmed text form of an id (numeric ids become text)."""
    return F.upper(F.trim(column.cast("string")))
