"""Code-to-label mapping and source priority."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def map_codes(
    column: Column,
    labels: Mapping[str, str],
    default: str = "n/a",
    passthrough: bool = False,
    ignore_case: bool = True,
) -> Column:
    """Replace codes by labels.

    Without ``passthrough`` every unknown value becomes ``default``; with it only blank and
    NULL do, and unknown values stay as they are.
    """
    by_label: dict[str, list[str]] = {}
    for code, label in labels.items():
        by_label.setdefault(label, []).append(code.upper() if ignore_case else code)
    subject = F.upper(column) if ignore_case else column

    if passthrough:
        result = F.when(column.isNull() | (column == ""), F.lit(default))
        remainder = column
    else:
        result = F
        remainder = F.lit(default)
    for label, codes in by_label.items():
        result = result.when(subject.isin(codes), F.lit(label))
    return remainder if result is F else result.otherwise(remainder)


def yes_no_flag(column: Column) -> Column:
    """Yes/No text as a boolean; anything else is NULL."""
    answer = F.upper(column)
    return F.when(answer.isin("YES", "NO"), answer == "YES")


def prefer(primary: Column, fallback: Column, missing: str = "n/a", default: str | None = None) -> Column:
    """``primary`` unless it is NULL or the ``missing`` marker, then ``fallback``, then ``default``."""
    first = F.when(primary != missing, primary)
    return F.coalesce(first, fallback) if default is None else F.coalesce(first, fallback, F.lit(default))
