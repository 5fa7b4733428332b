"""Tolerant date parsing. Bad input gives NULL, also with ANSI mode on."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


# Eight digits become an ISO date. In the strict form everything else becomes "--", which is no date;
# in the lenient form only numbers of five and more digits do, as they would pass for years. One
# expression that names its input once stays small when the planner copies it into filters.
_STRICT = r"(?s)^(?:(\d{4})(\d{2})(\d{2})|.*)$"
_LENIENT = r"(?s)^(?:(\d{4})(\d{2})(\d{2})|[+-].*|\d{5,}.*)$"
_ISO = "$1-$2-$3"


# Whole numbers take no pattern: in their text only eight digits can become an ISO date, and four a year. The expression
# stays small, as a projection with several dates is no longer compiled beyond a certain size.
_WHOLE = ("tinyint", "smallint", "int", "bigint")


def _by_type(column: Column, whole: Column, text: Column) -> Column:
    """``whole`` if the column's type is a whole number, else ``text``; the planner keeps one of them."""
    return F.when(F.typeof(column).isin(*_WHOLE), whole).otherwise(text).try_cast("date")


def _iso(digits: Column) -> Column:
    """``20101229`` -> ``2010-12-29``; NULL unless there are eight characters."""
    dashed = F.overlay(F.overlay(digits, F.lit("-"), F.lit(5), F.lit(0)), F.lit("-"), F.lit(8), F.lit(0))
    return F.when(F.length(digits) == 8, dashed)


def parse_yyyymmdd(column: Column) -> Column:
    """YYYYMMDD number or text to date; 0, other lengths and impossible days give NULL."""
    text = column.cast("string")
    return _by_type(column, _iso(text), F.regexp_replace(text, _STRICT, _ISO))


def lenient_date(column: Column) -> Column:
    """Like :func:`parse_yyyymmdd`, but text that is not eight digits gets the default date parse.

    Signed numbers and years beyond 9999 give NULL.
    """
    text = column.cast("string")
    return _by_type(column, _iso(text).when(F.length(text) == 4, text), F.regexp_replace(text, _LENIENT, _ISO))


def future_to_null(column: Column, today: dt.date | Column | None = None) -> Column:
    """NULL for dates after ``today`` (the current date unless given)."""
    if today is None:
        limit = F.current_date()
    else:
        limit = today if isinstance(today, Column) else F.lit(today)
    return F.when(~(column > limit), column)
