"""Parts of a compound product key such as ``CO-RF-FR-R92B-58``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: width of the category part; one separator follows it.
CATEGORY_WIDTH = 5


def category_id(key: Column) -> Column:
    """``CO-RF-FR-R92B-58`` -> ``CO_RF``."""
    return F.translate(F.substring(key, 1, CATEGORY_WIDTH), "-", "_")


def product_number(key: Column) -> Column:
    """``CO-RF-FR-R92B-58`` -> ``FR-R92B-58``."""
    return F.substring(key, F.lit(CATEGORY_WIDTH + 2), F.length(key))


def first_segment(key: Column) -> Column:
    """``CO-RF-FR-R92B-58`` -> ``CO``."""
    return F.substring_index(key, "-", 1)


def drop_first_segment(key: Column) -> Column:
    """``CO-RF-FR-R92B-58`` -> ``RF-FR-R92B-58`` (only a leading segment of capital letters goes)."""
    return F.regexp_replace(key, "^[A-Z]+-", "")


def middle_segment(key: Column) -> Column:
    """``BK-M68B-42`` -> ``M68B``; an empty string where there is no middle segment."""
    return F.regexp_extract(key, "^[^-]+-([^-]+)-", 1)
