"""Dimensions, facts and the aggregate queries over them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .lookups import HOT_ROWS, lookup, lookup_all


def conform(
    master: DataFrame, enrichments: Sequence[tuple[DataFrame, Mapping[str, str], Mapping[str, str]]],
    min_rows: int | None = None,
) -> DataFrame:
    """Master rows with columns of other sources: one left lookup per (source, on, take)."""
    return lookup_all(master, enrichments, min_rows)


def with_dimension_keys(
    facts: DataFrame, dimensions: Sequence[tuple[DataFrame, Mapping[str, str], str]], min_rows: int | None = HOT_ROWS
) -> DataFrame:
    """Add the surrogate key of each (dimension, on, key) to the facts; misses stay NULL.

    Only the join columns and the key of a dimension take part. Keys with more than ``min_rows`` facts, and facts without
    a key, are spread; that reads the key columns of the facts once more, so ``facts`` should be stored.
    """
    return conform(facts, [(dimension, on, {key: key}) for dimension, on, key in dimensions], min_rows)


def without_orphans(facts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Facts whose dimension keys were all found."""
    return facts.where(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))


def orphans(facts: DataFrame, dimension: DataFrame, on: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """Facts whose natural key is not in the dimension (or is NULL)."""
    return lookup(facts, dimension, on, how="left_anti")


def group_counts(df: DataFrame, columns: Sequence[str], name: str = "rows", ordered: bool = False) -> DataFrame:
    """Rows per group; ``ordered`` puts the largest groups first, equal ones by group."""
    counts = df.groupBy(*columns).agg(F.count("*").alias(name))
    return counts.orderBy(F.desc(name), *columns) if ordered else counts


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per table, one row each."""
    parts = [df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def top_groups(
    df: DataFrame, groups: Mapping[str, Column], measures: Mapping[str, Column], by: str, limit: int
) -> DataFrame:
    """Aggregate by group expressions and keep the ``limit`` largest groups by one measure.

    Equal measures are ordered by the group columns, so the result does not change between runs.
    """
    grouped = df.groupBy(*[c.alias(n) for n, c in groups.items()])
    return (
        grouped.agg(*[c.alias(n) for n, c in measures.items()])
        .orderBy(F.desc(by), *[F.asc_nulls_first(n) for n in groups])
        .limit(limit)
    )


def sales_summary(
    facts: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    limit: int = 20,
    customer_key: str = "customer_key",
    product_key: str = "product_key",
    order_date: str = "order_date",
    sales: str = "sales_amount",
    order_number: str = "order_number",
    min_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Sales by country, category, year and month: total, distinct orders, average; largest first.

    Frequent and missing keys are spread as in ``with_dimension_keys``.
    """
    joined = lookup_all(
        facts, [(customers, [customer_key], ["country"]), (products, [product_key], ["category"])], min_rows
    )
    return top_groups(
        joined,
        {
            "country": F.col("country"),
            "category": F.col("category"),
            "year": F.year(order_date),
            "month": F.month(order_date),
        },
        {
            "total_sales": F.sum(sales),
            "order_count": F.countDistinct(order_number),
            # From the exact total, so that the order of the rows cannot change the last digit.
            "average_sales": F.try_divide(F.sum(sales).cast("double"), F.count(sales)),
        },
        by="total_sales",
        limit=limit,
    )


def distinct_by_bitmap(
    df: DataFrame, groups: Sequence[str], key: str, name: str = "distinct_count", measures: Mapping[str, str] | None = None
) -> DataFrame:
    """Exact number of different ``key`` values per group, and sums of ``measures`` (column to result name).

    Each task sets bits of 4 KB bitmaps, one per group and range of 32,768 keys; the bitmaps are merged after one shuffle
    by group and range, and their bits counted. Rows are not expanded, and a group with most of the rows has no more
    bitmaps than others. For dense numbers from 0 on, such as surrogate keys; a NULL key counts for nothing.
    """
    measures = dict(measures or {})
    ranges = df.groupBy(*groups, F.bitmap_bucket_number(F.col(key)).alias("__range")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(F.col(key))).alias("__bits"),
        *[F.sum(c).alias(n) for c, n in measures.items()],
    )
    return ranges.groupBy(*groups).agg(
        F.sum(F.bitmap_count("__bits")).alias(name), *[F.sum(n).alias(n) for n in measures.values()]
    )
