"""Number repair, defaults and derived measures."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def default_to(column: Column, value) -> Column:
    """NULL replaced by ``value``. Use a ``Decimal`` for decimal columns: a float widens them to double."""
    return F.coalesce(column, F.lit(value))


def to_int(column: Column) -> Column:
    """Integer, with 0 for NULL and for text that is no integer."""
    return default_to(column.try_cast("int"), 0)


def to_money(column: Column, kind: str = "decimal(10,2)") -> Column:
    """Decimal, with 0.00 for NULL and for text that is no number."""
    return F.coalesce(column.try_cast(kind), F.lit(Decimal("0.00")).cast(kind))


def _missing(column: Column) -> Column:
    return column.isNull() | (column <= 0)


def repair_price(price: Column, sales: Column, quantity: Column) -> Column:
    """Missing, zero or negative price becomes sales / quantity (NULL for quantity 0)."""
    return F.when(_missing(price), F.try_divide(sales, quantity)).otherwise(price)


def repair_sales(sales: Column, quantity: Column, price: Column) -> Column:
    """Missing, zero or negative sales becomes quantity * price."""
    return F.when(_missing(sales), quantity * price).otherwise(sales)


def repair_amounts(
    df: DataFrame, price: str = "price", sales: str = "sales_amount", quantity: str = "quantity"
) -> DataFrame:
    """Repair price first, then sales from the repaired price."""
    p, s, q = F.col(price), F.col(sales), F.col(quantity)
    return df.withColumn(price, repair_price(p, s, q)).withColumn(sales, repair_sales(s, q, p))


def expected_amount(quantity: Column, price: Column) -> Column:
    return quantity * price


def revenue(*factors: Column) -> Column:
    """Product of the factor columns; the usual choice is quantity and unit price."""
    result = factors[0]
    for factor in factors[1:]:
        result = result * factor
    return result
