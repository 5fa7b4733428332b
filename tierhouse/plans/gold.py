"""Gold layer: the star schema built from the silver tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import prefer
from ..operators.key_maps import KeyMap
from ..operators.merging import scd2_apply_changes, scd2_merge
from ..operators.numbering import fill_keys, surrogate_key
from ..operators.staging import materialize
from ..operators.star import conform, with_dimension_keys
from ..operators.versions import current_rows, latest_version, with_open_version
from . import labels


def dim_customers(
    customers: DataFrame, erp_customers: DataFrame, erp_locations: DataFrame, key_map: KeyMap | None = None
) -> DataFrame:
    """CRM customers enriched from ERP; the CRM gender wins unless it is missing.

    With a ``key_map`` a customer keeps the number it once got, otherwise all are numbered anew by id.
    """
    joined = conform(
        customers,
        [
            (erp_customers, {"customer_number": "customer_number"}, {"gender": "erp_gender", "birth_date": "birthdate"}),
            (erp_locations, {"customer_number": "customer_number"}, {"country": "country"}),
        ],
    )
    shaped = joined.select(
        "customer_id",
        "customer_number",
        "first_name",
        "last_name",
        "country",
        "marital_status",
        prefer(F.col("gender"), F.col("erp_gender"), labels.MISSING, labels.MISSING).alias("gender"),
        "birthdate",
        F.col("created_date").alias("create_date"),
    )
    return _numbered(materialize(shaped), ["customer_id", "customer_number"], "customer_key", key_map)


def _numbered(rows: DataFrame, order: Sequence[str], name: str, key_map: KeyMap | None) -> DataFrame:
    if key_map is None:
        return surrogate_key(rows, order, name)
    key_map.extend(rows, order)
    return key_map.number(rows)


def dim_products(
    products: DataFrame, categories: DataFrame, versions: str = "latest", extra: tuple[str, ...] = (),
    key_map: KeyMap | None = None,
) -> DataFrame:
    """Products with their category.

    ``versions``: ``latest`` keeps the newest version per product, ``open`` those without an end
    date, ``all`` every version (facts then join once per version). ``extra`` names further silver
    columns to carry along. With a ``key_map`` (latest versions only) a product keeps its number.
    """
    if key_map is not None and versions != "latest":
        raise ValueError("a key map needs one row per product")
    if versions == "latest":
        products = latest_version(products, ["product_number"], ["start_date", "product_id"])
    elif versions == "open":
        products = current_rows(products, end="end_date")
    elif versions != "all":
        raise ValueError("versions must be latest, open or all")
    taken = {c: c for c in ("category", "subcategory", "maintenance_flag")}
    joined = conform(products, [(categories, {"category_id": "category_id"}, taken)])
    shaped = joined.select(
        "product_id",
        "product_number",
        "product_name",
        "category_id",
        "category",
        "subcategory",
        "maintenance_flag",
        *extra,
        "product_line",
        "start_date",
    )
    return _numbered(materialize(shaped), ["start_date", "product_number", "product_id"], "product_key", key_map)


def product_history(
    dimension: DataFrame, products: DataFrame, effective: dt.date, keys: Sequence[str] = ("product_number",),
    tracked: Sequence[str] = ("product_name", "product_cost", "product_line"), number: str = "product_key",
) -> DataFrame:
    """The versioned product dimension after a batch that takes effect on one day.

    Changed products get a new version, which is numbered after the highest number in use, so that facts can look it
    up; earlier versions keep their numbers.
    """
    merged = materialize(scd2_merge(dimension, products, keys, tracked, effective), "versions")
    return fill_keys(merged, number, [*keys])


def apply_product_changes(
    dimension: DataFrame, changes: DataFrame, number: str = "product_key", sequence: str = "start_date",
    delete: str | None = None,
) -> DataFrame:
    """The versioned product dimension after rows that carry the day they hold from, in whatever order they arrive.

    Late rows are spliced in between known versions; new versions are numbered after the highest number in use.
    """
    rows = changes.select("product_number", *[c for c in changes.columns if c in dimension.columns and c not in (
        "product_number", number, "start_date", "end_date", "is_current")], F.col(sequence).alias("__from"),
        *([F.expr(delete).alias("__gone")] if delete else []))
    applied = scd2_apply_changes(dimension, rows, ["product_number"], "__from", "__gone" if delete else None)
    return fill_keys(materialize(applied, "versions"), number, ["product_number", "start_date"])


def product_batch(products: DataFrame) -> DataFrame:
    """The newest row of each product, as a batch for its history."""
    newest = latest_version(products, ["product_number"], ["start_date", "product_id"])
    return newest.select("product_number", "product_id", "category_id", "product_name", "product_cost", "product_line")


def first_history(products: DataFrame, effective: dt.date, number: str = "product_key") -> DataFrame:
    """The versioned product dimension from a first batch: one open version per product."""
    return surrogate_key(materialize(with_open_version(products, effective)), ["product_number"], number)


def fact_sales(sales: DataFrame, products: DataFrame, customers: DataFrame) -> DataFrame:
    """Sales lines with surrogate keys; a line without a matching dimension row keeps NULL.

    The dimensions need one row per looked-up key; the refresh checks that when it publishes them.
    """
    keyed = with_dimension_keys(
        sales,
        [
            (products, {"product_number": "product_number"}, "product_key"),
            (customers, {"customer_id": "customer_id"}, "customer_key"),
        ],
    )
    return keyed.select(
        "order_number",
        "product_key",
        "customer_key",
        "order_date",
        "ship_date",
        "due_date",
        "sales_amount",
        "quantity",
        "price",
    )
