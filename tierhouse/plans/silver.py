"""Silver layer: one cleaning function per bronze table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import (category_id, clean_keys, default_to, future_to_null, map_codes, parse_yyyymmdd,
                         product_number, rename_columns, repair_price, repair_sales, strip_prefix, trim_strings,
                         yes_no_flag)
from ..operators.versions import require_not_null, version_ranges
from . import labels


def crm_customers(bronze: DataFrame) -> DataFrame:
    """Customers with an id; marital status and gender as labels."""
    coded = trim_strings(require_not_null(bronze, ["cst_id"])).withColumns(
        {
            "cst_marital_status": map_codes(F.col("cst_marital_status"), labels.MARITAL_STATUS, labels.MISSING),
            "cst_gndr": map_codes(F.col("cst_gndr"), labels.GENDER, labels.MISSING),
        }
    )
    return rename_columns(coded, labels.CRM_CUSTOMER_NAMES)


def crm_products(bronze: DataFrame, repair_ranges: bool = False) -> DataFrame:
    """Product versions with the compound key split into category and number.

    ``repair_ranges`` replaces end dates by the day before the next version of the product, for
    sources whose end dates lie before the start dates.
    """
    key = F.col("prd_key")
    parsed = trim_strings(bronze).withColumns(
        {
            "cat_id": category_id(key),
            "prd_key": product_number(key),
            "prd_cost": default_to(F.col("prd_cost"), 0),
            "prd_line": map_codes(F.col("prd_line"), labels.PRODUCT_LINE, labels.MISSING),
            "prd_start_dt": F.col("prd_start_dt").cast("date"),
        }
    )
    named = rename_columns(parsed, labels.CRM_PRODUCT_NAMES)
    if not repair_ranges:
        return named
    order = named.columns
    return version_ranges(named, ["product_number"], "start_date", flag=None, day_before=True).select(*order)


def crm_sales(bronze: DataFrame, fill_sales: bool = False) -> DataFrame:
    """Sales lines with parsed dates and repaired prices; ``fill_sales`` repairs the amounts too."""
    dates = {c: parse_yyyymmdd(F.col(c)) for c in ("sls_order_dt", "sls_ship_dt", "sls_due_dt")}
    sales, quantity, price = F.col("sls_sales"), F.col("sls_quantity"), F.col("sls_price")
    repaired = trim_strings(bronze).withColumns({**dates, "sls_price": repair_price(price, sales, quantity)})
    if fill_sales:
        repaired = repaired.withColumn("sls_sales", repair_sales(sales, quantity, price))
    return rename_columns(repaired, labels.CRM_SALES_NAMES)


def erp_customers(bronze: DataFrame, today: dt.date | None = None) -> DataFrame:
    """Birth dates and genders by customer number; the key loses its system prefix."""
    cleaned = trim_strings(bronze).withColumns(
        {
            "cid": strip_prefix(F.col("cid"), "NAS"),
            "bdate": future_to_null(F.col("bdate"), today),
            "gen": map_codes(F.col("gen"), labels.GENDER_LONG, labels.MISSING),
        }
    )
    return rename_columns(cleaned, labels.ERP_CUSTOMER_NAMES)


def erp_locations(bronze: DataFrame) -> DataFrame:
    """Countries by customer number; known codes become names, blanks become the missing label."""
    country = map_codes(F.col("cntry"), labels.COUNTRY, labels.MISSING, passthrough=True, ignore_case=False)
    cleaned = clean_keys(trim_strings(bronze), ["cid"], "-").withColumn("cntry", country)
    return rename_columns(cleaned, labels.ERP_LOCATION_NAMES)


def erp_categories(bronze: DataFrame) -> DataFrame:
    """Product categories with the maintenance answer as a boolean."""
    cleaned = trim_strings(bronze).withColumn("maintenance", yes_no_flag(F.col("maintenance")))
    return rename_columns(cleaned, labels.ERP_CATEGORY_NAMES)


# Silver table -> (bronze table, builder), in build order.
BUILDERS = {
    "crm_customers": ("crm_cust_info", crm_customers),
    "crm_products": ("crm_prd_info", crm_products),
    "crm_sales": ("crm_sales_details", crm_sales),
    "erp_customers": ("erp_cust_az12", erp_customers),
    "erp_customer_location": ("erp_loc_a101", erp_locations),
    "erp_product_category": ("erp_px_cat_g1v2", erp_categories),
}
