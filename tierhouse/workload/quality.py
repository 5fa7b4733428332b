"""Queries for data-quality rules and checks."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import operators as op
from ..plans import checked, rules
from ..sources.catalog import init_layers, write_table
from .bronze import bronze, with_layers
from .registry import query, table


def _sales(spark: SparkSession, folder: str) -> DataFrame:
    return checked.sales(bronze(spark, folder, "crm_sales_details"))


def _lenient(column: str) -> str:
    text = f"CAST({column} AS varchar)"
    return (
        f"CASE WHEN {text} IN ('0', '') THEN NULL WHEN regexp_full_match({text}, '[0-9]{{8}}')"
        f" THEN CAST(try_strptime({text}, '%Y%m%d') AS date) ELSE try_cast({text} AS date) END"
    )


_CHECKED = f"""checked_sales AS (
    SELECT upper(trim(sls_ord_num)) AS sales_order_number, upper(trim(sls_prd_key)) AS product_key,
      CAST(sls_cust_id AS varchar) AS customer_id, {_lenient('sls_order_dt')} AS sales_order_date,
      {_lenient('sls_ship_dt')} AS sales_ship_date, {_lenient('sls_due_dt')} AS sales_due_date,
      coalesce(sls_quantity, 0) AS sales_order_qty,
      CAST(coalesce(sls_sales, 0) AS decimal(10, 2)) AS sales_amount,
      CAST(coalesce(CASE WHEN sls_price IS NULL OR sls_price <= 0 THEN CASE WHEN sls_quantity <> 0 THEN
        sign(sls_sales) * ((abs(sls_sales) * 200 + sls_quantity) // (2 * sls_quantity)) / 100 END
        ELSE sls_price END, 0) AS decimal(10, 2)) AS sales_price
    FROM crm_sales_details)"""


def _with_checked(select: str, *more: str) -> str:
    return with_layers("").rstrip() + ",\n" + ",\n".join((_CHECKED, *more)) + "\n" + select


_SALES_RULES = {
    "valid_order_number": ("warn", "sales_order_number IS NOT NULL"),
    "valid_quantity": ("drop", "sales_order_qty > 0"),
    "valid_amount": ("drop", "sales_amount >= 0"),
    "valid_order_date": ("warn", "sales_order_date IS NOT NULL"),
    "valid_customer_product": ("warn", "customer_id IS NOT NULL AND product_key IS NOT NULL"),
}


@query(_with_checked("SELECT * FROM checked_sales"))
def checked_sales(spark, folder):
    return _sales(spark, folder)


@query(
    _with_checked(
        " UNION ALL ".join(
            f"SELECT '{name}' AS rule, '{action}' AS action, count(*) AS checked,"
            f" count(*) - count(*) FILTER (WHERE {condition}) AS violations FROM checked_sales"
            for name, (action, condition) in _SALES_RULES.items()
        )
    )
)
def expect_report(spark, folder):
    return op.rule_report(_sales(spark, folder), rules.SALES)


@query(_with_checked("SELECT * FROM checked_sales WHERE sales_order_qty > 0 AND sales_amount >= 0"))
def expect_drop(spark, folder):
    kept, _ = op.apply_rules(_sales(spark, folder), rules.SALES)
    return kept


_CHECKED_CUSTOMERS = """checked_customers AS (
    SELECT row_number() OVER (ORDER BY customer_id, customer_reference) AS customer_key, * FROM (
      SELECT upper(trim(cst_key)) AS customer_id, cst_id AS customer_reference, trim(cst_firstname) AS firstname,
        trim(cst_lastname) AS lastname,
        CASE WHEN upper(trim(cst_gndr)) = 'F' THEN 'Female' WHEN upper(trim(cst_gndr)) = 'M' THEN 'Male'
          ELSE e.gender END AS gender,
        trim(cst_marital_status) AS marital_status, e.birthday_date, l.country, cst_create_date AS create_date
      FROM crm_cust_info c
      LEFT JOIN (SELECT regexp_replace(trim(CID), '^NAS', '') AS id, BDATE AS birthday_date,
          CASE WHEN upper(trim(GEN)) IN ('F', 'FEMALE') THEN 'Female' WHEN upper(trim(GEN)) IN ('M', 'MALE')
            THEN 'Male' ELSE 'n/a' END AS gender FROM erp_cust_az12) e ON upper(trim(c.cst_key)) = e.id
      LEFT JOIN (SELECT replace(CID, '-', '') AS id, trim(CNTRY) AS country FROM erp_loc_a101) l
        ON upper(trim(c.cst_key)) = l.id))"""

_CHECKED_PRODUCTS = """checked_products AS (
    SELECT row_number() OVER (ORDER BY product_number) AS product_key_sk, upper(product_number) AS product_key
    FROM newest_products)"""

_CHECKED_FACTS = """checked_facts AS (
    SELECT sales_order_number, customer_key, product_key_sk, sales_order_date, sales_ship_date, sales_due_date,
      sales_order_qty, sales_amount, CAST(sales_order_qty * sales_price AS decimal(21, 2)) AS revenue
    FROM (SELECT * FROM checked_sales WHERE sales_order_qty > 0 AND sales_amount >= 0) s
    LEFT JOIN checked_customers c ON s.customer_id = CAST(c.customer_reference AS varchar)
    LEFT JOIN checked_products p ON s.product_key = p.product_key)"""


def _customers(spark: SparkSession, folder: str) -> DataFrame:
    return checked.dim_customers(
        checked.crm_customers(bronze(spark, folder, "crm_cust_info")),
        checked.erp_customers(bronze(spark, folder, "erp_cust_az12")),
        checked.erp_locations(bronze(spark, folder, "erp_loc_a101")),
    )


def _facts(spark: SparkSession, folder: str) -> DataFrame:
    """Facts as the refresh builds them: from the sales that pass their own rules."""
    categories = checked.erp_products(bronze(spark, folder, "erp_px_cat_g1v2"))
    products = checked.crm_products(bronze(spark, folder, "crm_prd_info"), categories)
    sales, _ = op.apply_rules(_sales(spark, folder), rules.SALES)
    dimension = checked.dim_products(op.materialize(products), dt.date(2024, 6, 1))
    facts = checked.fact_sales(sales, _customers(spark, folder), dimension)
    return facts.withColumn("revenue", F.col("revenue").cast("decimal(21,2)"))


@query(_with_checked("SELECT * FROM checked_customers", _CHECKED_CUSTOMERS))
def checked_customers(spark, folder):
    return op.enforce(_customers(spark, folder), rules.DIM_CUSTOMERS)


@query(
    _with_checked(
        "SELECT * FROM checked_facts WHERE customer_key IS NOT NULL AND product_key_sk IS NOT NULL",
        _CHECKED_CUSTOMERS, _CHECKED_PRODUCTS, _CHECKED_FACTS,
    )
)
def checked_facts(spark, folder):
    """Facts under the fact rules: orphans are dropped, negative revenue would stop the run."""
    kept, _ = op.apply_rules(_facts(spark, folder), rules.FACT_SALES)
    return kept


@query(
    _with_checked(
        "SELECT * FROM checked_facts WHERE customer_key IS NOT NULL AND product_key_sk IS NOT NULL",
        _CHECKED_CUSTOMERS, _CHECKED_PRODUCTS, _CHECKED_FACTS,
    )
)
def checked_refresh_facts(spark, folder):
    """The fact table that a refresh of all checked tables publishes."""
    run = uuid.uuid4().hex
    layers = [f"{layer}_{run}" for layer in ("bronze", "silver", "gold")]
    init_layers(spark, {name: "" for name in layers})
    for name in (*checked.BRONZE, "crm_prd_info"):
        write_table(bronze(spark, folder, name), f"{layers[0]}.{name}")
    checked.refresh(spark, *layers)
    facts = spark.table(f"{layers[2]}.fact_sales")
    return facts.withColumn("revenue", F.col("revenue").cast("decimal(21,2)"))


@query(
    _with_checked(
        " UNION ALL ".join(
            f"SELECT '{name}' AS rule, '{action}' AS action, count(*) AS checked, {violations} AS violations"
            " FROM checked_facts"
            for name, action, violations in (
                (
                    "has_dimension_keys", "drop",
                    "count(*) FILTER (WHERE customer_key IS NULL OR product_key_sk IS NULL)",
                ),
                (
                    "positive_revenue", "fail",
                    "count(*) FILTER (WHERE customer_key IS NOT NULL AND product_key_sk IS NOT NULL AND revenue < 0)",
                ),
                (
                    "valid_dates_order", "warn",
                    "count(*) - count(*) FILTER (WHERE sales_ship_date IS NULL OR sales_order_date <= sales_ship_date)",
                ),
            )
        ),
        _CHECKED_CUSTOMERS, _CHECKED_PRODUCTS, _CHECKED_FACTS,
    )
)
def fact_rule_report(spark, folder):
    return op.rule_report(_facts(spark, folder), rules.FACT_SALES)


def _amounts(spark: SparkSession, folder: str) -> DataFrame:
    return bronze(spark, folder, "crm_sales_details").selectExpr(
        "sls_ord_num AS order_number", "sls_prd_key AS product_key", "sls_cust_id AS customer_id",
        "sls_sales AS sales", "sls_quantity AS quantity", "sls_price AS price",
    )


@query(
    with_layers(
        """SELECT sls_ord_num AS order_number, sls_sales AS sales, sls_quantity AS quantity, sls_price AS price,
    sls_quantity * sls_price AS expected_sales FROM crm_sales_details
  WHERE sls_sales <> sls_quantity * sls_price OR sls_sales IS NULL OR sls_sales <= 0"""
    )
)
def dq_sales_mismatch(spark, folder):
    return op.amount_mismatches(_amounts(spark, folder), ["order_number"])


@query(
    with_layers(
        """SELECT sls_ord_num AS order_number, sls_quantity AS quantity, sls_price AS price FROM crm_sales_details
  WHERE sls_price < 0 OR sls_quantity <= 0"""
    )
)
def dq_negative(spark, folder):
    return op.negative_amounts(_amounts(spark, folder), ["order_number"])


@query(
    with_layers(
        """SELECT 'order_number' AS "column", count(*) - count(sls_ord_num) AS null_count FROM crm_sales_details
  UNION ALL SELECT 'product_key', count(*) - count(sls_prd_key) FROM crm_sales_details
  UNION ALL SELECT 'customer_id', count(*) - count(sls_cust_id) FROM crm_sales_details"""
    )
)
def dq_null_counts(spark, folder):
    return op.null_counts(_amounts(spark, folder), ["order_number", "product_key", "customer_id"])


@query(
    with_layers(
        """SELECT order_number, order_date, ship_date FROM silver_sales
  WHERE NOT coalesce(ship_date IS NULL OR order_date <= ship_date, FALSE)"""
    )
)
def dq_date_order(spark, folder):
    """Sales shipped before they were ordered, or whose order date is unknown."""
    from .layers import sales_of

    in_order = op.expect("valid_dates_order", op.dates_in_order("order_date", "ship_date"))
    return sales_of(spark, folder).where(~in_order.holds).select("order_number", "order_date", "ship_date")


@query(
    """SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY ALL HAVING count(*) > 1"""
)
def dq_duplicate_keys(spark, folder):
    return op.duplicate_keys(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])
