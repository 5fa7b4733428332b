"""Queries over the whole warehouse: silver tables, gold tables and the star queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import operators as op
from ..functions import clean_keys
from ..operators import (current_rows, group_counts, lookup, orphans, sales_summary, surrogate_key, table_counts,
                         without_orphans)
from ..plans import gold, silver
from ..sources import register_view
from .bronze import TODAY, bronze, with_layers
from .registry import query, table

_TODAY = dt.date.fromisoformat(TODAY)


def customers_of(spark: SparkSession, folder: str) -> DataFrame:
    return gold.dim_customers(
        silver.crm_customers(bronze(spark, folder, "crm_cust_info")),
        silver.erp_customers(bronze(spark, folder, "erp_cust_az12"), _TODAY),
        silver.erp_locations(bronze(spark, folder, "erp_loc_a101")),
    )


def products_of(spark: SparkSession, folder: str, versions: str = "latest", extra: tuple[str, ...] = ()) -> DataFrame:
    return gold.dim_products(
        silver.crm_products(bronze(spark, folder, "crm_prd_info")),
        silver.erp_categories(bronze(spark, folder, "erp_px_cat_g1v2")),
        versions,
        extra,
    )


def sales_of(spark: SparkSession, folder: str) -> DataFrame:
    return silver.crm_sales(bronze(spark, folder, "crm_sales_details"))


def stored_sales_of(spark: SparkSession, folder: str) -> DataFrame:
    """The sales as a table, as they are in the warehouse."""
    return op.materialize(sales_of(spark, folder), "sales")


@query(with_layers("SELECT * FROM silver_customers"))
def silver_crm_customers(spark, folder):
    return silver.crm_customers(bronze(spark, folder, "crm_cust_info"))


@query(with_layers("SELECT * FROM silver_products"))
def silver_crm_products(spark, folder):
    return silver.crm_products(bronze(spark, folder, "crm_prd_info"))


@query(
    with_layers(
        """SELECT * EXCLUDE (end_date), CAST(lead(start_date) OVER (PARTITION BY product_number
             ORDER BY start_date) - 1 AS date) AS end_date FROM silver_products"""
    )
)
def repaired_version_ranges(spark, folder):
    """Product versions whose end date is the day before the next version starts."""
    return silver.crm_products(bronze(spark, folder, "crm_prd_info"), repair_ranges=True)


@query(with_layers("SELECT * FROM silver_sales"))
def silver_crm_sales(spark, folder):
    return sales_of(spark, folder)


@query(
    with_layers(
        """SELECT * EXCLUDE (sales_amount), CASE WHEN sales_amount IS NULL OR sales_amount <= 0
             THEN quantity * price ELSE sales_amount END AS sales_amount FROM silver_sales"""
    )
)
def repair_sales(spark, folder):
    """Price first, then the sales amount from the repaired price."""
    return silver.crm_sales(bronze(spark, folder, "crm_sales_details"), fill_sales=True)


@query(with_layers("SELECT * FROM silver_erp_customers"))
def silver_erp_customers(spark, folder):
    return silver.erp_customers(bronze(spark, folder, "erp_cust_az12"), _TODAY)


@query(with_layers("SELECT * FROM silver_erp_locations"))
def silver_erp_locations(spark, folder):
    return silver.erp_locations(bronze(spark, folder, "erp_loc_a101"))


@query(with_layers("SELECT * FROM silver_erp_categories"))
def silver_erp_categories(spark, folder):
    return silver.erp_categories(bronze(spark, folder, "erp_px_cat_g1v2"))


@query(
    with_layers(
        """SELECT product_number, product_name, product_cost, product_line, start_date,
    lead(start_date) OVER w AS end_date, lead(start_date) OVER w IS NULL AS is_current, count(*) OVER () AS numbers
  FROM silver_products WINDOW w AS (PARTITION BY product_number ORDER BY start_date)"""
    )
)
def product_changes(spark, folder):
    """The history of all products from their rows in two batches, the newest first: late rows are spliced in."""
    rows = op.materialize(silver.crm_products(bronze(spark, folder, "crm_prd_info")), "products")
    known = spark.createDataFrame(
        [], "product_key BIGINT, product_number STRING, product_name STRING, product_cost INT, product_line STRING,"
        " start_date DATE, end_date DATE, is_current BOOLEAN"
    )
    for batch in ("product_id % 3 = 2", "product_id % 3 < 2"):
        known = gold.apply_product_changes(known, rows.where(batch))
    known = op.materialize(known, "history")
    return known.drop("product_key").withColumn("numbers", F.lit(known.select("product_key").distinct().count()))


@query(with_layers("SELECT * FROM gold_customers"))
def dim_customers(spark, folder):
    return customers_of(spark, folder)


@query(with_layers("SELECT * FROM gold_products"))
def dim_products(spark, folder):
    return products_of(spark, folder)


@query(
    with_layers(
        """SELECT row_number() OVER (ORDER BY p.start_date, p.product_number, p.product_id) AS product_key,
    p.product_id, p.product_number, p.product_name, p.category_id, k.category, k.subcategory, k.maintenance_flag,
    p.product_cost, p.end_date, p.product_line, p.start_date
  FROM silver_products p LEFT JOIN silver_erp_categories k ON p.category_id = k.category_id"""
    )
)
def dim_product_versions(spark, folder):
    """Every product version, with cost and end date."""
    return products_of(spark, folder, "all", ("product_cost", "end_date"))


@query(with_layers("SELECT * FROM gold_sales"))
def fact_sales(spark, folder):
    return gold.fact_sales(stored_sales_of(spark, folder), products_of(spark, folder), customers_of(spark, folder))


@query(
    with_layers(
        """SELECT s.order_number, p.product_key, s.sales_amount, s.quantity FROM silver_sales s
  LEFT JOIN (SELECT row_number() OVER (ORDER BY start_date, product_number, product_id) AS product_key,
      product_number, end_date FROM silver_products) p
    ON s.product_number = p.product_number AND p.end_date IS NULL"""
    )
)
def fact_current_products(spark, folder):
    """Keys of the versions that are open, looked up among all versions."""
    versions = products_of(spark, folder, "all", ("end_date",))
    keyed = lookup(sales_of(spark, folder), current_rows(versions, end="end_date"), ["product_number"], ["product_key"])
    return keyed.select("order_number", "product_key", "sales_amount", "quantity")


@query(
    with_layers(
        """SELECT s.order_number, c.customer_key, s.sales_amount FROM silver_sales s
  LEFT JOIN gold_customers c ON concat('AW', CAST(s.customer_id AS varchar)) = c.customer_number"""
    )
)
def fact_by_derived_key(spark, folder):
    """Customer lookup on a text key that is cleaned on both sides first."""
    sales = sales_of(spark, folder).withColumn("customer_ref", F.concat(F.lit("NAS-AW"), F.col("customer_id")))
    customers = customers_of(spark, folder)
    keyed = lookup(
        clean_keys(sales, ["customer_ref"], "NAS-"),
        clean_keys(customers, ["customer_number"], "NAS-"),
        {"customer_ref": "customer_number"},
        ["customer_key"],
    )
    return keyed.select("order_number", "customer_key", "sales_amount")


@query(
    with_layers("SELECT * FROM gold_sales WHERE product_key IS NOT NULL AND customer_key IS NOT NULL")
)
def facts_without_orphans(spark, folder):
    facts = gold.fact_sales(stored_sales_of(spark, folder), products_of(spark, folder), customers_of(spark, folder))
    return without_orphans(facts, ["product_key", "customer_key"])


@query(
    with_layers(
        """SELECT order_number, customer_id, sales_amount FROM silver_sales s
  WHERE NOT EXISTS (SELECT 1 FROM silver_customers c WHERE c.customer_id = s.customer_id)"""
    )
)
def orphan_facts(spark, folder):
    """Sales whose customer is not in the cleaned customer table, or is missing."""
    customers = silver.crm_customers(bronze(spark, folder, "crm_cust_info"))
    return orphans(sales_of(spark, folder), customers, ["customer_id"]).select(
        "order_number", "customer_id", "sales_amount"
    )


@query(
    """SELECT n_name AS country, p_type AS category, CAST(year(o_orderdate) AS int) AS year,
    CAST(month(o_orderdate) AS int) AS month,
    CAST(sum(CAST(l_extendedprice AS decimal(12, 2))) AS decimal(22, 2)) AS total_sales,
    count(DISTINCT l_orderkey) AS order_count,
    CAST(sum(CAST(l_extendedprice AS decimal(12, 2))) AS double) / count(*) AS average_sales
  FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN part ON l_partkey = p_partkey
  GROUP BY ALL ORDER BY total_sales DESC, country, category, year, month LIMIT 20"""
)
def star_sales(spark, folder):
    """Sales by country, category and month: the 20 largest."""
    customers = lookup(
        table(spark, folder, "customer"), table(spark, folder, "nation"), {"c_nationkey": "n_nationkey"},
        {"n_name": "country"},
    ).withColumnRenamed("c_custkey", "customer_key")
    products = table(spark, folder, "part").select(
        F.col("p_partkey").alias("product_key"), F.col("p_type").alias("category")
    )
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", F.col("l_partkey").alias("product_key"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("sales_amount"),
    )
    facts = lookup(
        lines, table(spark, folder, "orders"), {"l_orderkey": "o_orderkey"},
        {"o_custkey": "customer_key", "o_orderdate": "order_date"},
    )
    return sales_summary(facts, customers, products, order_number="l_orderkey")


@query(
    with_layers(
        """SELECT c.country, p.category, CAST(year(f.order_date) AS int) AS year,
    CAST(month(f.order_date) AS int) AS month, CAST(sum(f.sales_amount) AS bigint) AS total_sales,
    count(DISTINCT f.order_number) AS order_count,
    CAST(sum(f.sales_amount) AS double) / count(f.sales_amount) AS average_sales
  FROM gold_sales f LEFT JOIN gold_customers c ON f.customer_key = c.customer_key
  LEFT JOIN gold_products p ON f.product_key = p.product_key
  GROUP BY ALL ORDER BY total_sales DESC NULLS LAST, country NULLS FIRST, category NULLS FIRST,
    year NULLS FIRST, month NULLS FIRST LIMIT 20"""
    )
)
def star_sales_views(spark, folder):
    """The same star query as SQL text over a view of facts with the attributes of their dimensions.

    The attributes come by the lookup, as facts without a key, which are many, would meet in one task of a join.
    """
    customers, products = customers_of(spark, folder), products_of(spark, folder)
    facts = op.materialize(gold.fact_sales(stored_sales_of(spark, folder), products, customers), "facts")
    attributes = [(customers, ["customer_key"], ["country"]), (products, ["product_key"], ["category"])]
    register_view(op.lookup_all(facts, attributes, op.HOT_ROWS), "star_facts")
    return spark.sql(
        """SELECT country, category, year(order_date) AS year, month(order_date) AS month,
             sum(sales_amount) AS total_sales, count(DISTINCT order_number) AS order_count,
             avg(sales_amount) AS average_sales
           FROM star_facts
           GROUP BY country, category, year(order_date), month(order_date)
           ORDER BY total_sales DESC, country, category, year, month LIMIT 20"""
    )


@query(
    with_layers(
        """SELECT CAST(year(order_date) AS int) AS year, CAST(month(order_date) AS int) AS month,
    count(DISTINCT customer_key) AS customers, CAST(sum(quantity) AS bigint) AS pieces FROM gold_sales GROUP BY ALL"""
    )
)
def distinct_by_bitmap(spark, folder):
    """Customers per month by merged bitmaps of their numbers."""
    facts = gold.fact_sales(stored_sales_of(spark, folder), products_of(spark, folder), customers_of(spark, folder))
    dated = facts.select(F.year("order_date").alias("year"), F.month("order_date").alias("month"), "customer_key", "quantity")
    return op.distinct_by_bitmap(dated, ["year", "month"], "customer_key", "customers", {"quantity": "pieces"})


@query(
    with_layers(
        "SELECT country, count(*) AS customers FROM gold_customers GROUP BY country ORDER BY customers DESC, country"
    )
)
def customers_by_country(spark, folder):
    return group_counts(customers_of(spark, folder), ["country"], "customers", ordered=True)


@query(with_layers("SELECT gender, count(*) AS customers FROM gold_customers GROUP BY gender"))
def customers_by_gender(spark, folder):
    return group_counts(customers_of(spark, folder), ["gender"], "customers")


_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


@query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in _TABLES), "table_counts")
def table_row_counts(spark, folder):
    return table_counts({name: table(spark, folder, name) for name in _TABLES})


@query(
    """SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS order_key, o_orderkey, o_custkey,
    o_orderpriority FROM orders""",
    "surrogate_key",
)
def dense_surrogate_key(spark, folder):
    numbered = surrogate_key(table(spark, folder, "orders"), ["o_orderdate", "o_orderkey"], "order_key")
    return numbered.select("order_key", "o_orderkey", "o_custkey", "o_orderpriority")
