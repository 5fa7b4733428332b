"""Bronze-shaped views of the given tables.

The given tables are clean, so dirt (padding, odd codes, zero dates, missing amounts, keys without a
partner) is derived from the keys. The expressions are plain SQL that Spark and DuckDB both run; every row of the
underlying tables takes part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.lookups import lookup
from .registry import table

# bronze table -> (rows it is made from, {column: expression})
SHAPES: dict[str, tuple[str, dict[str, str]]] = {
    "crm_cust_info": (
        "customer",
        {
            "cst_id": "CASE WHEN c_custkey % 50 = 7 THEN NULL ELSE CAST(c_custkey AS int) END",
            "cst_key": "concat(' AW', CAST(c_custkey AS string), ' ')",
            "cst_firstname": "concat('  ', c_name)",
            "cst_lastname": "concat(c_mktsegment, ' ')",
            "cst_marital_status": "CASE c_custkey % 4 WHEN 0 THEN 'S' WHEN 1 THEN ' m ' WHEN 2 THEN '' END",
            "cst_gndr": "CASE c_custkey % 5 WHEN 0 THEN 'F' WHEN 1 THEN 'm' WHEN 2 THEN ' ' WHEN 3 THEN 'x' END",
            "cst_create_date": "DATE '2020-01-01' + CAST(c_custkey % 1000 AS int)",
        },
    ),
    "erp_cust_az12": (
        "customer",
        {
            "CID": "concat(CASE WHEN c_custkey % 11 = 3 THEN 'NASXX' WHEN c_custkey % 2 = 0 THEN 'NASAW' ELSE 'AW' END,"
            " CAST(c_custkey AS string), ' ')",
            "BDATE": "DATE '1950-01-01' + CAST((c_custkey * 37) % 40000 AS int)",
            "GEN": "CASE c_custkey % 6 WHEN 0 THEN 'F' WHEN 1 THEN 'male' WHEN 2 THEN 'FEMALE ' WHEN 3 THEN ''"
            " WHEN 4 THEN ' M' END",
        },
    ),
    "erp_loc_a101": (
        "(SELECT * FROM customer JOIN nation ON c_nationkey = n_nationkey) AS c",
        {
            "CID": "concat(CASE WHEN c_custkey % 13 = 5 THEN 'XX-' ELSE 'AW-' END, CAST(c_custkey AS string))",
            "CNTRY": "CASE n_nationkey % 6 WHEN 0 THEN 'DE' WHEN 1 THEN 'USA' WHEN 2 THEN ' US' WHEN 3 THEN ' '"
            " WHEN 4 THEN concat(' ', n_name, ' ') END",
        },
    ),
    "crm_prd_info": (
        "part",
        {
            "prd_id": "CAST(p_partkey AS int)",
            "prd_key": "concat(substring(p_type, 1, 2), '-', substring(p_type, 3, 2), '-PN-',"
            " CAST(p_partkey - p_partkey % 3 AS string), ' ')",
            "prd_nm": "concat(' ', p_name, ' ')",
            "prd_cost": "CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE CAST(floor(p_retailprice) AS int) END",
            "prd_line": "CASE p_partkey % 6 WHEN 0 THEN 'M ' WHEN 1 THEN 'r' WHEN 2 THEN 'S' WHEN 3 THEN ' t'"
            " WHEN 4 THEN '' END",
            "prd_start_dt": "DATE '2010-01-01' + CAST((p_partkey % 3) * 365 + p_partkey % 7 AS int)",
            "prd_end_dt": "CASE WHEN p_partkey % 3 = 2 THEN NULL"
            " ELSE DATE '2010-01-01' + CAST(p_partkey % 300 AS int) END",
        },
    ),
    "erp_px_cat_g1v2": (
        "(SELECT DISTINCT p_type FROM part) AS p",
        {
            "ID": "CASE WHEN p_type = 'PROMO' THEN 'XX_XX'"
            " ELSE concat(substring(p_type, 1, 2), '_', substring(p_type, 3, 2)) END",
            "CAT": "concat(p_type, ' ')",
            "SUBCAT": "lower(p_type)",
            "MAINTENANCE": "CASE length(p_type) WHEN 5 THEN 'Yes' WHEN 6 THEN 'NO ' WHEN 7 THEN 'maybe' END",
        },
    ),
    "crm_sales_details": (
        "(SELECT * FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey) AS l",
        {
            "sls_ord_num": "concat(' SO', CAST(l_orderkey AS string))",
            "sls_prd_key": "CASE WHEN l_partkey % 97 = 0 THEN 'PN-none'"
            " ELSE concat('PN-', CAST(l_partkey - l_partkey % 3 AS string)) END",
            "sls_cust_id": "CASE WHEN l_orderkey % 13 = 0 THEN NULL ELSE CAST(o_custkey AS int) END",
            "sls_order_dt": "CASE WHEN l_orderkey % 17 = 0 THEN 0 WHEN l_orderkey % 19 = 0 THEN 32154"
            " WHEN l_orderkey % 23 = 0 THEN 20101340 WHEN l_orderkey % 29 = 0 THEN NULL"
            " ELSE CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) AS int) END",
            "sls_ship_dt": "CAST(year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate) AS int)",
            "sls_due_dt": "CASE WHEN l_partkey % 9 = 0 THEN NULL"
            " ELSE CAST(year(l_shipdate) * 10000 + month(l_shipdate) * 100 + 28 AS int) END",
            "sls_sales": "CASE (l_partkey + l_linenumber) % 11 WHEN 0 THEN NULL WHEN 1 THEN 0 WHEN 2 THEN -5"
            " WHEN 3 THEN 1 + CAST(floor(l_extendedprice) AS int)"
            " ELSE CAST(l_quantity AS int) * CAST(floor(l_extendedprice / l_quantity) AS int) END",
            "sls_quantity": "CASE WHEN l_orderkey % 31 = 0 THEN 0 WHEN l_orderkey % 37 = 0 THEN NULL"
            " ELSE CAST(l_quantity AS int) END",
            "sls_price": "CASE (l_partkey + l_linenumber) % 7 WHEN 0 THEN NULL WHEN 1 THEN 0 WHEN 2 THEN -1"
            " ELSE CAST(floor(l_extendedprice / l_quantity) AS int) END",
        },
    ),
}

# Columns of the joined tables that the expressions use.
_ORDER_COLUMNS = ["o_custkey", "o_orderdate"]


def _base(spark: SparkSession, folder: str, name: str) -> DataFrame:
    if name in ("crm_cust_info", "erp_cust_az12"):
        return table(spark, folder, "customer")
    if name == "erp_loc_a101":
        customer, nation = table(spark, folder, "customer"), table(spark, folder, "nation")
        return lookup(customer, nation, {"c_nationkey": "n_nationkey"}, ["n_nationkey", "n_name"], how="inner")
    if name == "crm_prd_info":
        return table(spark, folder, "part")
    if name == "erp_px_cat_g1v2":
        return table(spark, folder, "part").select("p_type").distinct()
    return lookup(
        table(spark, folder, "lineitem"), table(spark, folder, "orders"), {"l_orderkey": "o_orderkey"}, _ORDER_COLUMNS
    )


def bronze(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One bronze table as a frame."""
    return _base(spark, folder, name).selectExpr(*[f"{e} AS {c}" for c, e in SHAPES[name][1].items()])


def _bronze_sql(name: str) -> str:
    rows, columns = SHAPES[name]
    picked = ",\n    ".join(f"{e} AS {c}" for c, e in columns.items())
    return f"SELECT {picked}\n  FROM {rows}"


def _date(column: str) -> str:
    text = f"CAST({column} AS varchar)"
    return (
        f"CASE WHEN {text} = '0' OR length({text}) <> 8 THEN NULL"
        f" ELSE CAST(try_strptime({text}, '%Y%m%d') AS date) END"
    )


# Silver and gold in SQL, over the bronze definitions above. {today} stands for a fixed date.
TODAY = "2024-01-01"
LAYERS: dict[str, str] = {
    "silver_customers": """
  SELECT cst_id AS customer_id, trim(cst_key) AS customer_number, trim(cst_firstname) AS first_name,
    trim(cst_lastname) AS last_name,
    CASE upper(trim(cst_marital_status)) WHEN 'S' THEN 'Single' WHEN 'M' THEN 'Married' ELSE 'n/a' END
      AS marital_status,
    CASE upper(trim(cst_gndr)) WHEN 'F' THEN 'Female' WHEN 'M' THEN 'Male' ELSE 'n/a' END AS gender,
    cst_create_date AS created_date
  FROM crm_cust_info WHERE cst_id IS NOT NULL""",
    "silver_products": """
  SELECT prd_id AS product_id, replace(substr(trim(prd_key), 1, 5), '-', '_') AS category_id,
    substr(trim(prd_key), 7) AS product_number, trim(prd_nm) AS product_name,
    coalesce(prd_cost, 0) AS product_cost,
    CASE upper(trim(prd_line)) WHEN 'M' THEN 'Mountain' WHEN 'R' THEN 'Road' WHEN 'S' THEN 'Other Sales'
      WHEN 'T' THEN 'Touring' ELSE 'n/a' END AS product_line,
    CAST(prd_start_dt AS date) AS start_date, prd_end_dt AS end_date
  FROM crm_prd_info""",
    "silver_sales": f"""
  SELECT trim(sls_ord_num) AS order_number, sls_prd_key AS product_number, sls_cust_id AS customer_id,
    {_date('sls_order_dt')} AS order_date,
    {_date('sls_ship_dt')} AS ship_date,
    {_date('sls_due_dt')} AS due_date,
    sls_sales AS sales_amount, sls_quantity AS quantity,
    CASE WHEN sls_price IS NULL OR sls_price <= 0
      THEN CAST(sls_sales AS double) / nullif(sls_quantity, 0) ELSE CAST(sls_price AS double) END AS price
  FROM crm_sales_details""",
    "silver_erp_customers": f"""
  SELECT CASE WHEN trim(CID) LIKE 'NAS%' THEN substr(trim(CID), 4) ELSE trim(CID) END AS customer_number,
    CASE WHEN BDATE > DATE '{TODAY}' THEN NULL ELSE BDATE END AS birth_date,
    CASE WHEN upper(trim(GEN)) IN ('F', 'FEMALE') THEN 'Female' WHEN upper(trim(GEN)) IN ('M', 'MALE') THEN 'Male'
      ELSE 'n/a' END AS gender
  FROM erp_cust_az12""",
    "silver_erp_locations": """
  SELECT replace(trim(CID), '-', '') AS customer_number,
    CASE WHEN trim(CNTRY) = 'DE' THEN 'Germany' WHEN trim(CNTRY) IN ('US', 'USA') THEN 'United States'
      WHEN CNTRY IS NULL OR trim(CNTRY) = '' THEN 'n/a' ELSE trim(CNTRY) END AS country
  FROM erp_loc_a101""",
    "silver_erp_categories": """
  SELECT trim(ID) AS category_id, trim(CAT) AS category, trim(SUBCAT) AS subcategory,
    CASE upper(trim(MAINTENANCE)) WHEN 'YES' THEN TRUE WHEN 'NO' THEN FALSE END AS maintenance_flag
  FROM erp_px_cat_g1v2""",
    "gold_customers": """
  SELECT row_number() OVER (ORDER BY c.customer_id) AS customer_key, c.customer_id, c.customer_number,
    c.first_name, c.last_name, l.country, c.marital_status,
    CASE WHEN c.gender <> 'n/a' THEN c.gender ELSE coalesce(e.gender, 'n/a') END AS gender,
    e.birth_date AS birthdate, c.created_date AS create_date
  FROM silver_customers c
  LEFT JOIN silver_erp_customers e ON c.customer_number = e.customer_number
  LEFT JOIN silver_erp_locations l ON c.customer_number = l.customer_number""",
    "newest_products": """
  SELECT * FROM silver_products
  QUALIFY row_number() OVER (PARTITION BY product_number ORDER BY start_date DESC, product_id DESC) = 1""",
    "gold_products": """
  SELECT row_number() OVER (ORDER BY p.start_date, p.product_number) AS product_key, p.product_id,
    p.product_number, p.product_name, p.category_id, k.category, k.subcategory, k.maintenance_flag,
    p.product_line, p.start_date
  FROM newest_products p LEFT JOIN silver_erp_categories k ON p.category_id = k.category_id""",
    "gold_sales": """
  SELECT s.order_number, p.product_key, c.customer_key, s.order_date, s.ship_date, s.due_date,
    s.sales_amount, s.quantity, s.price
  FROM silver_sales s
  LEFT JOIN gold_products p ON s.product_number = p.product_number
  LEFT JOIN gold_customers c ON s.customer_id = c.customer_id""",
}


def with_layers(select: str) -> str:
    """The statement with all bronze, silver and gold tables defined before it."""
    names = {**{n: _bronze_sql(n) for n in SHAPES}, **LAYERS}
    # DuckDB has substring(text, from, length) too; only the type name differs.
    parts = [f"{n} AS ({body.replace(' AS string)', ' AS varchar)')})" for n, body in names.items()]
    return "WITH " + ",\n".join(parts) + "\n" + select
