"""Queries for the single cleaning functions, on dirt derived from the given tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from .. import functions as fn
from ..operators import lookup
from ..operators import require_not_null as keep_known
from .registry import query, table

_FIXED_DAY = dt.date(1998, 8, 2)


@query("SELECT c_custkey, c_name, c_mktsegment FROM customer")
def trim_strings(spark, folder):
    padded = table(spark, folder, "customer").selectExpr(
        "c_custkey", "concat('  ', c_name, ' ') AS c_name", "concat(' ', c_mktsegment, '   ') AS c_mktsegment"
    )
    return fn.trim_strings(padded)


@query(
    """SELECT c_custkey, concat('AW', CAST(c_custkey AS varchar)) AS plain_number,
    replace(c_name, '#', '') AS name,
    CASE WHEN c_custkey % 2 = 0 THEN concat('AW', CAST(c_custkey AS varchar))
      ELSE concat('AW-NAS', CAST(c_custkey AS varchar)) END AS stripped_number
  FROM customer"""
)
def clean_keys(spark, folder):
    """Regex on named columns, and a prefix that goes only where it stands first."""
    raw = table(spark, folder, "customer").selectExpr(
        "c_custkey",
        "concat(' A-W', CAST(c_custkey AS string), '- ') AS plain_number",
        "c_name AS name",
        "concat(CASE WHEN c_custkey % 2 = 0 THEN 'NASAW' ELSE 'AW-NAS' END, CAST(c_custkey AS string))"
        " AS stripped_number",
    )
    cleaned = fn.clean_keys(fn.clean_keys(raw, ["plain_number"], "-"), ["name"], "#")
    return cleaned.withColumn("stripped_number", fn.strip_prefix(F.col("stripped_number"), "NAS"))


@query(
    """SELECT c_custkey, regexp_replace(trim(concat(' NAS', c_name)), '^NAS', '') AS c_name,
    regexp_replace(c_mktsegment, '^NAS', '') AS c_mktsegment FROM customer"""
)
def clean_all_strings(spark, folder):
    """Key clean-up on every string column of the schema."""
    raw = table(spark, folder, "customer").selectExpr(
        "c_custkey", "concat(' NAS', c_name) AS c_name", "concat(c_mktsegment, ' ') AS c_mktsegment"
    )
    return fn.clean_keys(raw, pattern="^NAS")


@query(
    """SELECT p_partkey AS product_id, p_name AS product_name, p_brand AS brand, p_type AS category, p_size,
    p_retailprice AS price FROM part"""
)
def rename_columns(spark, folder):
    names = {
        "P_PARTKEY": "product_id", "p_name": "product_name", "p_brand": "brand", "p_type": "category",
        "p_retailprice": "price", "p_unknown": "ignored",
    }
    return fn.rename_columns(table(spark, folder, "part"), names)


@query("SELECT c_custkey AS customer_id, c_name FROM customer WHERE c_custkey % 7 <> 0")
def require_not_null(spark, folder):
    raw = table(spark, folder, "customer").selectExpr(
        "CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_custkey END AS customer_id", "c_name"
    )
    return keep_known(raw, ["customer_id"])


@query(
    """SELECT c_custkey,
    CASE c_custkey % 4 WHEN 0 THEN 'Single' WHEN 1 THEN 'Married' ELSE 'n/a' END AS marital_status,
    CASE c_custkey % 4 WHEN 0 THEN 'Single' ELSE 'n/a' END AS strict_status
  FROM customer"""
)
def map_codes(spark, folder):
    raw = table(spark, folder, "customer").selectExpr(
        "c_custkey", "CASE c_custkey % 4 WHEN 0 THEN 'S' WHEN 1 THEN 'm' WHEN 2 THEN '' END AS code"
    )
    labels = {"S": "Single", "M": "Married"}
    return raw.select(
        "c_custkey",
        fn.map_codes(F.col("code"), labels).alias("marital_status"),
        fn.map_codes(F.col("code"), labels, ignore_case=False).alias("strict_status"),
    )


@query(
    """SELECT c_custkey, CASE c_custkey % 6 WHEN 0 THEN 'Germany' WHEN 1 THEN 'United States'
    WHEN 2 THEN 'United States' WHEN 3 THEN 'n/a' WHEN 4 THEN 'n/a' ELSE n_name END AS country
  FROM customer JOIN nation ON c_nationkey = n_nationkey"""
)
def map_country(spark, folder):
    """Known codes become names, blanks and NULL the missing label, other values stay."""
    named = lookup(
        table(spark, folder, "customer"), table(spark, folder, "nation"), {"c_nationkey": "n_nationkey"}, ["n_name"],
        how="inner",
    )
    raw = named.selectExpr(
        "c_custkey",
        "CASE c_custkey % 6 WHEN 0 THEN 'DE' WHEN 1 THEN 'US' WHEN 2 THEN 'USA' WHEN 3 THEN '' WHEN 4 THEN NULL"
        " ELSE n_name END AS code",
    )
    names = {"DE": "Germany", "US": "United States", "USA": "United States"}
    country = fn.map_codes(F.col("code"), names, passthrough=True, ignore_case=False)
    return raw.select("c_custkey", country.alias("country"))


@query("SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN TRUE WHEN 1 THEN FALSE END AS maintenance FROM part")
def yes_no_flag(spark, folder):
    raw = table(spark, folder, "part").selectExpr(
        "p_partkey", "CASE p_partkey % 4 WHEN 0 THEN 'Yes' WHEN 1 THEN 'no' WHEN 2 THEN '?' END AS answer"
    )
    return raw.select("p_partkey", fn.yes_no_flag(F.col("answer")).alias("maintenance"))


@query(
    """WITH keys AS (SELECT p_partkey, concat('CO-RF-FR', CAST(p_partkey AS varchar), '-58') AS k FROM part)
  SELECT p_partkey, 'CO_RF' AS category_id, concat('FR', CAST(p_partkey AS varchar), '-58') AS product_number,
    'CO' AS first_segment, substr(k, 4) AS rest, 'RF' AS middle_segment, '' AS no_middle
  FROM keys"""
)
def product_key_parse(spark, folder):
    key = F.concat(F.lit("CO-RF-FR"), F.col("p_partkey").cast("string"), F.lit("-58"))
    return table(spark, folder, "part").select(
        "p_partkey",
        fn.category_id(key).alias("category_id"),
        fn.product_number(key).alias("product_number"),
        fn.first_segment(key).alias("first_segment"),
        fn.drop_first_segment(key).alias("rest"),
        fn.middle_segment(key).alias("middle_segment"),
        fn.middle_segment(F.col("p_type")).alias("no_middle"),
    )


@query(
    """SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN 0 ELSE p_size END AS size,
    CAST(CASE WHEN p_partkey % 3 = 0 THEN 0 ELSE p_retailprice END AS decimal(10, 2)) AS cost,
    CAST(CASE WHEN p_partkey % 4 = 0 THEN 0 ELSE p_size END AS int) AS quantity,
    CASE WHEN p_partkey % 6 = 0 THEN 'n/a' ELSE p_brand END AS brand
  FROM part"""
)
def numeric_defaults(spark, folder):
    """Defaults for NULL, and safe casts of text that is no number."""
    raw = table(spark, folder, "part").selectExpr(
        "p_partkey",
        "CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_size END AS size",
        "CASE WHEN p_partkey % 3 = 0 THEN 'unknown' ELSE CAST(p_retailprice AS string) END AS cost",
        "CASE p_partkey % 8 WHEN 0 THEN 'many' WHEN 4 THEN NULL ELSE CAST(p_size AS string) END AS quantity",
        "CASE WHEN p_partkey % 6 = 0 THEN NULL ELSE p_brand END AS brand",
    )
    return raw.select(
        "p_partkey",
        fn.default_to(F.col("size"), 0).alias("size"),
        fn.to_money(F.col("cost")).alias("cost"),
        fn.to_int(F.col("quantity")).alias("quantity"),
        fn.default_to(F.col("brand"), "n/a").alias("brand"),
    )


@query(
    """SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_name WHEN c_custkey % 5 = 0 THEN 'n/a' ELSE c_mktsegment END
    AS always, CASE WHEN c_custkey % 3 = 0 THEN c_name WHEN c_custkey % 5 = 0 THEN NULL ELSE c_mktsegment END AS maybe
  FROM customer"""
)
def prefer_source(spark, folder):
    raw = table(spark, folder, "customer").selectExpr(
        "c_custkey",
        "CASE c_custkey % 3 WHEN 0 THEN c_name WHEN 1 THEN 'n/a' END AS first",
        "CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_mktsegment END AS second",
    )
    first, second = F.col("first"), F.col("second")
    return raw.select(
        "c_custkey",
        fn.prefer(first, second, "n/a", "n/a").alias("always"),
        fn.prefer(first, second, "n/a").alias("maybe"),
    )


@query(
    """SELECT o_orderkey, CASE WHEN CAST(o_orderdate AS date) > DATE '1998-08-02' THEN NULL
    ELSE CAST(o_orderdate AS date) END AS order_date FROM orders"""
)
def future_date_null(spark, folder):
    day = F.col("o_orderdate").cast("date")
    return table(spark, folder, "orders").select(
        "o_orderkey", fn.future_to_null(day, _FIXED_DAY).alias("order_date")
    )


_DAY_NUMBER = "year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate)"


@query(
    """SELECT o_orderkey,
    CASE WHEN o_orderkey % 11 IN (0, 1, 2, 3) THEN NULL ELSE CAST(o_orderdate AS date) END AS from_number,
    CASE WHEN o_orderkey % 11 IN (0, 1, 2, 3) THEN NULL ELSE CAST(o_orderdate AS date) END AS from_text
  FROM orders"""
)
def parse_yyyymmdd(spark, folder):
    """Numbers and text, with zero, short, impossible and missing dates; text may be ISO too."""
    raw = table(spark, folder, "orders").selectExpr(
        "o_orderkey",
        "CASE o_orderkey % 11 WHEN 0 THEN 0 WHEN 1 THEN 32154 WHEN 2 THEN 20101340 WHEN 3 THEN NULL"
        f" ELSE CAST({_DAY_NUMBER} AS int) END AS number",
        "CASE o_orderkey % 11 WHEN 0 THEN '0' WHEN 1 THEN '' WHEN 2 THEN '20101340' WHEN 3 THEN NULL"
        " WHEN 4 THEN CAST(CAST(o_orderdate AS date) AS string)"
        f" ELSE CAST({_DAY_NUMBER} AS string) END AS text",
    )
    return raw.select(
        "o_orderkey",
        fn.parse_yyyymmdd(F.col("number")).alias("from_number"),
        fn.lenient_date(F.col("text")).alias("from_text"),
    )


@query(
    """SELECT c_custkey, concat('CUSTOMER#', CAST(c_custkey AS varchar)) AS upper_id,
    lower(c_mktsegment) AS segment, CAST(c_custkey AS varchar) AS text_id FROM customer"""
)
def normalize_ids(spark, folder):
    raw = table(spark, folder, "customer").selectExpr(
        "c_custkey", "concat(' customer#', CAST(c_custkey AS string), ' ') AS id", "c_mktsegment"
    )
    return raw.select(
        "c_custkey",
        fn.normalize_id(F.col("id")).alias("upper_id"),
        F.lower(F.trim("c_mktsegment")).alias("segment"),
        fn.normalize_id(F.col("c_custkey")).alias("text_id"),
    )


@query(
    """SELECT l_orderkey, l_linenumber,
    CAST(CAST(l_quantity AS int) * CAST(floor(l_extendedprice / l_quantity * 100) / 100 AS decimal(10, 2))
      AS decimal(21, 2)) AS revenue FROM lineitem"""
)
def fact_revenue(spark, folder):
    priced = table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_quantity").cast("int").alias("quantity"),
        (F.floor(F.col("l_extendedprice") / F.col("l_quantity") * 100) / 100).cast("decimal(10,2)").alias("price"),
    )
    amount = fn.revenue(F.col("quantity"), F.col("price")).cast("decimal(21,2)")
    return priced.select("l_orderkey", "l_linenumber", amount.alias("revenue"))


@query(
    """SELECT p_partkey, CAST(p_partkey AS varchar) AS text_key, CAST(p_retailprice AS decimal(10, 2)) AS money,
    CAST(p_size > 25 AS int) AS large, CASE WHEN p_size % 4 = 1 THEN 0 ELSE p_size END AS whole,
    CAST(CASE WHEN p_size % 3 = 2 THEN 0 ELSE p_size END AS decimal(10, 2)) AS price FROM part"""
)
def casts(spark, folder):
    """Numbers from text that is not always one, and casts between types."""
    size = F.col("p_size")
    shown = F.when(size % 4 == 1, "none").otherwise(size.cast("string"))
    priced = F.when(size % 3 == 2, F.lit("n/a")).otherwise(F.concat(size, F.lit(".00")))
    return table(spark, folder, "part").select(
        "p_partkey",
        F.col("p_partkey").cast("string").alias("text_key"),
        fn.to_money(F.col("p_retailprice")).alias("money"),
        (size > 25).cast("int").alias("large"),
        fn.to_int(shown).alias("whole"),
        fn.to_money(priced).alias("price"),
    )
