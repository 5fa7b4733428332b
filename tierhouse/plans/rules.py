"""Data-quality rules by table.

Fixed values: rule names, actions and conditions.
"""

from ..operators.quality import dates_in_order, expect, expect_or_drop, expect_or_fail

CRM_CUSTOMERS = (
    expect("valid_customer_id", "customer_id IS NOT NULL"),
    expect_or_drop("customer_id_not_empty", "length(trim(customer_id)) > 0"),
    expect("valid_firstname", "firstname IS NOT NULL"),
)
ERP_CUSTOMERS = (
    expect("valid_customer_id", "customer_id IS NOT NULL"),
    expect_or_drop("customer_id_not_empty", "length(trim(customer_id)) > 0"),
    expect("valid_birthday", "birthday_date IS NULL OR birthday_date < current_date()"),
)
ERP_LOCATIONS = (
    expect("valid_customer_id", "customer_id IS NOT NULL"),
    expect("valid_country", "country IS NOT NULL AND length(trim(country)) > 0"),
)
ERP_PRODUCTS = (
    expect("valid_product_key", "product_key IS NOT NULL"),
    expect_or_drop("product_key_not_empty", "length(trim(product_key)) > 0"),
    expect("valid_category", "category IS NOT NULL"),
)
CRM_PRODUCTS = (
    expect("valid_product_key", "product_key IS NOT NULL"),
    expect_or_drop("product_key_not_empty", "length(trim(product_key)) > 0"),
    expect("valid_category", "category IS NOT NULL"),
)
SALES = (
    expect("valid_order_number", "sales_order_number IS NOT NULL"),
    expect_or_drop("valid_quantity", "sales_order_qty > 0"),
    expect_or_drop("valid_amount", "sales_amount >= 0"),
    expect("valid_order_date", "sales_order_date IS NOT NULL"),
    expect("valid_customer_product", "customer_id IS NOT NULL AND product_key IS NOT NULL"),
)
DIM_CUSTOMERS = (
    expect_or_fail("unique_customer_id", "customer_id IS NOT NULL"),
    expect("has_gender", "gender IS NOT NULL"),
)
DIM_PRODUCTS = (expect_or_fail("unique_product_key", "product_key IS NOT NULL"),)
FACT_SALES = (
    expect_or_drop("has_dimension_keys", "customer_key IS NOT NULL AND product_key_sk IS NOT NULL"),
    expect_or_fail("positive_revenue", "revenue >= 0"),
    expect("valid_dates_order", dates_in_order("sales_order_date", "sales_ship_date")),
)
