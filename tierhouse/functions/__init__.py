"""Column expressions and column-wise frame helpers (no Python UDFs)."""

from .amounts import (default_to, expected_amount, repair_amounts, repair_price, repair_sales, revenue,
                      to_int, to_money)
from .codes import map_codes, prefer, yes_no_flag
from .curves import bucket_of, interleave_bits
from .dates import future_to_null, lenient_date, parse_yyyymmdd
from .product_keys import category_id, drop_first_segment, first_segment, middle_segment, product_number
from .text import clean_keys, normalize_id, rename_columns, strip_prefix, trim_strings

__all__ = [
    "bucket_of", "category_id", "clean_keys", "default_to", "drop_first_segment", "expected_amount",
    "first_segment", "future_to_null", "interleave_bits", "lenient_date", "map_codes", "middle_segment",
    "normalize_id", "parse_yyyymmdd", "prefer", "product_number", "rename_columns", "repair_amounts",
    "repair_price", "repair_sales", "revenue", "strip_prefix", "to_int", "to_money",
    "trim_strings", "yes_no_flag",
]
