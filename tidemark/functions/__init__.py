"""Column expressions (built-in Spark functions only; no Python UDFs)."""

from tidemark.functions.cleaning import (
    blank_to_null, blank_to_null_sql, clean_discount_code, clean_discount_code_sql, date_parts,
    date_parts_sql, fill_region, fill_region_sql, parse_flag, parse_flag_sql, region_of,
    region_of_sql, typed, typed_sql,
)
from tidemark.functions.metrics import (
    count_when, exact_avg, pct, rounded_ratio,
)

__all__ = [
    "blank_to_null", "clean_discount_code", "date_parts", "fill_region", "parse_flag",
    "region_of", "typed", "blank_to_null_sql", "clean_discount_code_sql", "date_parts_sql",
    "fill_region_sql", "parse_flag_sql", "region_of_sql", "typed_sql",
    "count_when", "exact_avg", "pct", "rounded_ratio",
]
