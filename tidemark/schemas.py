"""Declared raw schemas.

Raw files arrive as text (spreadsheet exports); every raw column is read as a
string and typed in staging, never by schema inference.
"""

from __future__ import annotations

from pyspark.sql.types import StringType, StructField, StructType

RAW_EVENTS_COLUMNS = (
    "event_id", "event_type", "customer_id", "product_id",
    "event_date", "refund_datetime",
    "country", "latitude", "longitude", "region",
    "channel", "payment_method", "currency",
    "quantity", "unit_price_local", "net_revenue_local", "discount_local", "tax_local",
    "fx_rate_to_usd", "net_revenue_usd",
    "discount_code", "is_refunded", "refund_reason",
)

# Column order of the shipped product catalogue file.
RAW_PRODUCTS_COLUMNS = (
    "product_id", "product_name", "category", "is_subscription", "billing_cycle",
    "base_price_usd", "first_release_date", "vendor", "resale_model", "brand_safe_name",
    "product_name_orig", "base_price_usd_orig", "base_key", "product_version",
)

RAW_CUSTOMERS_COLUMNS = (
    "customer_id", "signup_date", "country", "country_latitude", "country_longitude",
    "region", "segment", "age_band", "acquisition_channel", "currency_preference",
)

RAW_COLUMNS = {
    "events": RAW_EVENTS_COLUMNS,
    "products": RAW_PRODUCTS_COLUMNS,
    "customers": RAW_CUSTOMERS_COLUMNS,
}

# Business keys per raw table.
RAW_KEYS = {"events": "event_id", "products": "product_id", "customers": "customer_id"}


def all_string(columns) -> StructType:
    return StructType([StructField(c, StringType(), True) for c in columns])


RAW_SCHEMAS = {name: all_string(cols) for name, cols in RAW_COLUMNS.items()}
