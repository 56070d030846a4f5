"""Staging models (silver): typed, cleaned views of the raw tables.

Filter columns (event_id, event_type, product_id, customer_id) pass through
unmodified, so predicates on them reach the Parquet scan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.cleaning import (
    ADDON_CATEGORY, blank_to_null_sql, clean_discount_code_sql, date_parts_sql, fill_region_sql,
    parse_flag_sql, typed_sql, unparsable_sql,
)
from tidemark.schemas import RAW_KEYS

MONEY4 = "decimal(12,4)"
FX6 = "decimal(10,6)"
GEO4 = "decimal(10,4)"
TS = "timestamp_ntz"

# Raw columns that are typed, per raw table; every other column stays text.
TYPES = {
    "events": {
        "event_date": TS, "refund_datetime": TS, "latitude": GEO4, "longitude": GEO4,
        "quantity": "int", "unit_price_local": MONEY4, "net_revenue_local": MONEY4,
        "discount_local": MONEY4, "tax_local": MONEY4, "fx_rate_to_usd": FX6,
        "net_revenue_usd": MONEY4,
    },
    "products": {"base_price_usd": MONEY4, "base_price_usd_orig": MONEY4,
                 "first_release_date": TS},
    "customers": {"signup_date": TS, "country_latitude": GEO4, "country_longitude": GEO4},
}


def _columns(name: str, lenient: bool) -> list[tuple[str, str]]:
    """(column, SQL over the raw table) of a staged table, without derived ones."""
    def typed(c):
        return typed_sql(c, TYPES[name][c], lenient)

    if name == "events":
        return [
            *[(c, c) for c in ("event_id", "event_type", "customer_id", "product_id")],
            *[(c, typed(c)) for c in ("event_date", "refund_datetime")],
            ("country", "country"),
            *[(c, typed(c)) for c in ("latitude", "longitude")],
            ("region", fill_region_sql("country", "region", trim_values=False)),
            *[(c, f"trim({c})") for c in ("channel", "payment_method", "currency")],
            *[(c, typed(c)) for c in ("quantity", "unit_price_local", "net_revenue_local",
                                      "discount_local", "tax_local", "fx_rate_to_usd",
                                      "net_revenue_usd")],
            ("discount_code", clean_discount_code_sql("discount_code")),
            ("is_refunded", parse_flag_sql("is_refunded")),
            ("refund_reason", blank_to_null_sql("refund_reason")),
        ]
    if name == "products":
        return [
            ("product_id", "product_id"),
            *[(c, f"trim({c})") for c in ("product_name", "brand_safe_name", "product_name_orig",
                                          "base_key", "product_version", "category", "vendor",
                                          "resale_model", "billing_cycle")],
            ("is_subscription", parse_flag_sql("is_subscription")),
            ("is_addon", f"coalesce(trim(category) = '{ADDON_CATEGORY}', false)"),
            *[(c, typed(c)) for c in ("base_price_usd", "base_price_usd_orig")],
            ("first_release_date", f"CAST({typed('first_release_date')} AS date)"),
        ]
    return [
        ("customer_id", "customer_id"),
        ("signup_date", typed("signup_date")),
        ("country", "trim(country)"),
        *[(c, typed(c)) for c in ("country_latitude", "country_longitude")],
        ("region", fill_region_sql("country", "region", trim_values=True)),
        *[(c, f"trim({c})") for c in ("segment", "age_band", "acquisition_channel",
                                      "currency_preference")],
    ]


def _aliased(columns: list[tuple[str, str]]) -> list[str]:
    return [sql if sql == name else f"{sql} AS {name}" for name, sql in columns]


def _staged(raw: DataFrame, name: str, lenient: bool) -> DataFrame:
    """Rows with a key, typed and cleaned in one projection."""
    return raw.where(f"{RAW_KEYS[name]} IS NOT NULL").selectExpr(*_aliased(_columns(name, lenient)))


def stg_events(raw: DataFrame, lenient: bool = False) -> DataFrame:
    """One typed event per raw row with a key; 27 columns.

    The date parts are derived from the typed event_date in a second
    projection, so the text is parsed once per row, not once per part. Text
    that cannot be cast raises; with ``lenient`` it becomes null, and
    ``rejects`` lists it.
    """
    return _staged(raw, "events", lenient).selectExpr(
        "*", *[f"{sql} AS {name}" for name, sql in date_parts_sql("event_date").items()])


def stg_products(raw: DataFrame, lenient: bool = False) -> DataFrame:
    """One typed product per raw row with a key: trimmed text, parsed flags,
    the add-on flag derived from the category, prices and release date."""
    return _staged(raw, "products", lenient)


def stg_customers(raw: DataFrame, lenient: bool = False) -> DataFrame:
    """One typed customer profile per raw row with a key; country and region
    are trimmed, and a missing region is derived from the country."""
    return _staged(raw, "customers", lenient)


def staging_sql(name: str, source: str) -> str:
    """The strict staging model of a raw table as SQL text over ``source``, for views."""
    inner = f"SELECT {', '.join(_aliased(_columns(name, False)))} FROM {source} " \
            f"WHERE {RAW_KEYS[name]} IS NOT NULL"
    if name != "events":
        return inner
    parts = ", ".join(f"{sql} AS {c}" for c, sql in date_parts_sql("event_date").items())
    return f"SELECT *, {parts} FROM ({inner})"


def rejects(raw: dict[str, DataFrame]) -> DataFrame:
    """Cells of rows with a key whose text a lenient build turns into null:
    (model, row_key, column_name, raw_text, wanted_type). One scan per table,
    no shuffle; a table without bad text gives no row."""
    frames = []
    for name, types in TYPES.items():
        cells = ", ".join(
            f"IF({unparsable_sql(c, t)}, named_struct('column_name', '{c}', 'raw_text', `{c}`, "
            f"'wanted_type', '{t}'), NULL)" for c, t in types.items())
        key = RAW_KEYS[name]
        frames.append(raw[name].where(f"{key} IS NOT NULL").selectExpr(
            f"'stg_{name}' AS model", f"{key} AS row_key",
            f"inline(filter(array({cells}), x -> x IS NOT NULL))"))
    return reduce(lambda a, b: a.unionByName(b), frames)


def orders(events: DataFrame) -> DataFrame:
    """The only rows any metric reads: events of type exactly 'order'."""
    return events.where(F.col("event_type") == F.lit("order"))
