"""Builders for hand-written raw rows (all text, like the raw files)."""

from __future__ import annotations

from tidemark.schemas import RAW_SCHEMAS

EVENT_DEFAULTS = {
    "event_type": "order", "event_date": "2025-01-01 10:00:00", "refund_datetime": "",
    "country": "Germany", "latitude": "51.0000", "longitude": "10.0000", "region": "EU",
    "channel": "Website", "payment_method": "Card", "currency": "EUR", "quantity": "1",
    "unit_price_local": "100.0000", "net_revenue_local": "100.0000", "discount_local": "0.0000",
    "tax_local": "0.0000", "fx_rate_to_usd": "1.000000", "net_revenue_usd": "100.0000",
    "discount_code": "N/A", "is_refunded": "false", "refund_reason": "",
}

PRODUCT_DEFAULTS = {
    "product_name": "Thing", "category": "Analytics", "is_subscription": "True",
    "billing_cycle": "Monthly", "base_price_usd": "10.0", "first_release_date": "2024-01-01 00:00:00",
    "vendor": "V", "resale_model": "Direct resale", "brand_safe_name": None,
    "product_name_orig": "Thing", "base_price_usd_orig": "10.0", "base_key": "thing",
    "product_version": "v1.0",
}

CUSTOMER_DEFAULTS = {
    "signup_date": "2024-01-01 00:00:00", "country": "Germany", "country_latitude": "51.0000",
    "country_longitude": "10.0000", "region": "EU", "segment": "Consumer", "age_band": "25–34",
    "acquisition_channel": "Organic", "currency_preference": "EUR",
}

_counter = {"n": 0}


def _rows(name, rows, defaults, key):
    cols = RAW_SCHEMAS[name].fieldNames()
    out = []
    for r in rows:
        full = dict(defaults)
        if key not in r:
            _counter["n"] += 1
            full[key] = f"{key[:1].upper()}{_counter['n']}"
        full.update(r)
        if name == "products" and full.get("brand_safe_name") is None:
            full["brand_safe_name"] = full["product_id"]
        out.append(tuple(full.get(c) for c in cols))
    return out


def events(spark, rows):
    return spark.createDataFrame(_rows("events", rows, EVENT_DEFAULTS, "event_id"),
                                 RAW_SCHEMAS["events"])


def products(spark, rows):
    return spark.createDataFrame(_rows("products", rows, PRODUCT_DEFAULTS, "product_id"),
                                 RAW_SCHEMAS["products"])


def customers(spark, rows):
    return spark.createDataFrame(_rows("customers", rows, CUSTOMER_DEFAULTS, "customer_id"),
                                 RAW_SCHEMAS["customers"])


def orders_for(customer, n, **extra):
    return [dict({"customer_id": customer}, **extra) for _ in range(n)]
