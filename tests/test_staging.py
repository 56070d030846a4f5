"""Staging rules on hand-computed micro fixtures (FIXTURES.md §2)."""

import datetime as dt
import decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql.utils import AnalysisException

from tests import fixtures as fx
from tidemark.operators import staging as S


def _by_id(df, col):
    return {r["event_id"]: r[col] for r in df.select("event_id", col).collect()}


def test_padding_rows_dropped(spark):
    raw = fx.events(spark, [{"event_id": "E1"}, {c: None for c in fx.EVENT_DEFAULTS} | {"event_id": None}])
    assert [r.event_id for r in S.stg_events(raw).collect()] == ["E1"]


def test_region_fill_events_keeps_untrimmed(spark):
    raw = fx.events(spark, [
        {"event_id": "a", "country": "United States", "region": ""},
        {"event_id": "b", "country": "Canada", "region": "  "},
        {"event_id": "c", "country": "Japan", "region": None},
        {"event_id": "d", "country": "Germany", "region": " EU "},
        {"event_id": "e", "country": " Canada ", "region": None},
    ])
    got = _by_id(S.stg_events(raw), "region")
    assert got == {"a": "AMER", "b": "AMER", "c": "Unknown", "d": " EU ", "e": "Unknown"}


def test_region_fill_customers_trims(spark):
    raw = fx.customers(spark, [
        {"customer_id": "a", "country": "Germany", "region": " EU "},
        {"customer_id": "b", "country": " Canada ", "region": None},
        {"customer_id": "c", "country": "Brazil", "region": ""},
    ])
    got = {r.customer_id: (r.region, r.country) for r in S.stg_customers(raw).collect()}
    assert got == {"a": ("EU", "Germany"), "b": ("AMER", "Canada"), "c": ("LATAM", "Brazil")}


def test_discount_code_cleaning(spark):
    codes = ["N/A", "n/a", "", None, " N/A ", "  ", " WELCOME10 "]
    raw = fx.events(spark, [{"event_id": str(i), "discount_code": c} for i, c in enumerate(codes)])
    got = _by_id(S.stg_events(raw), "discount_code")
    assert [got[str(i)] for i in range(len(codes))] == [None, None, None, None, "N/A", "", "WELCOME10"]


def test_flag_parsing(spark):
    flags = [" TRUE", "False ", "maybe", None, "true"]
    raw = fx.events(spark, [{"event_id": str(i), "is_refunded": f} for i, f in enumerate(flags)])
    got = _by_id(S.stg_events(raw), "is_refunded")
    assert [got[str(i)] for i in range(len(flags))] == [True, False, False, False, True]


def test_refund_reason_blank_to_null_and_blank_timestamp(spark):
    raw = fx.events(spark, [{"event_id": "a", "refund_reason": "  ", "refund_datetime": ""},
                            {"event_id": "b", "refund_reason": " Late ",
                             "refund_datetime": "2025-02-03 04:05:06"}])
    rows = {r.event_id: r for r in S.stg_events(raw).collect()}
    assert rows["a"].refund_reason is None and rows["a"].refund_datetime is None
    assert rows["b"].refund_reason == "Late"
    assert rows["b"].refund_datetime == dt.datetime(2025, 2, 3, 4, 5, 6)


def test_date_parts(spark):
    raw = fx.events(spark, [{"event_id": "a", "event_date": "2025-11-30 23:59:59"}])
    r = S.stg_events(raw).collect()[0]
    assert (r.order_month, r.order_year, r.order_month_num, r.order_quarter) == ("2025-11", 2025, 11, 4)


def test_typed_columns(spark):
    raw = fx.events(spark, [{"event_id": "a", "quantity": "3", "net_revenue_usd": "12.34565",
                             "fx_rate_to_usd": "0.0175", "channel": " Website "}])
    r = S.stg_events(raw).collect()[0]
    assert r.quantity == 3 and r.channel == "Website"
    assert r.net_revenue_usd == decimal.Decimal("12.3457")  # cast rounds half-up at 4 dp
    assert r.fx_rate_to_usd == decimal.Decimal("0.017500")
    assert len(S.stg_events(raw).columns) == 27


def test_strict_cast_fails_on_bad_text(spark):
    raw = fx.events(spark, [{"event_id": "a", "quantity": "3.0"}])
    with pytest.raises((PySparkException, AnalysisException, Exception)):
        S.stg_events(raw).collect()


def test_products(spark):
    raw = fx.products(spark, [
        {"product_id": "P1", "category": " Add-on ", "is_subscription": " TRUE ",
         "product_name": "  Name ", "first_release_date": "2023-11-24 00:00:00"},
        {"product_id": "P2", "category": "Add-ons", "is_subscription": "no"},
        {"product_id": None},
    ])
    rows = {r.product_id: r for r in S.stg_products(raw).collect()}
    assert set(rows) == {"P1", "P2"}
    assert rows["P1"].is_addon and not rows["P2"].is_addon
    assert rows["P1"].is_subscription and not rows["P2"].is_subscription
    assert rows["P1"].product_name == "Name"
    assert rows["P1"].first_release_date == dt.date(2023, 11, 24)
