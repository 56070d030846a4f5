"""Every model on random dirty raw tables equals the literal-form SQL oracle.

Raw events, products and customers are generated as text (padded and blank
values, odd flag spellings, 'N/A' codes, null and hot customers, unknown
products, merged add-on names), given to Spark and to DuckDB as the raw
tables, and every registered key that does not write files is compared.
"""

import datetime as dt
import os
import random
from collections import Counter

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.oracle_check import _norm
from tidemark.plans.build import Models
from tidemark.plans.catalog import OVER_MODELS, THRESHOLD, WRITING
from tidemark.plans.oracle import oracle_over_raw
from tidemark.schemas import RAW_SCHEMAS

KEYS = [k for k in OVER_MODELS if k not in WRITING or k.startswith(("bm_", "dq_violations"))]
SQL = oracle_over_raw()

COUNTRIES = ["United States", "Canada", " Canada ", "Germany", "Japan", "Brazil", "Spain", None]
REGIONS = ["", "  ", None, "EU", " EU ", "AMER"]
CHANNELS = ["Website", " Website ", "Partner", "Reseller", "Marketplace", "Direct Sales", None]
CODES = ["N/A", "n/a", "", None, " N/A ", "  ", " WELCOME10 ", "BFCM20", "STUDENT15"]
FLAGS = [" TRUE", "true", "False ", "maybe", None, "FALSE"]
CATEGORIES = ["Add-on", " Add-on ", "Analytics", "Design", "Add-ons"]
CYCLES = ["Monthly", "Annual", " Annual", "One-time"]


def _money(rng, scale=4, top=100000):
    return f"{rng.randint(0, top * 10 ** scale) / 10 ** scale:.{scale}f}"


def _ts(rng):
    base = dt.datetime(2024, 12, 30) + dt.timedelta(days=rng.randint(0, 70), hours=rng.choice([0, 1, 23]))
    return base.strftime("%Y-%m-%d %H:%M:%S")


def make_raw(seed: int, n_events: int):
    rng = random.Random(seed)
    products = [f"P{i}" for i in range(6)]
    customers = ["HOT"] + [f"C{i}" for i in range(8)]
    ev = []
    for i in range(n_events):
        cust = rng.choice(["HOT"] * 4 + customers + [None])
        ev.append({
            "event_id": f"E{i}", "event_type": rng.choice(["order", "order", "order", "invoice"]),
            "customer_id": cust, "product_id": rng.choice(products + ["GHOST", None]),
            "event_date": _ts(rng), "refund_datetime": rng.choice(["", _ts(rng)]),
            "country": rng.choice(COUNTRIES), "latitude": "1.5000", "longitude": "-2.2500",
            "region": rng.choice(REGIONS), "channel": rng.choice(CHANNELS),
            "payment_method": rng.choice([" Card ", "PayPal", None]), "currency": rng.choice(["EUR", " USD"]),
            "quantity": str(rng.randint(1, 5)), "unit_price_local": _money(rng, 2),
            "net_revenue_local": _money(rng), "discount_local": _money(rng, 4, 500),
            "tax_local": _money(rng, 4, 100), "fx_rate_to_usd": _money(rng, 6, 2),
            "net_revenue_usd": _money(rng), "discount_code": rng.choice(CODES),
            "is_refunded": rng.choice(FLAGS), "refund_reason": rng.choice(["", "  ", " Late ", None]),
        })
    ev.append({c: None for c in RAW_SCHEMAS["events"].fieldNames()})  # padding row
    pr = [{"product_id": p, "product_name": f" name {p} ", "category": rng.choice(CATEGORIES),
           "is_subscription": rng.choice(FLAGS), "billing_cycle": rng.choice(CYCLES),
           "base_price_usd": _money(rng, 2, 900), "first_release_date": "2024-02-01 00:00:00",
           "vendor": "V", "resale_model": "Direct resale",
           "brand_safe_name": rng.choice(["Boost", "Boost", f"B{p}"]),
           "product_name_orig": p, "base_price_usd_orig": "1.00", "base_key": p.lower(),
           "product_version": "v1"} for p in products[:-1]]  # the last product is never listed
    cu = [{"customer_id": c, "signup_date": "2023-05-01 00:00:00", "country": rng.choice(COUNTRIES),
           "country_latitude": "1.0000", "country_longitude": "2.0000", "region": rng.choice(REGIONS),
           "segment": rng.choice([" SMB", "Consumer", None]), "age_band": rng.choice(["25–34", "55+"]),
           "acquisition_channel": rng.choice(["Organic", "Email"]), "currency_preference": "EUR"}
          for c in customers if c != "C7"]  # C7 orders without a profile
    return {"events": ev, "products": pr, "customers": cu}


def _duck(raw):
    con = duckdb.connect()
    for name, rows in raw.items():
        cols = RAW_SCHEMAS[name].fieldNames()
        con.execute(f"CREATE TABLE raw_{name} ({', '.join(f'{c} VARCHAR' for c in cols)})")
        if rows:
            con.executemany(f"INSERT INTO raw_{name} VALUES ({', '.join('?' for _ in cols)})",
                            [[r.get(c) for c in cols] for r in rows])
    return con


def _spark_raw(spark, raw):
    return {name: spark.createDataFrame([tuple(r.get(c) for c in RAW_SCHEMAS[name].fieldNames())
                                         for r in rows], RAW_SCHEMAS[name])
            for name, rows in raw.items()}


@settings(max_examples=int(os.environ.get("TIDEMARK_EXAMPLES", "3")), deadline=None)
@given(st.integers(0, 10_000), st.integers(20, 140))
def test_all_models_match_sql_on_random_raw(spark, seed, n_events):
    raw = make_raw(seed, n_events)
    con = _duck(raw)
    m = Models(_spark_raw(spark, raw), THRESHOLD)
    for key in KEYS:
        df = OVER_MODELS[key](m)
        got = Counter(tuple(_norm(v) for _, v in sorted(r.asDict().items())) for r in df.collect())
        rel = con.execute(SQL[key])
        cols = [d[0] for d in rel.description]
        order = sorted(range(len(cols)), key=lambda i: cols[i])
        want = Counter(tuple(_norm(r[i]) for i in order) for r in rel.fetchall())
        assert sorted(df.columns) == sorted(cols), key
        assert got == want, (key, seed, n_events, list((got - want).elements())[:2],
                             list((want - got).elements())[:2])


def test_csv_roundtrip_does_not_change_any_model(spark, scratch):
    """A CSV export turns '' into null on reading; staging treats both as
    missing, so every model over the CSV-loaded raw tables is unchanged."""
    from tidemark.plans.build import MARTS, REPORTS
    from tidemark.sources.raw import read_raw, write_csv
    raw = _spark_raw(spark, make_raw(7, 120))
    csv = {}
    for name, df in raw.items():
        path = f"{scratch}/{name}"
        write_csv(df, path)
        csv[name] = read_raw(spark, name, path, "csv")
    direct, loaded = Models(raw, THRESHOLD), Models(csv, THRESHOLD)
    for key in MARTS + REPORTS + ("int_customer_orders", "int_product_performance"):
        a = direct.model(key) if key in MARTS or key.startswith("int_") else direct.report(key)
        b = loaded.model(key) if key in MARTS or key.startswith("int_") else loaded.report(key)
        assert sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr), key
