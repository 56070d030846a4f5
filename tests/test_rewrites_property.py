"""The rewritten plans equal a brute-force reading of the literal model on
random data with a hot customer, a null customer, null channels and invoices."""

import datetime as dt
import decimal
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from tests import fixtures as fx
from tidemark.operators import intermediate as I
from tidemark.operators import marts as M
from tidemark.operators import staging as S

D = decimal.Decimal
CUSTOMERS = [None, "HOT", "B", "C", "D"]
CHANNELS = [None, "Website", "Partner", "Reseller"]
THRESHOLD = 3

row = st.fixed_dictionaries({
    "customer": st.sampled_from(CUSTOMERS + ["HOT"] * 4),
    "channel": st.sampled_from(CHANNELS),
    "event_type": st.sampled_from(["order", "order", "order", "invoice"]),
    "cents": st.integers(0, 100000),
    "refunded": st.booleans(),
    "day": st.integers(0, 5),
    "hour": st.sampled_from([0, 23]),
})


def _raw(rows):
    out = []
    for i, r in enumerate(rows):
        ts = dt.datetime(2025, 1, 1) + dt.timedelta(days=r["day"], hours=r["hour"])
        out.append({"event_id": f"E{i}", "customer_id": r["customer"], "channel": r["channel"],
                    "event_type": r["event_type"], "net_revenue_usd": f"{D(r['cents']) / 100:.4f}",
                    "is_refunded": "true" if r["refunded"] else "false",
                    "event_date": ts.strftime("%Y-%m-%d %H:%M:%S")})
    return out


def _half_up(x: D, places: int) -> D:
    return x.quantize(D(1).scaleb(-places), rounding=decimal.ROUND_HALF_UP)


def _expected_channel(rows):
    orders = [r for r in rows if r["event_type"] == "order"]
    totals = defaultdict(int)
    for r in orders:
        totals[r["customer"]] += 1
    loyal = {c for c, n in totals.items() if c is not None and n >= THRESHOLD}
    groups = defaultdict(list)
    for r in orders:
        groups[r["channel"]].append(r)
    out = {}
    for ch, rs in groups.items():
        custs = {r["customer"] for r in rs if r["customer"] is not None}
        loyal_c = custs & loyal
        rev = sum(D(r["cents"]) / 100 for r in rs)
        refunds = sum(1 for r in rs if r["refunded"])
        out[ch] = (len(rs), len(custs), len(loyal_c), _half_up(rev, 2),
                   _half_up(rev / len(rs), 2),
                   _half_up(D(100 * len(loyal_c)) / len(custs), 2) if custs else None,
                   refunds, _half_up(D(100 * refunds) / len(rs), 2))
    return out


def _expected_second(rows):
    dates = defaultdict(list)
    for r in rows:
        if r["event_type"] == "order" and r["customer"] is not None:
            dates[r["customer"]].append(dt.datetime(2025, 1, 1) + dt.timedelta(days=r["day"], hours=r["hour"]))
    out = {}
    for c, ds in dates.items():
        ds.sort()
        out[c] = (ds[1].date() - ds[0].date()).days if len(ds) > 1 else None
    return out


@settings(max_examples=6, deadline=None)
@given(st.lists(row, min_size=1, max_size=60))
def test_channel_mart_and_second_purchase_match_brute_force(spark, rows):
    ev = S.stg_events(fx.events(spark, _raw(rows)))
    got = {r.channel: (r.total_orders, r.unique_customers, r.loyal_customers, r.total_revenue_usd,
                       r.avg_order_value_usd, r.loyal_customer_pct, r.total_refunds, r.refund_rate_pct)
           for r in M.mart_channel_performance(ev, THRESHOLD).collect()}
    assert got == _expected_channel(rows)
    co = {r.customer_id: r.days_to_second_purchase for r in I.int_customer_orders(ev).collect()
          if r.customer_id is not None}
    assert co == _expected_second(rows)
