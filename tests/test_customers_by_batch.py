"""Customer models from mergeable partials, and kept up to date by batches."""

import os

import pytest

from tests import fixtures as fx
from tidemark.operators import intermediate as I
from tidemark.operators import staging as S
from tidemark.sources.raw import write_csv
from tidemark.sources.sinks import Layout
from tidemark.streaming import apply_batch, follow_events, refresh_customers
from tidemark.streaming.customers import merge_partials


def rows(n=120):
    channels = ("Website", "Partner", None, "Direct Sales", "Website")
    return [{"event_id": f"E{i}", "customer_id": None if i % 13 == 0 else f"C{i % 9}",
             "event_type": "invoice" if i % 11 == 0 else "order", "product_id": "P1",
             "channel": channels[(i * 7) % 5],
             "event_date": "" if i % 17 == 0 else f"2025-0{i % 6 + 1}-1{i % 3} 0{i % 10}:00:00",
             "net_revenue_usd": "" if i % 19 == 0 else f"{i}.2500",
             "is_refunded": str(i % 4 == 0)} for i in range(n)]


def found(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=str)


def plain(event_rows):
    """The customer summary by loops over the rows."""
    out = {}
    for r in event_rows:
        if r["event_type"] == "order":
            out.setdefault(r["customer_id"], []).append(r)
    result = {}
    for c, own in out.items():
        days = sorted((r["event_date"] or "9999")[:10] for r in own)
        usd = [float(r["net_revenue_usd"]) for r in own if r["net_revenue_usd"]]
        second = None
        if c is not None and len(days) > 1 and days[1] != "9999":
            import datetime as dt
            a, b = (dt.date.fromisoformat(d) for d in days[:2])
            second = (b - a).days
        counts = {}
        for r in own:
            if r["channel"]:
                counts[r["channel"]] = counts.get(r["channel"], 0) + 1
        result[c] = (len(own), sum(usd) if usd else None,
                     sum(r["is_refunded"] == "True" for r in own), max(counts, default=None), second,
                     min(counts, key=lambda k: (-counts[k], k), default=None))
    return result


def test_summary_and_modes_against_loops(spark):
    events = S.stg_events(fx.events(spark, rows()).repartition(5))
    modes = {r.customer_id: r for r in I.channel_modes(I.customer_partials(events)).collect()}
    got = {r.customer_id: (r.total_orders, None if r.total_revenue_usd is None
                           else float(r.total_revenue_usd), r.total_refunds, r.primary_channel,
                           r.days_to_second_purchase, modes[r.customer_id].most_frequent_channel)
           for r in I.int_customer_orders(events).collect()}
    assert got == plain(rows())


def test_merged_and_appended_partials_agree(spark):
    events = S.stg_events(fx.events(spark, rows()).repartition(4))
    whole = I.customer_partials(events)
    halves = [I.customer_partials(events.where(f"crc32(event_id) % 3 {x} 0")) for x in ("=", "<>")]
    appended = halves[0].unionByName(halves[1])
    assert found(I.merged_partials(appended)) == found(whole)
    want = found(I.customer_summary(whole))
    assert found(I.customer_summary(appended)) == want
    assert found(I.customer_summary(I.merged_partials(appended))) == want
    days = {(r.customer_id, r.channel, r.order_day) for r in whole.collect()}
    assert len(days) == whole.count()


def test_two_batches_equal_one_build_and_replays_change_nothing(spark, scratch):
    layout, landing = Layout(spark, os.path.join(scratch, "lake")), os.path.join(scratch, "in")
    every, profiles = rows(), S.stg_customers(fx.customers(spark, [{"customer_id": "C1"}]))
    for i in (0, 1):
        write_csv(fx.events(spark, every[i::2]), os.path.join(landing, f"b{i}"))
        follow_events(spark, os.path.join(landing, "*"), layout,
                      os.path.join(scratch, "ckpt")).awaitTermination(120)
    assert layout.release().settings == {"batch of events": 1}
    want = found(I.int_customer_orders(S.stg_events(fx.events(spark, every))))
    made = refresh_customers(layout, profiles, threshold=3)
    assert found(made["int_customer_orders"]) == want
    assert made["int_loyal_customers"].where("is_loyal_customer").count() > 0
    # a batch that is run again after it was published
    before = layout.release()
    again = fx.events(spark, every[1::2])
    assert apply_batch(layout, again, 1) is False and layout.release() == before
    # another stream has its own numbers
    more = [dict(r, event_id=f"N{i}") for i, r in enumerate(rows(40))]
    assert apply_batch(layout, fx.events(spark, more), 0, stream="late") is True
    want = found(I.int_customer_orders(S.stg_events(fx.events(spark, every + more))))
    assert found(refresh_customers(layout, profiles)["int_customer_orders"]) == want
    merge_partials(layout)
    assert len(layout.release().versions("silver", "customer_partials")) == 1
    assert found(refresh_customers(layout, profiles)["int_customer_orders"]) == want
    assert layout.read("bronze", "events").count() == len(every) + len(more)


def test_a_batch_that_fails_is_applied_by_its_next_run(spark, scratch):
    layout = Layout(spark, scratch)
    bad = fx.events(spark, [{"event_id": "E1", "net_revenue_usd": "much"}])
    with pytest.raises(Exception, match="CAST"):
        apply_batch(layout, bad, 0)
    assert layout.release().number == 0
    assert apply_batch(layout, bad, 0, lenient=True) is True
    assert layout.read("silver", "customer_partials").count() == 1
