"""Intermediate, mart and report semantics on micro fixtures (FIXTURES.md §2)."""

import decimal

from tests import fixtures as fx
from tidemark.operators import extensions as E
from tidemark.operators import intermediate as I
from tidemark.operators import marts as M
from tidemark.operators import reports as R
from tidemark.operators import staging as S
from tidemark.plans.build import Models

D = decimal.Decimal


def _stg(spark, rows):
    return S.stg_events(fx.events(spark, rows))


def _co(spark, rows):
    return {r.customer_id: r for r in I.int_customer_orders(_stg(spark, rows)).collect()}


def test_day_boundary_and_second_purchase(spark):
    rows = [{"customer_id": "A", "event_date": "2025-01-01 23:00:00"},
            {"customer_id": "A", "event_date": "2025-01-02 01:00:00"},
            {"customer_id": "B", "event_date": "2025-01-05 00:00:00"},
            {"customer_id": "C", "event_date": "2025-03-01 12:00:00"},
            {"customer_id": "C", "event_date": "2025-03-01 12:00:00"},
            {"customer_id": "C", "event_date": "2025-04-01 12:00:00"}]
    co = _co(spark, rows)
    assert (co["A"].customer_lifespan_days, co["A"].days_to_second_purchase) == (1, 1)
    assert (co["B"].customer_lifespan_days, co["B"].days_to_second_purchase) == (0, None)
    assert co["C"].days_to_second_purchase == 0
    assert co["C"].customer_lifespan_days == 31


def test_customer_order_metrics_ignore_invoices(spark):
    rows = ([{"customer_id": "A", "net_revenue_usd": "10.0000", "is_refunded": "TRUE"},
             {"customer_id": "A", "net_revenue_usd": "20.0001"},
             {"customer_id": "A", "event_type": "invoice", "net_revenue_usd": "999.0000"}])
    a = _co(spark, rows)["A"]
    assert a.total_orders == 2 and a.total_refunds == 1
    assert a.total_revenue_usd == D("30.0001")
    assert a.avg_order_value_usd == D("15.0001")  # 15.00005 half-up at 4 dp


def test_primary_channel_is_alphabetical_max_and_mode_extension(spark):
    rows = ([{"customer_id": "A", "channel": "Website"}]
            + fx.orders_for("A", 3, channel="Direct Sales"))
    ev = _stg(spark, rows)
    assert _co(spark, rows)["A"].primary_channel == "Website"
    mode = E.ext_primary_channel_mode(ev).collect()[0]
    assert mode.most_frequent_channel == "Direct Sales"


def test_loyalty_edge_and_null_customer(spark):
    rows = (fx.orders_for("NINE", 9) + fx.orders_for("NINE", 5, event_type="invoice")
            + fx.orders_for("TEN", 10) + fx.orders_for("TEN", 5, event_type="invoice")
            + fx.orders_for(None, 10))
    ev = _stg(spark, rows)
    cust = fx.customers(spark, [{"customer_id": "NINE"}, {"customer_id": "TEN"},
                                {"customer_id": "NOORDERS"}])
    m = Models({"events": fx.events(spark, rows), "products": fx.products(spark, [{"product_id": "X"}]),
                "customers": cust}, threshold=10)
    loyal = {r.customer_id: r for r in m.int_loyal_customers.collect()}
    assert set(loyal) == {"NINE", "TEN", None}  # no-order customer absent
    assert not loyal["NINE"].is_loyal_customer and loyal["TEN"].is_loyal_customer
    assert loyal[None].is_loyal_customer and loyal[None].country is None
    # the null group is in the loyal mart but its orders count as not loyal
    assert None in {r.customer_id for r in m.mart_loyal_customers.collect()}
    ch = m.mart_channel_performance.collect()[0]
    assert (ch.total_orders, ch.unique_customers, ch.loyal_customers) == (29, 2, 1)
    assert ch.loyal_customer_pct == D("50.00")
    du = m.int_discount_usage.collect()[0]
    assert du.discount_code == "No Discount" and du.loyal_customer_orders == 10
    assert M.mart_sales_by_month(ev, 10).collect()[0].loyal_customers == 1


def test_unknown_customer_profile_is_null(spark):
    rows = fx.orders_for("GHOST", 2)
    m = Models({"events": fx.events(spark, rows), "products": fx.products(spark, [{"product_id": "X"}]),
                "customers": fx.customers(spark, [{"customer_id": "OTHER"}])})
    r = m.int_loyal_customers.collect()[0]
    assert r.customer_id == "GHOST" and r.segment is None and r.total_orders == 2


def test_orphan_and_unsold_products(spark):
    rows = [{"customer_id": "A", "product_id": "P1", "net_revenue_usd": "5.0000"},
            {"customer_id": "A", "product_id": "MISSING", "net_revenue_usd": "7.0000"}]
    ev = _stg(spark, rows)
    pr = S.stg_products(fx.products(spark, [{"product_id": "P1"}, {"product_id": "UNSOLD"}]))
    perf = {r.product_id: r for r in I.int_product_performance(ev, pr).collect()}
    assert perf["UNSOLD"].total_orders == 0 and perf["UNSOLD"].unique_customers == 0
    assert perf["UNSOLD"].total_revenue_usd is None and perf["UNSOLD"].avg_selling_price_usd is None
    assert perf["UNSOLD"].orders_website == 0
    assert perf["P1"].total_orders == 1
    billing = M.mart_billing_cycle_revenue(ev, pr, 10).collect()
    assert sum(r.total_orders for r in billing) == 1
    ch = M.mart_channel_performance(ev, 10).collect()[0]
    assert ch.total_orders == 2 and ch.total_revenue_usd == D("12.00")
    asp = M.mart_asp_by_country(ev).collect()[0]
    assert asp.total_orders == 2


def test_billing_loyalty_counts_orders_of_unknown_products(spark):
    rows = (fx.orders_for("A", 1, product_id="P1") + fx.orders_for("A", 9, product_id="MISSING"))
    ev = _stg(spark, rows)
    pr = S.stg_products(fx.products(spark, [{"product_id": "P1"}]))
    b = M.mart_billing_cycle_revenue(ev, pr, 10).collect()[0]
    assert (b.total_orders, b.unique_customers, b.loyal_customers) == (1, 1, 1)


def test_addon_attach_rate(spark):
    pr = S.stg_products(fx.products(spark, [
        {"product_id": "CORE", "category": "Analytics"},
        {"product_id": "ADD", "category": "Add-on", "brand_safe_name": "Boost"}]))
    rows = [{"customer_id": "A", "product_id": "CORE"}, {"customer_id": "B", "product_id": "CORE"},
            {"customer_id": "A", "product_id": "ADD"}, {"customer_id": "C", "product_id": "ADD"}]
    r = M.mart_addon_attach_rate(_stg(spark, rows), pr).collect()[0]
    # add-on-only buyer C is in the numerator, not in the denominator
    assert (r.addon_name, r.customers_with_addon, r.total_core_customers) == ("Boost", 2, 2)
    assert r.attach_rate_pct == D("100.00")
    only_addons = [{"customer_id": "A", "product_id": "ADD"}]
    r2 = M.mart_addon_attach_rate(_stg(spark, only_addons), pr).collect()[0]
    assert r2.total_core_customers == 0 and r2.attach_rate_pct is None


def test_billing_cycle_report_is_not_a_sum_of_rates(spark):
    pr = S.stg_products(fx.products(spark, [
        {"product_id": "P1", "billing_cycle": "Annual", "category": "X"},
        {"product_id": "P2", "billing_cycle": "Annual", "category": "Y"}]))
    rows = [{"customer_id": "A", "product_id": "P1", "is_refunded": "true"},
            {"customer_id": "A", "product_id": "P1"},
            {"customer_id": "B", "product_id": "P2", "is_refunded": "true"},
            {"customer_id": "B", "product_id": "P2"}]
    ev = _stg(spark, rows)
    per_cat = M.mart_billing_cycle_revenue(ev, pr, 10).collect()
    assert [r.refund_rate_pct for r in per_cat] == [D("50.00"), D("50.00")]
    total = R.rep_billing_cycle(ev, pr).collect()[0]
    assert total.refund_rate_pct == D("50.00") and total.unique_customers == 2


def test_big_totals_do_not_overflow(spark):
    rows = fx.orders_for("A", 300, net_revenue_usd="99999999.9999")
    ev = _stg(spark, rows)
    ch = M.mart_channel_performance(ev, 10).collect()[0]
    assert ch.total_revenue_usd == D("29999999999.9700")
    assert ch.total_revenue_usd > 10 ** 10


def test_rounding_half_up(spark):
    rows = [{"customer_id": "A", "net_revenue_usd": "0.0050"},
            {"customer_id": "A", "net_revenue_usd": "0.0100"}]
    ch = M.mart_channel_performance(_stg(spark, rows), 10).collect()[0]
    assert ch.avg_order_value_usd == D("0.01")  # 0.0075 -> 0.01
    assert ch.total_revenue_usd == D("0.02")  # 0.0150 -> 0.02


def test_reports_on_small_build(spark):
    rows = (fx.orders_for("A", 10, country="Germany", region="EU", net_revenue_usd="30.0000")
            + fx.orders_for("B", 1, country="Brazil", region="", net_revenue_usd="10.0000"))
    m = Models({"events": fx.events(spark, rows),
                "products": fx.products(spark, [{"product_id": "X"}]),
                "customers": fx.customers(spark, [{"customer_id": "A", "segment": " SMB "},
                                                  {"customer_id": "B"}])}, threshold=10)
    share = m.report("rep_loyal_share").collect()[0]
    assert (share.loyal_customers, share.ordering_customers, share.loyal_share_pct) == (1, 2, D("50.00"))
    regions = {r.region: r.revenue_share_pct for r in m.report("rep_region_revenue_share").collect()}
    assert regions == {"EU": D("96.77"), "LATAM": D("3.23")}
    seg = m.report("rep_loyal_by_segment").collect()
    assert [(r.segment, r.loyal_customers) for r in seg] == [("SMB", 1)]
    peak = m.report("rep_peak_month").collect()
    assert len(peak) == 1 and peak[0].order_month == "2025-01"
    ranks = m.report("rep_discount_rank").collect()
    assert ranks[0].rank_by_orders == 1
    share_rev = {r.order_month: r.loyal_revenue_pct for r in m.report("ext_loyal_revenue_share").collect()}
    assert share_rev == {"2025-01": D("96.77")}


def test_display_order_places_nulls_like_the_warehouse(spark):
    df = spark.createDataFrame([(1, None), (2, D("5.00")), (3, D("7.00"))],
                               "id int, total_revenue_usd decimal(22,2)")
    got = [r.id for r in M.display_order("mart_channel_performance", df).collect()]
    assert got == [1, 3, 2]  # descending: nulls first
    months = spark.createDataFrame([(2025, 2), (None, 1), (2024, 12), (2025, 1)],
                                   "order_year int, order_month_num int")
    got = [(r.order_year, r.order_month_num)
           for r in M.display_order("mart_sales_by_month", months).collect()]
    assert got == [(2024, 12), (2025, 1), (2025, 2), (None, 1)]  # ascending: nulls last
    assert M.display_order("not_a_model", df) is df


def test_left_join_skipping_null_keys(spark):
    from tidemark.operators.joins import left_join_skipping_null_keys
    left = spark.createDataFrame([(1, "a"), (2, None), (3, "z")], "id int, k string")
    right = spark.createDataFrame([("a", 10)], "k string, v int")
    got = sorted((r.id, r.k, r.v) for r in left_join_skipping_null_keys(left, right, "k", salt="id").collect())
    assert got == [(1, "a", 10), (2, None, None), (3, "z", None)]


def test_billing_keeps_orders_without_product_out_of_groups(spark):
    rows = fx.orders_for("A", 2, product_id="P1") + fx.orders_for("A", 9, product_id=None)
    pr = S.stg_products(fx.products(spark, [{"product_id": "P1"}]))
    b = M.mart_billing_cycle_revenue(_stg(spark, rows), pr, 10).collect()
    assert [(r.total_orders, r.loyal_customers) for r in b] == [(2, 1)]
