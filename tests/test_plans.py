
import os

import pytest

from tidemark.plans.catalog import QUERIES, WRITING
from tidemark.plans.inspect import (
    PAIR_NODES, PYTHON_NODES, columns_read, nodes, plan_text, read_schemas,
)

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")

PLANNABLE = [n for n in QUERIES if n not in WRITING]


@pytest.fixture(scope="module")
def plans(spark):
    return {n: nodes(QUERIES[n](spark, SF)) for n in PLANNABLE}


def test_no_python_udf_and_no_pair_joins(plans):
    for name, ns in plans.items():
        assert not set(ns) & set(PYTHON_NODES), name
        assert not set(ns) & set(PAIR_NODES), name


def test_two_level_marts_have_no_expand(plans):
    for name in ("mart_channel_performance", "mart_sales_by_month", "mart_billing_cycle_revenue",
                 "int_discount_usage", "ext_loyal_revenue_share"):
        assert "Expand" not in plans[name], name
        assert "Window" in plans[name], name


def test_second_purchase_limits_before_the_shuffle(spark):
    text = plan_text(QUERIES["op_days_to_second_purchase"](spark, SF))
    assert "WindowGroupLimit" in text and "Partial" in text
    partial = text.index("Partial")
    # the partial limit sits below (after, in the text) an exchange
    assert "Exchange" in text[:partial]


def test_customer_models_scan_orders_once_and_sort_no_order(spark):
    for name in ("int_customer_orders", "int_loyal_customers", "ext_primary_channel_mode"):
        df = QUERIES[name](spark, SF)
        assert sum("l_orderkey" in s for s in read_schemas(df)) == 1, name
        # top-down: what follows the last hash aggregate is at order grain
        ns = nodes(df)
        last = len(ns) - 1 - ns[::-1].index("HashAggregate")
        below = set(ns[last:])
        assert not below & {"SortAggregate", "ObjectHashAggregate", "Window"}, (name, ns)


# Columns that each mart reads of the driver's tables, exactly.
ORDER_KEYS = {"lineitem": {"l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"},
              "orders": {"o_orderkey", "o_custkey", "o_orderstatus"},
              "customer": {"c_custkey"}}
MONEY = {"l_extendedprice", "l_discount"}
PROFILE = {"c_custkey", "c_nationkey", "c_mktsegment"}
READS = {
    "mart_sales_by_month": {
        "lineitem": MONEY | {"l_returnflag"}, "orders": {"o_orderdate"},
        "customer": {"c_nationkey"}},
    "mart_channel_performance": {
        "lineitem": MONEY | {"l_returnflag"}, "orders": {"o_orderpriority"},
        "customer": {"c_nationkey"}},
    "mart_loyal_customers": {
        "lineitem": MONEY | {"l_returnflag"}, "orders": {"o_orderpriority", "o_orderdate"},
        "customer": PROFILE, "nation": {"n_nationkey"}},
    "mart_discount_analysis": {
        "lineitem": MONEY | {"l_returnflag"}, "customer": {"c_nationkey"}},
    "mart_asp_by_country": {
        "lineitem": MONEY, "customer": {"c_nationkey"}, "part": {"p_partkey", "p_retailprice"}},
    "mart_billing_cycle_revenue": {
        "lineitem": MONEY | {"l_returnflag"}, "customer": {"c_nationkey"},
        "part": {"p_partkey", "p_size", "p_type"}},
}


@pytest.mark.parametrize("name", sorted(READS))
def test_marts_read_exactly_their_columns(spark, name):
    want = {t: ORDER_KEYS.get(t, set()) | READS[name].get(t, set())
            for t in {*ORDER_KEYS, *READS[name]}}
    got = columns_read(QUERIES[name](spark, SF))
    assert {t.removesuffix(".parquet"): c for t, c in got.items()} == want


def test_attach_rate_reads_exactly_its_columns(spark):
    """Its orders are read once, before the small result is written down."""
    from tidemark.operators.marts import orders_with_products
    from tidemark.plans.catalog import models
    m = models(spark, SF)
    df = orders_with_products(m.stg_events, m.stg_products).select(
        "customer_id", "event_id", "net_revenue_usd", "brand_safe_name", "category", "is_addon")
    got = {t.removesuffix(".parquet"): c for t, c in columns_read(df).items()}
    assert got == {
        "lineitem": ORDER_KEYS["lineitem"] | MONEY, "orders": ORDER_KEYS["orders"],
        "customer": {"c_custkey", "c_nationkey"},
        "part": {"p_partkey", "p_name", "p_brand", "p_type"}}


def test_scan_reads_only_needed_columns(spark):
    schemas = read_schemas(QUERIES["mart_channel_performance"](spark, SF))
    lineitem = [s for s in schemas if "l_orderkey" in s]
    assert lineitem and all("l_tax" not in s and "l_quantity" not in s for s in lineitem)
    orders = [s for s in schemas if "o_orderkey" in s]
    assert orders and all("o_totalprice" not in s for s in orders)


def test_order_filter_reaches_the_orders_scan(spark):
    text = plan_text(QUERIES["mart_asp_by_country"](spark, SF))
    assert "o_orderstatus" in text.split("FileScan parquet [o_orderkey")[0].rsplit("Filter", 1)[1]


def test_attach_rate_uses_scalar_subquery_not_cross_join(spark):
    text = plan_text(QUERIES["mart_addon_attach_rate"](spark, SF))
    assert "Subquery" in text and "CartesianProduct" not in text


def test_hot_customer_is_split_in_the_order_level_join(spark):
    """One customer with half of the orders, no adaptive execution: the library
    itself deals its rows over the tasks."""
    from pyspark.sql import functions as F

    from tidemark.operators import intermediate as I
    from tidemark.operators.joins import hot_keys
    from tidemark.operators.staging import orders
    from tidemark.plans.catalog import models
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        m = models(spark, SF)
        events = m.stg_events.withColumn("customer_id", F.when(
            F.pmod(F.xxhash64("event_id"), F.lit(2)) == 0, "C-HOT").otherwise(F.col("customer_id")))
        o = orders(events)
        assert list(hot_keys(o, "customer_id", 0.05)) == ["C-HOT"]
        flags = I.loyalty_flags(I.int_customer_orders(events), 30)
        out = I.with_loyalty(o.select("event_id", "customer_id"), flags)
        rows = out.withColumn("part", F.spark_partition_id()).persist()
        total = o.count()
        per_part = [r["count"] for r in rows.groupBy("part").count().collect()]
        assert sum(per_part) == total and max(per_part) < total / 4
        want = {r.customer_id: r.is_loyal_customer for r in flags.collect()}
        for r in rows.select("customer_id", "is_loyal_customer").distinct().collect():
            assert r.is_loyal_customer == (r.customer_id is not None and want[r.customer_id])
        rows.unpersist()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_checkpointed_reports_do_not_rescan_orders(spark):
    # the orders pipeline ran once, inside the eager checkpoint; the returned
    # plans read only the small checkpointed tables
    for name in ("mart_addon_attach_rate", "rep_region_revenue_share", "rep_discount_rank"):
        assert "l_orderkey" not in plan_text(QUERIES[name](spark, SF)), name
