"""Raw events are joined in narrow steps, and once by queries that read them more than once."""

import os
import re

import pytest
from pyspark.sql import functions as F

from tests import fixtures as fx
from tidemark.plans import build as B
from tidemark.plans import catalog as C
from tidemark.plans.build import Models
from tidemark.plans.inspect import plan_text
from tidemark.session import SESSION_DEFAULTS
from tidemark.sources import testdata as T


def _driver_tables(spark, folder):
    rows = {
        "lineitem": spark.sql(
            "SELECT id DIV 2 AS l_orderkey, id % 5 AS l_partkey, id AS l_suppkey, "
            "CAST(id % 2 AS int) AS l_linenumber, 3D AS l_quantity, 10D AS l_extendedprice, "
            "0.05D AS l_discount, 0.02D AS l_tax, 'R' AS l_returnflag, 'F' AS l_linestatus, "
            "TIMESTAMP_NTZ'2024-03-01 00:00:00' AS l_shipdate FROM range(20)"),
        "orders": spark.sql(
            "SELECT id AS o_orderkey, IF(id = 3, NULL, id % 4) AS o_custkey, 'O' AS o_orderstatus, "
            "TIMESTAMP_NTZ'2024-02-01 00:00:00' AS o_orderdate, '1-URGENT' AS o_orderpriority "
            "FROM range(12)"),
        # key 1 comes twice, at two prices
        "part": spark.sql("SELECT id % 4 AS p_partkey, CAST(10 + id AS double) AS p_retailprice "
                          "FROM range(6)"),
        # key 2 comes twice
        "customer": spark.sql("SELECT IF(id = 4, 2, id) AS c_custkey, CAST(id AS int) AS c_nationkey "
                              "FROM range(5)"),
        "nation": spark.sql("SELECT CAST(id AS int) AS n_nationkey FROM range(2)"),
    }
    for name, df in rows.items():
        df.write.parquet(os.path.join(folder, f"{name}.parquet"))
    return T.read_tables(spark, folder)


def test_line_items_are_shuffled_twice_at_most(spark, scratch):
    tables = _driver_tables(spark, scratch)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        events = T.raw_events(tables)
        lines = plan_text(events).splitlines()
        rows = events.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    depth = [len(re.match(r"^[ :+\-|]*", x).group()) for x in lines]
    scan = next(i for i, x in enumerate(lines) if "FileScan" in x and "l_orderkey" in x)
    above, at = [], depth[scan]
    for i in range(scan - 1, -1, -1):
        if depth[i] and depth[i] < at:
            at = depth[i]
            above.append(lines[i])
    keys = [re.search(r"hashpartitioning\((\w+)", x).group(1) for x in above if "Exchange" in x]
    assert keys == ["l_partkey", "l_orderkey"]

    made = {r.event_id: r for r in rows if r.event_id}
    # orders 0..9 have two items; order 3 has no customer, 2 and 6 one that comes twice
    assert len(rows) == 2 + 18 + 4 and len(made) == 18
    by_part = {k.split("-")[2]: r.unit_price_local for k, r in made.items()}
    assert by_part == {"0": "10.00", "1": "11.00", "2": "12.00", "3": "13.00", "4": None}


def test_staging_is_not_one_uncompiled_method(spark):
    """Stages that fuse to a method larger than HotSpot compiles are run operator by operator."""
    limit = int(SESSION_DEFAULTS["spark.sql.codegen.hugeMethodLimit"])
    assert limit == 8000
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) == limit


def _raw(spark):
    orders = [o for c in ("C1", "C2", None) for o in fx.orders_for(c, 3, product_id="P1")]
    return {"events": fx.events(spark, [*orders, {"event_type": "invoice", "customer_id": "C1"}]),
            "products": fx.products(spark, [{"product_id": "P1"},
                                            {"product_id": "P2", "category": "Add-on"}]),
            "customers": fx.customers(spark, [{"customer_id": "C1"}, {"customer_id": "C2"}])}


def test_report_order_stages_once(spark, monkeypatch):
    given = []
    for name in ("mart_sales_by_month", "mart_channel_performance", "mart_asp_by_country"):
        real = getattr(B.M, name)
        monkeypatch.setattr(B.M, name,
                            lambda ev, *a, real=real: given.append(ev.inputFiles()) or real(ev, *a))
    # as no mart reads a latitude, text that is none does no harm
    raw = _raw(spark)
    raw["events"] = raw["events"].withColumn("latitude", F.lit("north"))
    rows = C.q_report_order(Models(raw, 2)).collect()
    assert {r.mart for r in rows} >= {"mart_sales_by_month", "mart_channel_performance"}
    assert len(given) == 3 and all(files and all("/mart-events-" in f for f in files)
                                   for files in given)


@pytest.mark.parametrize("query, times", [(C.q_dq_file_drift, 6), (C.q_stream_ingest_events, 2),
                                          (C.q_inc_customer_orders, 2)])
def test_landed_rows_are_made_once(spark, monkeypatch, query, times):
    landed = []
    real = C.write_csv
    monkeypatch.setattr(C, "write_csv",
                        lambda df, path: landed.append(df.inputFiles()) or real(df, path))
    assert query(Models(_raw(spark), 2)).count()
    assert len(landed) == times
    assert all(files and all("/raw-" in f for f in files) for files in landed)
