"""Distinct customers from bitmaps equal count(distinct) at every level."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import distinct as D
from tidemark.operators.staging import orders


@pytest.fixture(scope="module")
def tables(spark):
    """70,000 customers (three buckets), one of them with a fifth of the orders,
    some unknown; products of which some are not in the catalogue."""
    events = spark.range(0, 150_000, 1, 6).selectExpr(
        "concat('E', id) AS event_id", "if(id % 50 = 0, 'invoice', 'order') AS event_type",
        "CASE WHEN id % 31 = 0 THEN NULL WHEN id % 5 = 0 THEN 'HOT' "
        "ELSE concat('C', pmod(hash(id), 70000)) END AS customer_id",
        "concat('P', id % 12) AS product_id",
        "cast(if(id % 40 = 0, NULL, id % 1000 / 4) AS decimal(12,4)) AS net_revenue_usd",
        "id % 9 = 0 AS is_refunded", "if(id % 6 = 0, 'CODE', NULL) AS discount_code",
        "element_at(array('Web', 'Shop', NULL), cast(id % 3 + 1 AS int)) AS channel",
        "concat('Land', id % 7) AS country", "concat('Region', id % 7 % 3) AS region",
        "if(id % 2 = 0, 'EUR', 'USD') AS currency", "concat('2025-0', id % 8 + 1) AS order_month",
        "cast(id % 8 div 3 + 1 AS int) AS order_quarter", "2025 AS order_year")
    products = spark.range(0, 10).selectExpr(
        "concat('P', id) AS product_id", "concat('Cat', id % 4) AS category",
        "if(id % 4 < 2, 'Monthly', 'Annual') AS billing_cycle")
    return events, products, D.customer_bitmaps(events, products, threshold=3).persist()


def test_every_level_against_count_distinct(tables):
    events, products, bitmaps = tables
    o = orders(events)
    loyal = o.where("customer_id IS NOT NULL").groupBy("customer_id").count().where("count >= 3")
    flagged = o.join(loyal.select("customer_id", F.lit(True).alias("loyal")), "customer_id", "left")
    known = flagged.join(products, "product_id")
    got = {(r.level, r.key): tuple(r)[2:] for r in D.every_level(bitmaps).collect()}
    want = {}
    for level, dimension, by in D.LEVELS:
        rows = known if dimension == "billing" else flagged
        key = F.concat_ws("/", *by) if by else F.lit("")
        for r in rows.groupBy(key.alias("key")).agg(
                F.count("event_id"), F.count_distinct("customer_id"),
                F.count_distinct(F.when(F.col("loyal"), F.col("customer_id"))),
                F.round(F.sum("net_revenue_usd"), 2).cast("decimal(22,2)"),
                F.count_if("is_refunded")).collect():
            want[level, r[0]] = tuple(r)[1:]
    assert got == want
    assert got["all", ""][1] > 40_000  # more than one bucket


def test_numbers_are_dense(tables):
    events, _, bitmaps = tables
    numbers = sorted(r.number for r in D.customer_numbers(orders(events)).collect())
    assert numbers == list(range(len(numbers)))
    # one row per group and bucket, whatever the number of orders
    assert bitmaps.count() <= 4 * sum((8, 3, 14, 4))


def test_no_orders(spark, tables):
    events, products, _ = tables
    empty = D.customer_bitmaps(events.limit(0), products)
    assert empty.count() == 0
    total = D.rolled_up(empty, "channel", []).first()
    assert total.unique_customers == 0 and total.total_orders is None
