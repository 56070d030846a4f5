"""Exact distinct customers that add up: a table of bitmaps.

``count(distinct customer)`` cannot be added over groups, so every roll-up level
would need its own pass over the orders. Here customers get dense numbers, and a
group's customers are kept as bitmaps over those numbers, one row per group and
bucket of 32,768 numbers. The union of bitmaps is exact, so any coarser group, and
the total, is made from the table alone, next to the additive sums.

The table holds a few *dimensions* side by side, each with up to three keys from
fine to coarse; every order counts once in each. So it has about (groups of all
dimensions) x (customers / 32,768) rows of at most two 4 KB bitmaps, not the
product of the dimensions, and it is made from one scan of the orders:

1. each order is expanded to its dimensions and added up per (group, customer)
   with map-side partials; a hot customer or group is one row per map task;
2. a customer's whole history (its orders in one dimension) gives the loyalty
   flag by a window over those rows;
3. they are written down, customers are numbered by range partitions with
   offsets, and rows are merged into bitmaps per (group, bucket).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.metrics import (
    MONEY, MONEY_TOTAL, count_when, exact_avg, pct, rounded_ratio,
)
from tidemark.functions.ranking import with_positions
from tidemark.operators.intermediate import LOYALTY_THRESHOLD, MONEY_SUM
from tidemark.operators.joins import left_join_skipping_null_keys
from tidemark.operators.staging import orders
from tidemark.session import written

# Keys of each dimension, from fine to coarse where they nest.
DIMENSIONS = {
    "month": ("order_month", "order_quarter", "order_year"),
    "channel": ("channel",),
    "country": ("country", "region", "currency"),
    "billing": ("category", "billing_cycle"),
}
KEYS = ("k1", "k2", "k3")
SUMS = ("n_orders", "rev_sum", "rev_n", "refunds", "discounted")


def customer_numbers(customers: DataFrame) -> DataFrame:
    """(customer_id, number): the distinct non-null ids numbered 0, 1, ... in order."""
    ids = customers.select("customer_id").where("customer_id IS NOT NULL").distinct()
    return with_positions(ids, [F.asc("customer_id")]).select(
        "customer_id", (F.col("position") - 1).alias("number"))


def _groups() -> Column:
    """The groups of an order, one per dimension; orders of unknown products have
    no billing group."""
    def group(name, keys):
        named = [F.col(k).cast("string").alias(n) for k, n in zip(keys, KEYS)]
        rest = [F.lit(None).cast("string").alias(n) for n in KEYS[len(keys):]]
        return F.struct(F.lit(name).alias("dimension"), *named, *rest)
    groups = [group(n, keys) for n, keys in DIMENSIONS.items() if n != "billing"]
    billing = F.when(F.col("in_catalogue"), group("billing", DIMENSIONS["billing"]))
    return F.filter(F.array(*groups, billing), lambda g: g.isNotNull())


def customer_bitmaps(events: DataFrame, products: DataFrame,
                     threshold: int = LOYALTY_THRESHOLD) -> DataFrame:
    """(dimension, k1, k2, k3, bucket, customers, loyal, sums): the bitmap table.

    Orders without a customer are in the sums, on rows without a bucket. The
    groups per customer are written down, as they are read twice.
    """
    p = products.select("product_id", "billing_cycle", "category",
                        F.lit(True).alias("in_catalogue"))
    rows = left_join_skipping_null_keys(
        orders(events).select(
            "event_id", "customer_id", "product_id", "net_revenue_usd", "is_refunded",
            "discount_code", "channel", "country", "region", "currency", "order_month",
            "order_quarter", "order_year"), p, "product_id", salt="event_id")
    expanded = rows.select("*", F.inline(_groups()).alias("dimension", *KEYS))
    per_customer = expanded.groupBy("dimension", *KEYS, "customer_id").agg(
        F.count("event_id").alias("n_orders"),
        F.sum("net_revenue_usd").cast(MONEY_SUM).alias("rev_sum"),
        F.count("net_revenue_usd").alias("rev_n"),
        count_when(F.col("is_refunded")).alias("refunds"),
        F.count("discount_code").alias("discounted"))
    # every order is in the channel dimension exactly once
    history = F.sum(F.when(F.col("dimension") == "channel", F.col("n_orders"))).over(
        Window.partitionBy("customer_id"))
    flagged = written(per_customer.withColumn(
        "is_loyal", F.col("customer_id").isNotNull() & (history >= F.lit(threshold))),
        "customer-groups")
    numbers = customer_numbers(flagged)
    numbered = left_join_skipping_null_keys(flagged, numbers, "customer_id", salt="k1")
    place = F.bitmap_bit_position("number")
    return numbered.groupBy(
        "dimension", *KEYS, F.bitmap_bucket_number("number").alias("bucket")).agg(
        F.bitmap_construct_agg(place).alias("customers"),
        F.bitmap_construct_agg(F.when(F.col("is_loyal"), place)).alias("loyal"),
        F.sum("n_orders").alias("n_orders"),
        F.sum("rev_sum").cast(MONEY_SUM).alias("rev_sum"),
        *[F.sum(c).alias(c) for c in ("rev_n", "refunds", "discounted")])


def rolled_up(bitmaps: DataFrame, dimension: str, by: list[str] | None = None) -> DataFrame:
    """Totals of one dimension at any level: the given keys of it (all by
    default, none for the grand total), with ``unique_customers`` and
    ``loyal_customers`` counted exactly from the united bitmaps."""
    own = DIMENSIONS[dimension]
    by = list(own) if by is None else by
    rows = bitmaps.where(F.col("dimension") == dimension)
    return _united(rows.select(*[F.col(KEYS[own.index(k)]).alias(k) for k in by],
                               "bucket", "customers", "loyal", *SUMS), by)


def _united(rows: DataFrame, by: list[str]) -> DataFrame:
    per_bucket = rows.groupBy(*by, "bucket").agg(
        F.bitmap_or_agg("customers").alias("customers"), F.bitmap_or_agg("loyal").alias("loyal"),
        *[F.sum(c).alias(c) for c in SUMS])
    known = F.col("bucket").isNotNull()
    return per_bucket.groupBy(*by).agg(
        F.sum("n_orders").alias("total_orders"),
        F.coalesce(F.sum(F.when(known, F.bitmap_count("customers"))), F.lit(0))
        .alias("unique_customers"),
        F.coalesce(F.sum(F.when(known, F.bitmap_count("loyal"))), F.lit(0))
        .alias("loyal_customers"),
        F.sum("rev_sum").cast(MONEY_SUM).alias("rev_sum"),
        *[F.sum(c).alias(c) for c in ("rev_n", "refunds", "discounted")])


def billing_cycle_revenue(bitmaps: DataFrame) -> DataFrame:
    """The billing-cycle mart (cycle x category) from the bitmap table."""
    total = F.col("rev_sum")
    return rolled_up(bitmaps, "billing").select(
        "billing_cycle", "category", "total_orders", "unique_customers", "loyal_customers",
        F.round(total, 2).cast(MONEY_TOTAL).alias("total_revenue_usd"),
        exact_avg(total, F.col("rev_n"), 2, MONEY).alias("avg_revenue_per_order_usd"),
        rounded_ratio(total, F.col("unique_customers"), 2, MONEY)
        .alias("avg_revenue_per_customer_usd"),
        F.col("refunds").alias("total_refunds"),
        pct(F.col("refunds"), F.col("total_orders")).alias("refund_rate_pct"))


def billing_cycles(bitmaps: DataFrame) -> DataFrame:
    """The billing-cycle report (cycle totals) from the same table, one level up."""
    total = F.col("rev_sum")
    return rolled_up(bitmaps, "billing", ["billing_cycle"]).select(
        "billing_cycle", "total_orders", "unique_customers",
        F.round(total, 2).cast(MONEY_TOTAL).alias("total_revenue_usd"),
        rounded_ratio(total, F.col("unique_customers"), 2, MONEY)
        .alias("avg_revenue_per_customer_usd"),
        F.col("refunds").alias("total_refunds"),
        pct(F.col("refunds"), F.col("total_orders")).alias("refund_rate_pct"))


# (level, dimension, keys) of ``every_level``.
LEVELS = (
    ("month", "month", ("order_month",)),
    ("quarter", "month", ("order_year", "order_quarter")),
    ("year", "month", ("order_year",)),
    ("channel", "channel", ("channel",)),
    ("country", "country", ("country",)),
    ("region", "country", ("region",)),
    ("currency", "country", ("currency",)),
    ("billing_cycle", "billing", ("billing_cycle",)),
    ("category", "billing", ("category",)),
    ("all", "channel", ()),
)


def every_level(bitmaps: DataFrame) -> DataFrame:
    """(level, key, totals): the same figures at every level, from one table and
    in one pass: each group is expanded to the levels that it belongs to."""
    def of(level, dimension, by):
        keys = [F.col(KEYS[DIMENSIONS[dimension].index(k)]) for k in by]
        key = F.concat_ws("/", *keys) if keys else F.lit("")
        return F.when(F.col("dimension") == dimension,
                      F.struct(F.lit(level).alias("level"), key.alias("key")))
    levels = F.filter(F.array(*[of(*x) for x in LEVELS]), lambda x: x.isNotNull())
    rows = bitmaps.select(F.inline(levels), "bucket", "customers", "loyal", *SUMS)
    return _united(rows, ["level", "key"]).select(
        "level", "key", "total_orders", "unique_customers", "loyal_customers",
        F.round("rev_sum", 2).cast(MONEY_TOTAL).alias("total_revenue_usd"),
        F.col("refunds").alias("total_refunds"))
