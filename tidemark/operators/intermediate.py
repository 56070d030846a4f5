"""Intermediate models (silver): customer histories, loyalty, products, discounts.

Plan notes (scale):

* Distinct-customer counts next to a loyalty flag are computed in two levels:
  first at (group keys, customer) grain with map-side partial aggregation, then
  the customer's whole-history order count by a window over those partial rows,
  then the group. No order-level shuffle by customer, no Expand of rows for
  two distinct counts, and a hot customer (or the null customer) contributes
  one partial row per group and map task instead of all its orders.
* First and second purchase come from ``row_number() <= 2``; Spark plans a
  partial group limit before the shuffle, so each map task ships at most two
  rows per customer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.metrics import count_when, exact_avg, pct
from tidemark.operators.joins import left_join_splitting_hot_keys
from tidemark.operators.staging import orders

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's).
# A customer with at least this many orders over their whole history is loyal.
LOYALTY_THRESHOLD = 10
# Channels broken out one column each in the product model, in this order.
CHANNEL_COLUMNS = (
    ("Website", "orders_website"),
    ("Marketplace", "orders_marketplace"),
    ("Direct Sales", "orders_direct_sales"),
    ("Partner", "orders_partner"),
    ("Reseller", "orders_reseller"),
)
NO_DISCOUNT_LABEL = "No Discount"
# ---------------------------------------------------------------------------

RANKS_PER_ROW = 4096  # of one customer and date that one row writes out
MONEY_SUM = "decimal(22,4)"
AVG4 = "decimal(16,4)"


def avg4(c) -> Column:
    """Unrounded-model average: keeps the argument's 4 decimals (half-up)."""
    c = F.col(c) if isinstance(c, str) else c
    return exact_avg(F.sum(c), F.count(c), 4, AVG4)


# --------------------------------------------------------------------------- M4

def purchase_ranks(events: DataFrame, max_rank: int = 2) -> DataFrame:
    """First ``max_rank`` purchases per customer: (customer_id, event_date, purchase_rank).

    Orders are ranked by event_date ascending, nulls last; ties are broken
    arbitrarily, which never changes the (customer, date, rank) rows. Orders
    without a customer never pair up and are left out.
    """
    w = Window.partitionBy("customer_id").orderBy(F.asc_nulls_last("event_date"))
    return (orders(events)
            .where(F.col("customer_id").isNotNull())
            .select("customer_id", "event_date", F.row_number().over(w).alias("purchase_rank"))
            .where(F.col("purchase_rank") <= max_rank))


def all_purchase_ranks(events: DataFrame) -> DataFrame:
    """Every order's rank among its customer's orders by event_date, nulls last
    (customer_id, event_date, purchase_rank); orders without a customer are
    ranked as one group.

    Orders are counted per (customer, date) first, with map-side partials. The
    counts are sorted by range partitions and checkpointed, as in
    ``functions.ranking``; a window adds them up inside each partition, and the
    customer that a partition begins with gets what earlier partitions hold of
    it. Each date's consecutive ranks are then written out in dealt pieces of
    ``RANKS_PER_ROW``, so a customer's orders never meet in one task.
    """
    dates = orders(events).groupBy("customer_id", "event_date").agg(
        F.count(F.lit(1)).alias("_n"))
    ordered = (dates.orderBy(F.asc_nulls_last("customer_id"), F.asc_nulls_last("event_date"))
               .withColumn("_part", F.spark_partition_id())
               .checkpoint(eager=True))
    before = (Window.partitionBy("_part", "customer_id").orderBy(F.asc_nulls_last("event_date"))
              .rowsBetween(Window.unboundedPreceding, -1))
    offsets = _orders_in_earlier_parts(ordered)
    earlier = F.coalesce(F.sum("_n").over(before), F.lit(0))
    same = (F.col("_part") == F.col("_at")) & F.col("customer_id").eqNullSafe(F.col("_customer"))
    counted = (ordered.withColumn("_before", earlier)
               .join(F.broadcast(offsets), same, "left")
               .withColumn("_first", F.col("_before") + F.coalesce("_offset", F.lit(0)) + 1)
               .withColumn("_last", F.col("_first") + F.col("_n") - 1))
    pieces = counted.select("customer_id", "event_date", "_last", F.explode(
        F.sequence("_first", "_last", F.lit(RANKS_PER_ROW).cast("bigint"))).alias("_from"))
    return (pieces.repartition("customer_id", "event_date", "_from")
            .select("customer_id", "event_date",
                    F.explode(F.sequence("_from", F.least(
                        "_last", F.col("_from") + (RANKS_PER_ROW - 1)))).alias("purchase_rank")))


def _orders_in_earlier_parts(ordered: DataFrame) -> DataFrame:
    """(_at, _customer, _offset) for each partition's first customer: its orders
    in earlier partitions. At most a few rows per partition."""
    key = F.struct(F.col("customer_id").isNull(), F.col("customer_id"))
    firsts = ordered.groupBy("_part").agg(F.min(key).alias("_key"))
    firsts = firsts.select(F.col("_key.customer_id").alias("_customer")).distinct()
    per_part = (ordered.join(F.broadcast(firsts),
                             F.col("customer_id").eqNullSafe(F.col("_customer")))
                .groupBy("_customer", F.col("_part").alias("_at"))
                .agg(F.sum("_n").alias("_part_rows")))
    parts = (Window.partitionBy("_customer").orderBy("_at")
             .rowsBetween(Window.unboundedPreceding, -1))
    return per_part.select("_at", "_customer", F.coalesce(
        F.sum("_part_rows").over(parts), F.lit(0)).alias("_offset"))


def second_purchase(events: DataFrame) -> DataFrame:
    """Per customer with two or more orders: first and second purchase dates
    and the calendar days between them."""
    ranks = purchase_ranks(events, 2)
    first = F.max(F.when(F.col("purchase_rank") == 1, F.col("event_date")))
    second = F.max(F.when(F.col("purchase_rank") == 2, F.col("event_date")))
    return (ranks.groupBy("customer_id")
            .agg(first.alias("first_purchase_date"), second.alias("second_purchase_date"),
                 F.max("purchase_rank").alias("_ranks"))
            .where(F.col("_ranks") >= 2)
            .select("customer_id", "first_purchase_date", "second_purchase_date",
                    F.datediff(F.col("second_purchase_date").cast("date"),
                               F.col("first_purchase_date").cast("date"))
                    .alias("days_to_second_purchase")))


PARTIAL_KEYS = ("customer_id", "channel", "order_day")


def customer_partials(events: DataFrame) -> DataFrame:
    """Orders added up per customer, channel and day: the mergeable state from
    which every customer model is made.

    Partials of disjoint sets of events can be appended to each other or merged
    (``merged_partials``) with the same result, and a customer has at most one row
    per channel and day, however many orders that holds. All buffers are of
    fixed width, so this is a hash aggregation with map-side partials: no order
    is sorted or shuffled as a row.
    """
    return (orders(events)
            .groupBy("customer_id", "channel", F.col("event_date").cast("date").alias("order_day"))
            .agg(F.count("event_id").alias("n_orders"), F.count(F.lit(1)).alias("n_rows"),
                 F.sum("net_revenue_usd").cast(MONEY_SUM).alias("rev_sum"),
                 F.count("net_revenue_usd").alias("rev_n"),
                 F.count_if(F.col("is_refunded")).alias("refunds"),
                 F.min("event_date").alias("first_date"), F.max("event_date").alias("last_date")))


def merged_partials(partials: DataFrame) -> DataFrame:
    """One row per customer, channel and day of appended partials."""
    return partials.groupBy(*PARTIAL_KEYS).agg(
        *[F.sum(c).alias(c) for c in ("n_orders", "n_rows")],
        F.sum("rev_sum").cast(MONEY_SUM).alias("rev_sum"),
        *[F.sum(c).alias(c) for c in ("rev_n", "refunds")],
        F.min("first_date").alias("first_date"), F.max("last_date").alias("last_date"))


def customer_summary(partials: DataFrame) -> DataFrame:
    """``int_customer_orders`` from partials. The second purchase falls on the
    first day by which two orders were placed, undated ones last."""
    by_day = Window.partitionBy("customer_id").orderBy(F.asc_nulls_last("order_day"))
    rows = partials.withColumn("_placed", F.sum("n_rows").over(by_day))
    first, last = F.min("first_date"), F.max("last_date")
    second_day = F.min(F.when(F.col("_placed") >= 2, F.col("order_day")))
    return rows.groupBy("customer_id").agg(
        F.sum("n_orders").alias("total_orders"),
        F.sum("rev_sum").cast(MONEY_SUM).alias("total_revenue_usd"),
        exact_avg(F.sum("rev_sum").cast(MONEY_SUM), F.sum("rev_n"), 4, AVG4)
        .alias("avg_order_value_usd"),
        first.alias("first_purchase_date"),
        last.alias("last_purchase_date"),
        F.datediff(last.cast("date"), first.cast("date")).alias("customer_lifespan_days"),
        F.sum("refunds").cast("bigint").alias("total_refunds"),
        F.max("channel").alias("primary_channel"),
        F.when(F.col("customer_id").isNotNull(), F.datediff(second_day, F.min("order_day")))
        .alias("days_to_second_purchase"))


def channel_modes(partials: DataFrame) -> DataFrame:
    """Per customer the alphabetically last channel and the one with most orders
    (the lowest name on a tie), from rows of (customer_id, channel, n_rows)."""
    per_channel = partials.groupBy("customer_id", "channel").agg(F.sum("n_rows").alias("_n"))
    best = F.min(F.when(F.col("channel").isNotNull(), F.struct(-F.col("_n"), F.col("channel"))))
    return per_channel.groupBy("customer_id").agg(
        F.max("channel").alias("primary_channel"),
        best.getField("channel").alias("most_frequent_channel"))


def int_customer_orders(events: DataFrame) -> DataFrame:
    """One row per customer (null customers form one group) with order count,
    revenue, average order value, first/last purchase, lifespan in days,
    refund count, alphabetically last channel and days to second purchase,
    from one scan of the events."""
    return customer_summary(customer_partials(events))


# --------------------------------------------------------------------------- M5

LOYAL_COLUMNS = (
    "customer_id", "is_loyal_customer", "total_orders", "total_revenue_usd",
    "avg_order_value_usd", "total_refunds", "primary_channel", "first_purchase_date",
    "last_purchase_date", "customer_lifespan_days", "days_to_second_purchase",
    "country", "region", "segment", "age_band", "acquisition_channel",
    "currency_preference", "signup_date",
)


def loyalty_flag(threshold: int = LOYALTY_THRESHOLD) -> Column:
    """The loyalty rule over a customer's whole-history order count."""
    return F.coalesce(F.col("total_orders") >= F.lit(threshold), F.lit(False))


def loyalty_flags(customer_orders: DataFrame, threshold: int = LOYALTY_THRESHOLD) -> DataFrame:
    """(customer_id, is_loyal_customer) straight from the order summary: the
    flag depends on the order count only, so joining the profile first (as the
    loyal-customer model does) changes nothing while customer keys are unique."""
    return customer_orders.select("customer_id", loyalty_flag(threshold).alias("is_loyal_customer"))


def int_loyal_customers(customer_orders: DataFrame, customers: DataFrame,
                        threshold: int = LOYALTY_THRESHOLD) -> DataFrame:
    """Customer histories with the loyalty flag and the customer's profile.
    Driven from orders: customers who never ordered are absent; orders of
    customers without a profile keep null profile columns."""
    flagged = customer_orders.withColumn("is_loyal_customer", loyalty_flag(threshold))
    profile = customers.select("customer_id", "country", "region", "segment", "age_band",
                               "acquisition_channel", "currency_preference", "signup_date")
    return flagged.join(profile, "customer_id", "left").select(*LOYAL_COLUMNS)


def with_loyalty(order_rows: DataFrame, loyal_customers: DataFrame) -> DataFrame:
    """Order rows plus ``is_loyal_customer`` (false when the customer is null or
    has no loyalty row), the literal order-level join.

    Null customers can never match, so they skip the join instead of all
    hashing to one reducer; hot customers are found by a sketch of one pass over
    the key and dealt over several reducers. Aggregating marts use
    ``loyalty_rollup`` instead, which joins nothing at order grain.
    """
    flags = loyal_customers.select("customer_id", "is_loyal_customer")
    return (left_join_splitting_hot_keys(order_rows, flags, "customer_id", salt="event_id")
            .withColumn("is_loyal_customer", F.coalesce(F.col("is_loyal_customer"), F.lit(False))))


# --------------------------------------------------------------------------- loyalty rollup

def loyalty_rollup(rows: DataFrame, keys: list, partials: dict[str, Column],
                   threshold: int = LOYALTY_THRESHOLD) -> DataFrame:
    """Order rows -> one row per (customer_id, *keys) with ``partials`` and
    ``is_loyal`` (the customer's orders over all keys >= threshold).

    ``rows`` must hold every order of each customer (rows that should not count
    toward a group carry a key that the caller filters out afterwards), so the
    window total equals the customer's whole-history order count. A null
    customer is never loyal: it joins to no loyalty row in the literal form.
    """
    aggs = {"n_orders": F.count("event_id"), **partials}
    level1 = rows.groupBy("customer_id", *keys).agg(*[c.alias(n) for n, c in aggs.items()])
    history = F.sum("n_orders").over(Window.partitionBy("customer_id"))
    return level1.withColumn(
        "is_loyal", F.col("customer_id").isNotNull() & (history >= F.lit(threshold)))


def order_partials(*names: str) -> dict[str, Column]:
    """Per-(customer, group) partial aggregates used by the rollups."""
    catalogue = {
        "rev_sum": F.sum("net_revenue_usd"),
        "rev_n": F.count("net_revenue_usd"),
        "refunds": count_when(F.col("is_refunded")),
        "discounted": F.count("discount_code"),
        "disc_sum": F.sum("discount_local"),
        "disc_n": F.count("discount_local"),
    }
    return {n: catalogue[n] for n in names}


# --------------------------------------------------------------------------- M7

def int_discount_usage(events: DataFrame, threshold: int = LOYALTY_THRESHOLD) -> DataFrame:
    """One row per discount code ('No Discount' for none): orders, customers,
    revenue, discount amounts, loyal orders/customers and refunds."""
    rows = orders(events).withColumn(
        "discount_code", F.coalesce(F.col("discount_code"), F.lit(NO_DISCOUNT_LABEL)))
    cust = loyalty_rollup(rows, ["discount_code"],
                          order_partials("rev_sum", "rev_n", "disc_sum", "disc_n", "refunds"),
                          threshold)
    loyal = F.col("is_loyal")
    return cust.groupBy("discount_code").agg(
        F.sum("n_orders").alias("total_orders"),
        F.count("customer_id").alias("unique_customers"),
        F.sum("rev_sum").cast(MONEY_SUM).alias("total_revenue_usd"),
        exact_avg(F.sum("rev_sum").cast(MONEY_SUM), F.sum("rev_n"), 4, AVG4)
        .alias("avg_order_value_usd"),
        F.sum("disc_sum").cast(MONEY_SUM).alias("total_discount_local"),
        exact_avg(F.sum("disc_sum").cast(MONEY_SUM), F.sum("disc_n"), 4, AVG4)
        .alias("avg_discount_local"),
        F.coalesce(F.sum(F.when(loyal, F.col("n_orders"))), F.lit(0)).cast("bigint")
        .alias("loyal_customer_orders"),
        F.count_if(loyal).alias("loyal_unique_customers"),
        pct(F.count_if(loyal), F.count("customer_id")).alias("loyal_customer_pct"),
        F.sum("refunds").cast("bigint").alias("total_refunds"),
    )


# --------------------------------------------------------------------------- M6

PRODUCT_ATTRIBUTES = ("product_id", "product_name", "brand_safe_name", "category", "vendor",
                      "billing_cycle", "is_subscription", "is_addon", "base_price_usd")


def int_product_performance(events: DataFrame, products: DataFrame) -> DataFrame:
    """Every product (sold or not) with order, customer, revenue, price,
    discount, refund and per-channel counts. Orders are aggregated to product
    grain before the join, so the join is product-to-product sized."""
    o = orders(events)
    per_product = o.groupBy("product_id").agg(
        F.count("event_id").alias("_orders"),
        F.count_distinct("customer_id").alias("_customers"),
        F.sum("net_revenue_usd").alias("_rev_sum"),
        F.count("net_revenue_usd").alias("_rev_n"),
        F.sum("unit_price_local").alias("_price_sum"),
        F.count("unit_price_local").alias("_price_n"),
        F.sum("discount_local").alias("_disc_sum"),
        F.count("discount_local").alias("_disc_n"),
        F.count("discount_code").alias("_discounted"),
        count_when(F.col("is_refunded")).alias("_refunds"),
        *[count_when(F.col("channel") == F.lit(ch)).alias(f"_{name}")
          for ch, name in CHANNEL_COLUMNS],
    )
    joined = products.select(*PRODUCT_ATTRIBUTES).join(per_product, "product_id", "left")

    def zero(c):
        return F.coalesce(F.col(c), F.lit(0)).cast("bigint")

    def avg_of(s, n):
        return F.round(F.col(s) / F.nullif(F.col(n), F.lit(0)).cast("decimal(20,0)"), 4).cast(AVG4)

    return joined.select(
        *PRODUCT_ATTRIBUTES,
        zero("_orders").alias("total_orders"),
        zero("_customers").alias("unique_customers"),
        F.col("_rev_sum").cast(MONEY_SUM).alias("total_revenue_usd"),
        avg_of("_rev_sum", "_rev_n").alias("avg_revenue_per_order_usd"),
        avg_of("_price_sum", "_price_n").alias("avg_selling_price_local"),
        avg_of("_rev_sum", "_rev_n").alias("avg_selling_price_usd"),
        F.col("_disc_sum").cast(MONEY_SUM).alias("total_discount_local"),
        avg_of("_disc_sum", "_disc_n").alias("avg_discount_local"),
        zero("_discounted").alias("discounted_orders"),
        zero("_refunds").alias("total_refunds"),
        *[zero(f"_{name}").alias(name) for _, name in CHANNEL_COLUMNS],
    )
