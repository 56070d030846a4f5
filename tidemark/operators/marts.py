"""Gold marts: the seven reporting tables.

Sort order: a stored table has no order, so marts are returned unsorted;
``display_order`` gives the report order (nulls placed as the warehouse does:
last ascending, first descending) for presentation only, so a build never pays
a global range sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.metrics import MONEY, MONEY_TOTAL, RATE6, exact_avg, pct, rounded_ratio
from tidemark.functions.ranking import with_positions
from tidemark.operators.intermediate import (
    LOYALTY_THRESHOLD, MONEY_SUM, loyalty_rollup, order_partials,
)
from tidemark.operators.joins import left_join_skipping_null_keys
from tidemark.operators.staging import orders


def _money_total(c):
    return F.round(c, 2).cast(MONEY_TOTAL)


def _round2(c):
    return F.round(c, 2).cast(MONEY)


def _loyal_group_metrics(cust: DataFrame, keys: list) -> DataFrame:
    """Level two of a loyalty rollup: per group totals, distinct customers
    (non-null, one partial row each), loyal customers, revenue, refunds and
    discounted orders."""
    loyal = F.col("is_loyal")
    customers = F.count("customer_id")
    return cust.groupBy(*keys).agg(
        F.sum("n_orders").alias("total_orders"),
        customers.alias("unique_customers"),
        F.count_if(loyal).alias("loyal_customers"),
        _money_total(F.sum("rev_sum")).alias("total_revenue_usd"),
        exact_avg(F.sum("rev_sum").cast(MONEY_SUM), F.sum("rev_n"), 2, MONEY)
        .alias("avg_order_value_usd"),
        pct(F.count_if(loyal), customers).alias("loyal_customer_pct"),
        F.sum("refunds").cast("bigint").alias("total_refunds"),
        pct(F.sum("refunds"), F.sum("n_orders")).alias("refund_rate_pct"),
        F.sum("discounted").cast("bigint").alias("discounted_orders"),
    )


# --------------------------------------------------------------------------- M8

MONTH_KEYS = ["order_month", "order_year", "order_month_num", "order_quarter"]


def mart_sales_by_month(events: DataFrame, threshold: int = LOYALTY_THRESHOLD) -> DataFrame:
    """Per month: orders, customers, loyal customers and their share, revenue,
    average order value, refunds and discounted orders."""
    cust = loyalty_rollup(orders(events), MONTH_KEYS,
                          order_partials("rev_sum", "rev_n", "refunds", "discounted"), threshold)
    return _loyal_group_metrics(cust, MONTH_KEYS).select(
        *MONTH_KEYS, "total_orders", "unique_customers", "loyal_customers", "total_revenue_usd",
        "avg_order_value_usd", "loyal_customer_pct", "total_refunds", "refund_rate_pct",
        "discounted_orders")


# --------------------------------------------------------------------------- M9

def mart_channel_performance(events: DataFrame, threshold: int = LOYALTY_THRESHOLD) -> DataFrame:
    """Per sales channel: the monthly metrics plus discount usage."""
    cust = loyalty_rollup(orders(events), ["channel"],
                          order_partials("rev_sum", "rev_n", "refunds", "discounted"), threshold)
    return _loyal_group_metrics(cust, ["channel"]).select(
        "channel", "total_orders", "unique_customers", "loyal_customers", "total_revenue_usd",
        "avg_order_value_usd", "loyal_customer_pct", "total_refunds", "refund_rate_pct",
        "discounted_orders",
        pct(F.col("discounted_orders"), F.col("total_orders")).alias("discount_usage_pct"))


# --------------------------------------------------------------------------- M10

def mart_loyal_customers(loyal_customers: DataFrame) -> DataFrame:
    """Loyal customers with their profile and rounded order metrics."""
    return loyal_customers.where(F.col("is_loyal_customer")).select(
        "customer_id", "country", "region", "segment", "age_band", "acquisition_channel",
        "currency_preference", "signup_date", "total_orders",
        _money_total(F.col("total_revenue_usd")).alias("total_revenue_usd"),
        _round2(F.col("avg_order_value_usd")).alias("avg_order_value_usd"),
        "total_refunds", "primary_channel", "first_purchase_date", "last_purchase_date",
        "customer_lifespan_days", "days_to_second_purchase")


# --------------------------------------------------------------------------- M11

def mart_discount_analysis(discount_usage: DataFrame) -> DataFrame:
    """The discount-code model with money columns rounded for reporting."""
    return discount_usage.select(
        "discount_code", "total_orders", "unique_customers", "loyal_unique_customers",
        "loyal_customer_orders",
        _money_total(F.col("total_revenue_usd")).alias("total_revenue_usd"),
        _round2(F.col("avg_order_value_usd")).alias("avg_order_value_usd"),
        _money_total(F.col("total_discount_local")).alias("total_discount_local"),
        _round2(F.col("avg_discount_local")).alias("avg_discount_local"),
        "loyal_customer_pct", "total_refunds")


# --------------------------------------------------------------------------- M12

def mart_asp_by_country(events: DataFrame) -> DataFrame:
    """Average selling price by country x region x currency. One distinct
    count, so Spark's own two-phase distinct aggregation applies."""
    def avg_r(c, scale, out):
        return exact_avg(F.sum(c), F.count(c), scale, out)

    return orders(events).groupBy("country", "region", "currency").agg(
        F.count("event_id").alias("total_orders"),
        F.count_distinct("customer_id").alias("unique_customers"),
        avg_r("unit_price_local", 2, MONEY).alias("avg_selling_price_local"),
        avg_r("net_revenue_usd", 2, MONEY).alias("avg_selling_price_usd"),
        _money_total(F.sum("net_revenue_usd")).alias("total_revenue_usd"),
        avg_r("fx_rate_to_usd", 6, RATE6).alias("avg_fx_rate"),
        avg_r("discount_local", 2, MONEY).alias("avg_discount_local"),
        F.count("discount_code").alias("discounted_orders"),
    )


# --------------------------------------------------------------------------- M13

def orders_with_products(events: DataFrame, products: DataFrame) -> DataFrame:
    """Orders joined (inner) to the catalogue; orders of unknown products drop.
    The join strategy is left to the planner: the catalogue is broadcast when
    its measured size is under the broadcast threshold, else sort-merge with
    adaptive skew splitting."""
    p = products.select("product_id", "brand_safe_name", "category", "billing_cycle", "is_addon")
    return orders(events).select("event_id", "customer_id", "product_id", "net_revenue_usd",
                                 "is_refunded").join(p, "product_id")


# Group that collects every core (non-add-on) order in the attach-rate pass;
# the NUL prefix keeps it apart from any product name.
_CORE_GROUP = "\u0000core"


def mart_addon_attach_rate(events: DataFrame, products: DataFrame) -> DataFrame:
    """Per add-on (name x category): distinct buyers over the distinct buyers
    of any core product.

    One aggregation covers both: add-on orders group by (name, category), all
    core orders fall into one extra group, and Spark's two-phase distinct
    count spreads even that large group by customer. The result (one row per
    add-on, plus the core row) is checkpointed, and the core count is read
    from it as a scalar subquery, so orders are scanned and joined once and no
    cross join is needed.
    """
    addon = F.col("is_addon")
    counted = orders_with_products(events, products).groupBy(
        F.when(addon, F.col("brand_safe_name")).otherwise(F.lit(_CORE_GROUP)).alias("addon_name"),
        F.when(addon, F.col("category")).otherwise(F.lit(_CORE_GROUP)).alias("addon_category"),
    ).agg(
        F.count_distinct("customer_id").alias("customers_with_addon"),
        F.count("event_id").alias("total_addon_orders"),
        _money_total(F.sum("net_revenue_usd")).alias("total_addon_revenue_usd"),
    ).checkpoint(eager=True)
    is_core = F.col("addon_name").eqNullSafe(F.lit(_CORE_GROUP))
    core = counted.where(is_core).agg(
        F.coalesce(F.max("customers_with_addon"), F.lit(0))).scalar()
    with_core = counted.where(~is_core).withColumn("total_core_customers", core)
    return with_core.select(
        "addon_name", "addon_category", "customers_with_addon", "total_core_customers",
        pct(F.col("customers_with_addon"), F.col("total_core_customers")).alias("attach_rate_pct"),
        "total_addon_orders", "total_addon_revenue_usd")


# --------------------------------------------------------------------------- M14

def mart_billing_cycle_revenue(events: DataFrame, products: DataFrame,
                               threshold: int = LOYALTY_THRESHOLD) -> DataFrame:
    """Per billing cycle x category, over orders of known products, with the
    customer's loyalty taken from all their orders (known product or not)."""
    p = products.select("product_id", "billing_cycle", "category",
                        F.lit(True).alias("in_catalogue"))
    o = orders(events).select("event_id", "customer_id", "product_id", "net_revenue_usd",
                              "is_refunded")
    rows = left_join_skipping_null_keys(o, p, "product_id", salt="event_id")
    keys = ["in_catalogue", "billing_cycle", "category"]
    cust = loyalty_rollup(rows, keys, order_partials("rev_sum", "rev_n", "refunds"), threshold)
    customers = F.count("customer_id")
    return cust.where(F.col("in_catalogue")).groupBy("billing_cycle", "category").agg(
        F.sum("n_orders").alias("total_orders"),
        customers.alias("unique_customers"),
        F.count_if(F.col("is_loyal")).alias("loyal_customers"),
        _money_total(F.sum("rev_sum")).alias("total_revenue_usd"),
        exact_avg(F.sum("rev_sum").cast(MONEY_SUM), F.sum("rev_n"), 2, MONEY)
        .alias("avg_revenue_per_order_usd"),
        rounded_ratio(F.sum("rev_sum"), customers, 2, MONEY).alias("avg_revenue_per_customer_usd"),
        F.sum("refunds").cast("bigint").alias("total_refunds"),
        pct(F.sum("refunds"), F.sum("n_orders")).alias("refund_rate_pct"),
    )


# --------------------------------------------------------------------------- display order

# (column, descending?) per model; nulls last ascending, first descending.
DISPLAY_ORDER = {
    "int_discount_usage": [("total_orders", True)],
    "mart_discount_analysis": [("total_orders", True)],
    "mart_asp_by_country": [("total_revenue_usd", True)],
    "mart_channel_performance": [("total_revenue_usd", True)],
    "mart_loyal_customers": [("total_revenue_usd", True)],
    "mart_addon_attach_rate": [("attach_rate_pct", True)],
    "mart_sales_by_month": [("order_year", False), ("order_month_num", False)],
    "mart_billing_cycle_revenue": [("billing_cycle", False), ("total_revenue_usd", True)],
}


def _report_keys(name: str) -> list:
    return [F.desc_nulls_first(c) if desc else F.asc_nulls_last(c)
            for c, desc in DISPLAY_ORDER.get(name, [])]


def display_order(name: str, df: DataFrame) -> DataFrame:
    """The model's report order, for presentation (adds a global sort)."""
    keys = _report_keys(name)
    return df.orderBy(*keys) if keys else df


def report_order(name: str, df: DataFrame) -> DataFrame:
    """The model in report order with each row's place in ``position``, so that
    the order survives being stored; rows with equal keys come in the order of
    all columns."""
    return with_positions(df, _report_keys(name))


__all__ = ["mart_sales_by_month", "mart_channel_performance", "mart_loyal_customers",
           "mart_discount_analysis", "mart_asp_by_country", "mart_addon_attach_rate",
           "mart_billing_cycle_revenue", "display_order", "report_order"]
