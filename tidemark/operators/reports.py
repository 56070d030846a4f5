"""Report queries over gold: the figures the dashboard reads.

Ratios are re-aggregated from numerators and denominators, never summed or
averaged across rows (percentages and distinct counts are not additive).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.ranking import with_global_ranks
from tidemark.functions.metrics import MONEY, MONEY_TOTAL, PERCENT, pct, rounded_ratio
from tidemark.operators.marts import orders_with_products
from tidemark.session import written


def _share_pct(part, whole):
    """round(part / whole * 100, 2) for decimal money values."""
    q = part.cast("decimal(22,2)") / F.nullif(whole, F.lit(0)).cast("decimal(22,2)")
    return F.round(q * F.lit(100), 2).cast(PERCENT)


def rep_loyal_share(loyal_customers: DataFrame) -> DataFrame:
    """Loyal share of the ordering customers (the null group is not a customer)."""
    known = loyal_customers.where(F.col("customer_id").isNotNull())
    return known.agg(
        F.count_if(F.col("is_loyal_customer")).alias("loyal_customers"),
        F.count(F.lit(1)).alias("ordering_customers"),
    ).select("loyal_customers", "ordering_customers",
             pct(F.col("loyal_customers"), F.col("ordering_customers")).alias("loyal_share_pct"))


def rep_peak_month(sales_by_month: DataFrame) -> DataFrame:
    """The month with the highest revenue (earliest month on a tie); a top-1 report."""
    return (sales_by_month.select("order_month", "total_revenue_usd", "total_orders")
            .orderBy(F.desc_nulls_last("total_revenue_usd"), F.asc("order_month")).limit(1))


def rep_region_revenue_share(asp_by_country: DataFrame) -> DataFrame:
    """Revenue and its share per region; the grand total is a scalar subquery."""
    # The per-region rows (one per region) are checkpointed, so the grand total
    # and the shares read the same small table instead of computing the mart
    # from orders twice.
    per_region = asp_by_country.groupBy("region").agg(
        F.sum("total_revenue_usd").cast(MONEY_TOTAL).alias("total_revenue_usd"),
        F.sum("total_orders").alias("total_orders")).checkpoint(eager=True)
    grand = per_region.agg(F.sum("total_revenue_usd")).scalar()
    return per_region.select("region", "total_revenue_usd", "total_orders",
                             _share_pct(F.col("total_revenue_usd"), grand).alias("revenue_share_pct"))


def rep_country_pricing(asp_by_country: DataFrame) -> DataFrame:
    """Per country, collapsing region/currency rows: orders, revenue,
    discounted orders and the order-weighted average selling price."""
    return asp_by_country.groupBy("country").agg(
        F.sum("total_orders").alias("total_orders"),
        F.sum("total_revenue_usd").cast(MONEY_TOTAL).alias("total_revenue_usd"),
        F.sum("discounted_orders").alias("discounted_orders"),
        rounded_ratio(F.sum("total_revenue_usd"), F.sum("total_orders"), 2, MONEY)
        .alias("avg_selling_price_usd"))


def _loyal_by(loyal: DataFrame, attribute: str) -> DataFrame:
    return loyal.groupBy(attribute).agg(
        F.count(F.lit(1)).alias("loyal_customers"),
        F.sum("total_revenue_usd").cast(MONEY_TOTAL).alias("total_revenue_usd"),
        F.sum("total_orders").alias("total_orders"))


def rep_loyal_by_segment(mart_loyal: DataFrame) -> DataFrame:
    """Loyal customers and their revenue by segment."""
    return _loyal_by(mart_loyal, "segment")


def rep_loyal_by_age_band(mart_loyal: DataFrame) -> DataFrame:
    """By age band."""
    return _loyal_by(mart_loyal, "age_band")


def rep_loyal_by_acquisition(mart_loyal: DataFrame) -> DataFrame:
    """By acquisition channel."""
    return _loyal_by(mart_loyal, "acquisition_channel")


def rep_discount_rank(discount_analysis: DataFrame) -> DataFrame:
    """Discount codes ranked by use, revenue and loyal conversion
    (SQL ``rank()``, highest first), computed without a single-task window."""
    # The aggregated code table is written once, so that ranking does not
    # recompute the orders pipeline.
    ranked = written(discount_analysis.select("discount_code", "total_orders",
                                              "total_revenue_usd", "loyal_customer_pct"), "codes")
    return with_global_ranks(ranked, [("total_orders", "rank_by_orders"),
                                      ("total_revenue_usd", "rank_by_revenue"),
                                      ("loyal_customer_pct", "rank_by_loyal_pct")])


def rep_channel_rank(channel_performance: DataFrame) -> DataFrame:
    """Sales channels ranked by revenue, loyal customers, refund rate and
    discount use (SQL ``rank()``, highest first)."""
    # One row per channel, written once for the four rankings.
    ranked = written(channel_performance.select("channel", "total_revenue_usd", "loyal_customers",
                                                "refund_rate_pct", "discount_usage_pct"),
                     "channels")
    return with_global_ranks(ranked, [("total_revenue_usd", "rank_by_revenue"),
                                      ("loyal_customers", "rank_by_loyal_customers"),
                                      ("refund_rate_pct", "rank_by_refund_rate"),
                                      ("discount_usage_pct", "rank_by_discount_usage")])


def rep_attach_range(addon_attach: DataFrame) -> DataFrame:
    """Range of add-on attach rates."""
    return addon_attach.agg(
        F.count(F.lit(1)).alias("addons"),
        F.min("attach_rate_pct").alias("min_attach_rate_pct"),
        F.max("attach_rate_pct").alias("max_attach_rate_pct"))


def rep_billing_cycle(events: DataFrame, products: DataFrame) -> DataFrame:
    """Billing-cycle totals re-aggregated from orders (not a sum of the
    per-category rates): revenue, revenue per distinct customer, refund rate."""
    owp = orders_with_products(events, products)
    customers = F.count_distinct("customer_id")
    return owp.groupBy("billing_cycle").agg(
        F.count("event_id").alias("total_orders"),
        customers.alias("unique_customers"),
        F.round(F.sum("net_revenue_usd"), 2).cast(MONEY_TOTAL).alias("total_revenue_usd"),
        rounded_ratio(F.sum("net_revenue_usd"), customers, 2, MONEY)
        .alias("avg_revenue_per_customer_usd"),
        F.count_if(F.col("is_refunded")).alias("total_refunds"),
        pct(F.count_if(F.col("is_refunded")), F.count("event_id")).alias("refund_rate_pct"))
