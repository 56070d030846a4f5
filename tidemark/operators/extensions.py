"""Extensions: honest variants of two reference metrics and nothing more."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.metrics import PERCENT
from tidemark.operators.intermediate import (
    LOYALTY_THRESHOLD, channel_modes, loyalty_rollup, order_partials,
)
from tidemark.operators.marts import MONTH_KEYS
from tidemark.operators.staging import orders


def ext_primary_channel_mode(events: DataFrame) -> DataFrame:
    """The customer's most frequent channel (lowest name on a tie) next to
    the model's alphabetical-max 'primary_channel', from order counts per
    customer and channel."""
    return channel_modes(orders(events).groupBy("customer_id", "channel").agg(
        F.count(F.lit(1)).alias("n_rows")))


def ext_loyal_revenue_share(events: DataFrame, threshold: int = LOYALTY_THRESHOLD) -> DataFrame:
    """Loyal customers' share of each month's revenue (the model's
    loyal_customer_pct is a share of customers)."""
    cust = loyalty_rollup(orders(events), MONTH_KEYS, order_partials("rev_sum"), threshold)
    total = F.sum("rev_sum")
    loyal = F.sum(F.when(F.col("is_loyal"), F.col("rev_sum")))
    return cust.groupBy("order_month").agg(
        F.round(total, 2).cast("decimal(22,2)").alias("total_revenue_usd"),
        F.round(F.coalesce(loyal, F.lit(0)), 2).cast("decimal(22,2)").alias("loyal_revenue_usd"),
        F.round(F.coalesce(loyal, F.lit(0)).cast("decimal(22,4)")
                / F.nullif(total, F.lit(0)).cast("decimal(22,4)") * F.lit(100), 2)
        .cast(PERCENT).alias("loyal_revenue_pct"))
