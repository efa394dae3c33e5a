"""Coupons and cancellations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import money
from ..functions.lifecycle import CANCELLED, DELIVERED


def coupon_effectiveness(
    coupons: DataFrame, order_coupons: DataFrame, orders: DataFrame
) -> DataFrame:
    """What each coupon gave away on delivered orders and what it brought in."""
    delivered = orders.filter(F.col("order_status") == DELIVERED).select("order_id", "total_amount")
    use = (
        order_coupons.select("order_id", "coupon_id", "discount_applied")
        .join(delivered, "order_id")
        .groupBy("coupon_id")
        .agg(
            F.count("order_id").alias("times_used"),
            F.sum("discount_applied").alias("discount"),
            F.sum("total_amount").alias("revenue"),
            F.count("total_amount").alias("amounts"),
            F.sum(F.col("total_amount") + F.col("discount_applied")).alias("gross"),
        )
    )
    return (
        use.join(coupons.select("coupon_id", "code", "discount_type", "discount_value"), "coupon_id")
        .select(
            "code",
            "discount_type",
            "discount_value",
            "times_used",
            F.round("discount", 2).alias("total_discount_given"),
            F.round("revenue", 2).alias("revenue_generated"),
            money.mean(F.col("revenue"), F.col("amounts")).alias("avg_order_value_with_coupon"),
            money.percent(F.col("discount"), F.col("gross")).alias("discount_to_gross_pct"),
        )
        .orderBy(F.desc("revenue_generated"), "code")
    )


def cancellation_impact(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """One row on cancelled orders that have a payment, against the number of all orders.

    The number of all orders is a scalar subquery over a column-free scan.
    """
    cancelled = orders.filter(F.col("order_status") == CANCELLED).select("order_id")
    every_order = orders.select(F.count("*")).scalar()
    return (
        cancelled.join(payments.select("order_id", "amount", "refund_amount"), "order_id")
        .agg(
            F.count("*").alias("cancelled_orders"),
            F.sum("amount").alias("at_risk"),
            F.count("amount").alias("amounts"),
            F.sum("refund_amount").alias("refunded"),
        )
        .select(
            "cancelled_orders",
            F.round("at_risk", 2).alias("revenue_at_risk"),
            F.round("refunded", 2).alias("total_refunded"),
            money.mean(F.col("at_risk"), F.col("amounts")).alias("avg_cancelled_order_value"),
            money.percent_of_count(F.col("cancelled_orders"), every_order).alias(
                "cancellation_rate_pct"
            ),
        )
    )
