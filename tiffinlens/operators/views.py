"""The two reporting views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import money, time
from ..functions.lifecycle import CANCELLED, DELIVERED, count_if, delivery_flag
from ..plans.joins import left_lookup


def order_summary(
    orders: DataFrame,
    customers: DataFrame,
    restaurants: DataFrame,
    agents: DataFrame,
    payments: DataFrame,
    reviews: DataFrame,
) -> DataFrame:
    """One flat row per order, with names, payment, delivery time and ratings.

    Payments and reviews join first: all three are unique on ``order_id``, so one
    shuffle of orders serves both. Unique keys on every looked-up side are
    assumed; audit duplicates first.
    """
    flat = (
        orders.join(payments.select("order_id", "payment_method", "payment_status"), "order_id", "left")
        .join(reviews.select("order_id", "food_rating", "delivery_rating"), "order_id", "left")
        .join(
            customers.select(
                "customer_id",
                F.col("full_name").alias("customer_name"),
                F.col("email").alias("customer_email"),
            ),
            "customer_id",
        )
        .join(
            restaurants.select("restaurant_id", F.col("name").alias("restaurant_name"), "city"),
            "restaurant_id",
        )
    )
    named = left_lookup(
        flat, agents.select("agent_id", F.col("full_name").alias("agent_name")), "agent_id", "order_id"
    )
    return named.select(
        "order_id",
        "placed_at",
        time.month_label(time.month_number(F.col("placed_at"))).alias("order_month"),
        "customer_name",
        "customer_email",
        "restaurant_name",
        "city",
        "agent_name",
        "order_status",
        "subtotal",
        "delivery_fee",
        "discount_amount",
        "tax_amount",
        "total_amount",
        "payment_method",
        "payment_status",
        time.minutes_between(F.col("placed_at"), F.col("delivered_at")).alias(
            "delivery_duration_min"
        ),
        delivery_flag(F.col("delivered_at"), F.col("estimated_delivery")).alias("delivery_flag"),
        "food_rating",
        "delivery_rating",
    )


def daily_kpi(orders: DataFrame, approximate: bool = False) -> DataFrame:
    """Orders, revenue and customers per day.

    ``approximate`` swaps the exact distinct customer count for a sketch.
    """
    delivered = F.col("order_status") == DELIVERED
    people = F.approx_count_distinct if approximate else F.countDistinct
    return (
        orders.groupBy(F.to_date("placed_at").alias("order_date"))
        .agg(
            F.count("*").alias("total_orders"),
            count_if(delivered).alias("delivered"),
            count_if(F.col("order_status") == CANCELLED).alias("cancelled"),
            F.sum(F.when(delivered, F.col("total_amount"))).alias("revenue"),
            F.count(F.when(delivered, F.col("total_amount"))).alias("amounts"),
            people("customer_id").alias("unique_customers"),
        )
        .select(
            "order_date",
            "total_orders",
            "delivered",
            "cancelled",
            F.coalesce(F.round("revenue", 2), F.lit(0).cast(money.MONEY)).alias("daily_revenue"),
            money.mean(F.col("revenue"), F.col("amounts")).alias("avg_order_value"),
            "unique_customers",
        )
        .orderBy("order_date")
    )
