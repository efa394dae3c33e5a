"""Delivery and operations: punctuality, agents, status distribution."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import money, time
from ..functions.lifecycle import DELIVERED, count_if, delivery_flag, lifecycle_rank


def on_time_vs_delayed(orders: DataFrame, reviews: DataFrame) -> DataFrame:
    """Delivered orders with both times known, by punctuality; unreviewed orders count."""
    timed = orders.filter(
        (F.col("order_status") == DELIVERED)
        & F.col("estimated_delivery").isNotNull()
        & F.col("delivered_at").isNotNull()
    ).select(
        "order_id",
        delivery_flag(F.col("delivered_at"), F.col("estimated_delivery")).alias("delivery_status"),
        time.minutes_between(F.col("placed_at"), F.col("delivered_at")).alias("minutes"),
    )
    ratings = reviews.select("order_id", "food_rating", "delivery_rating")
    return (
        timed.join(ratings, "order_id", "left")
        .groupBy("delivery_status")
        .agg(
            F.count("*").alias("orders"),
            F.sum("minutes").alias("minutes"),
            F.count("minutes").alias("minutes_n"),
            F.sum("food_rating").alias("food"),
            F.count("food_rating").alias("food_n"),
            F.sum("delivery_rating").alias("delivery"),
            F.count("delivery_rating").alias("delivery_n"),
        )
        .select(
            "delivery_status",
            "orders",
            money.mean(F.col("minutes").cast(money.COUNT), F.col("minutes_n"), 1).alias(
                "avg_delivery_min"
            ),
            money.mean(F.col("food").cast(money.COUNT), F.col("food_n")).alias("avg_food_rating"),
            money.mean(F.col("delivery").cast(money.COUNT), F.col("delivery_n")).alias(
                "avg_delivery_rating"
            ),
        )
    )


def agent_leaderboard(agents: DataFrame, orders: DataFrame) -> DataFrame:
    """Deliveries, speed, rating and punctuality per agent, best rated first.

    An order without an estimate is neither late nor on time but stays in the
    denominator of the on-time percentage.
    """
    late = F.col("delivered_at") > F.col("estimated_delivery")
    on_time = F.col("delivered_at") <= F.col("estimated_delivery")
    minutes = time.minutes_between(F.col("placed_at"), F.col("delivered_at"))
    work = (
        orders.filter(
            (F.col("order_status") == DELIVERED)
            & F.col("delivered_at").isNotNull()
            & F.col("agent_id").isNotNull()
        )
        .groupBy("agent_id")
        .agg(
            F.count("order_id").alias("total_deliveries"),
            F.sum(minutes).alias("minutes"),
            F.count(minutes).alias("minutes_n"),
            count_if(late).alias("late_deliveries"),
            count_if(on_time).alias("on_time"),
            F.count("*").alias("n"),
        )
    )
    return (
        work.join(agents.select("agent_id", "full_name", "vehicle_type", "avg_rating"), "agent_id")
        .select(
            "agent_id",
            "full_name",
            "vehicle_type",
            "total_deliveries",
            money.mean(F.col("minutes").cast(money.COUNT), F.col("minutes_n"), 1).alias(
                "avg_delivery_min"
            ),
            F.round("avg_rating", 2).alias("avg_rating"),
            "late_deliveries",
            money.percent_of_count(F.col("on_time"), F.col("n"), 1).alias("on_time_pct"),
        )
        .orderBy(F.desc("avg_rating"), F.desc("on_time_pct"), "agent_id")
    )


def order_status_funnel(orders: DataFrame) -> DataFrame:
    """How many orders stand in each status now, in lifecycle order."""
    counts = orders.groupBy("order_status").agg(F.count("*").alias("orders"))
    # One row per status (a closed domain): the share window is bounded.
    everything = F.sum("orders").over(Window.partitionBy())
    return counts.select(
        "order_status",
        "orders",
        money.percent_of_count(F.col("orders"), everything).alias("pct_of_total"),
    ).orderBy(lifecycle_rank(F.col("order_status")), "order_status")
