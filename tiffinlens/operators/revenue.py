"""Revenue analytics: monthly growth, commission, Pareto shares, payment methods."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import money, time
from ..functions.lifecycle import CANCELLED, DELIVERED, count_if
from ..plans.scan import running_sum_before


def monthly_revenue_growth(orders: DataFrame, delivered_only: bool = False) -> DataFrame:
    """Revenue, orders and growth per month against the previous month that has orders.

    Every status counts as revenue unless ``delivered_only``.
    """
    if delivered_only:
        orders = orders.filter(F.col("order_status") == DELIVERED)
    months = orders.groupBy(time.month_number(F.col("placed_at")).alias("month_number")).agg(
        F.sum("total_amount").alias("revenue"),
        F.count("*").alias("total_orders"),
        count_if(F.col("order_status") == CANCELLED).alias("cancelled_orders"),
    )
    # One row per calendar month: a few thousand at most, so one window task is bounded.
    previous = F.lag("revenue").over(Window.orderBy("month_number"))
    return (
        months.withColumn("previous", previous)
        .select(
            time.month_label(F.col("month_number")).alias("month"),
            F.round("revenue", 2).alias("revenue"),
            "total_orders",
            "cancelled_orders",
            money.percent(F.col("revenue") - F.col("previous"), F.col("previous")).alias(
                "mom_growth_pct"
            ),
        )
        .orderBy("month")
    )


def _delivered_revenue(orders: DataFrame) -> DataFrame:
    return (
        orders.filter(F.col("order_status") == DELIVERED)
        .groupBy("restaurant_id")
        .agg(F.sum("total_amount").alias("revenue"))
    )


def restaurant_revenue_commission(
    restaurants: DataFrame, orders: DataFrame, unique_orders: bool = False
) -> DataFrame:
    """Delivered revenue, commission and averages per restaurant that delivered anything.

    Orders are aggregated before the restaurant's columns are joined, so the join
    sees one row per restaurant. ``unique_orders`` states that ``order_id`` is a
    key of ``orders`` (audit it first): a plain count then replaces the distinct one.
    """
    n = F.count("order_id") if unique_orders else F.countDistinct("order_id")
    sales = (
        orders.filter(F.col("order_status") == DELIVERED)
        .groupBy("restaurant_id")
        .agg(
            n.alias("total_orders"),
            F.sum("total_amount").alias("revenue"),
            F.count("total_amount").alias("amounts"),
        )
    )
    return (
        sales.join(
            restaurants.select("restaurant_id", "name", "commission_pct", "avg_rating"),
            "restaurant_id",
        )
        .select(
            "restaurant_id",
            F.col("name").alias("restaurant_name"),
            "total_orders",
            F.round("revenue", 2).alias("gross_revenue"),
            F.round(F.col("revenue") * F.col("commission_pct") / F.lit(100), 2).alias(
                "platform_commission"
            ),
            money.mean(F.col("revenue"), F.col("amounts")).alias("avg_order_value"),
            F.round("avg_rating", 2).alias("avg_rating"),
        )
        .orderBy(F.desc("gross_revenue"), "restaurant_id")
    )


def restaurant_pareto(
    orders: DataFrame, restaurants: DataFrame, threshold: int | Decimal | None = None
) -> DataFrame:
    """Each restaurant's share of delivered revenue and the running share, largest first.

    Restaurants with equal revenue share one running value. ``threshold`` keeps
    only restaurants whose predecessors together stay below that percentage.
    The running sum is taken over distinct revenues in bounded slices, so it
    holds for any number of restaurants.
    """
    revenue = (
        _delivered_revenue(orders)
        .join(restaurants.select("restaurant_id", "name"), "restaurant_id")
        .withColumn("revenue", F.round("revenue", 2))
        .withColumn("position", -money.cents(F.col("revenue")))
    )
    levels = revenue.groupBy("position").agg(F.sum("revenue").alias("level_revenue"))
    levels = running_sum_before(
        levels, "position", F.col("level_revenue"), "before", total="grand_total"
    )
    shares = revenue.join(levels, "position").select(
        "name",
        "revenue",
        money.percent(F.col("revenue"), F.col("grand_total")).alias("revenue_share_pct"),
        money.percent(F.col("before") + F.col("level_revenue"), F.col("grand_total")).alias(
            "cumulative_pct"
        ),
        (F.col("before") * 100 / F.col("grand_total")).alias("before_pct"),
    )
    if threshold is not None:
        shares = shares.filter(F.col("before_pct") < F.lit(threshold))
    return shares.drop("before_pct").orderBy(F.desc("revenue"), "name")


def revenue_by_payment_method(payments: DataFrame) -> DataFrame:
    """Successful payments per method, with each method's share of all of them."""
    methods = (
        payments.filter(F.col("payment_status") == "success")
        .groupBy("payment_method")
        .agg(
            F.count("*").alias("transactions"),
            F.sum("amount").alias("total"),
            F.count("amount").alias("amounts"),
        )
    )
    # One row per payment method (a closed domain): the share window is bounded.
    everything = F.sum("total").over(Window.partitionBy())
    return methods.select(
        "payment_method",
        "transactions",
        F.round("total", 2).alias("total_revenue"),
        money.mean(F.col("total"), F.col("amounts")).alias("avg_transaction_value"),
        money.percent(F.col("total"), everything).alias("revenue_share_pct"),
    ).orderBy(F.desc("total_revenue"), "payment_method")
