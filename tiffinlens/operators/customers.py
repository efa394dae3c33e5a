"""Customer behaviour: segments, return gap, best customers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import money
from ..functions.lifecycle import DELIVERED

# The three segment labels.
ONE_TIME = "One-time buyer"
OCCASIONAL = "Occasional (2–3 orders)"
LOYAL = "Loyal (4+ orders)"


def segment_label(order_count: Column) -> Column:
    return (
        F.when(order_count == 1, F.lit(ONE_TIME))
        .when(order_count <= 3, F.lit(OCCASIONAL))
        .otherwise(F.lit(LOYAL))
    )


def customer_values(orders: DataFrame) -> DataFrame:
    """Delivered orders and their value per customer."""
    return (
        orders.filter(F.col("order_status") == DELIVERED)
        .groupBy("customer_id")
        .agg(
            F.count("order_id").alias("order_count"),
            F.round(F.sum("total_amount"), 2).alias("lifetime_value"),
        )
    )


def customer_segments(orders: DataFrame) -> DataFrame:
    """Customers by number of delivered orders: one, two or three, four and more."""
    segments = (
        customer_values(orders)
        .groupBy(segment_label(F.col("order_count")).alias("segment"))
        .agg(
            F.count("*").alias("customer_count"),
            F.sum("lifetime_value").alias("value"),
            F.sum("order_count").alias("orders"),
        )
    )
    # Three rows: the share window is bounded.
    everyone = F.sum("customer_count").over(Window.partitionBy())
    return segments.select(
        "segment",
        "customer_count",
        money.mean(F.col("value"), F.col("customer_count")).alias("avg_ltv"),
        money.mean(F.col("orders").cast(money.COUNT), F.col("customer_count"), 1).alias("avg_orders"),
        money.percent_of_count(F.col("customer_count"), everyone).alias("pct_of_customers"),
    ).orderBy(F.desc("avg_ltv"), "segment")


def repeat_purchase_gap(orders: DataFrame) -> DataFrame:
    """Days from a customer's first to second delivered order; always one row.

    ``row_number() <= 2`` lets Spark cut every map task's rows to two per customer
    before the shuffle (WindowGroupLimit), so a hot customer stays two rows per task.
    """
    by_time = Window.partitionBy("customer_id").orderBy("placed_at", "order_id")
    firsts = (
        orders.filter(F.col("order_status") == DELIVERED)
        .select("customer_id", "order_id", "placed_at")
        .withColumn("rn", F.row_number().over(by_time))
        .filter(F.col("rn") <= 2)
    )
    gaps = (
        firsts.groupBy("customer_id")
        .agg(
            F.min("placed_at").alias("first"),
            F.max("placed_at").alias("second"),
            F.count("*").alias("n"),
        )
        .filter(F.col("n") == 2)
        .select(F.datediff("second", "first").alias("days"))
    )
    return gaps.agg(
        F.sum("days").alias("days"),
        F.min("days").alias("min_days"),
        F.max("days").alias("max_days"),
        F.count("*").alias("repeat_customers"),
    ).select(
        money.mean(F.col("days").cast(money.COUNT), F.col("repeat_customers"), 1).alias(
            "avg_days_to_return"
        ),
        "min_days",
        "max_days",
        "repeat_customers",
    )


def top_customers_ltv(customers: DataFrame, orders: DataFrame, n: int = 5) -> DataFrame:
    """The n customers with the highest delivered value; ties go to the lower id.

    Orders shrink to one row per customer, customers are joined to those, and
    the cut comes last: a reference that points nowhere takes no place in the list.
    """
    values = (
        orders.filter(F.col("order_status") == DELIVERED)
        .groupBy("customer_id")
        .agg(
            F.count("order_id").alias("total_orders"),
            F.sum("total_amount").alias("value"),
            F.count("total_amount").alias("amounts"),
            F.max("placed_at").alias("last_order_date"),
        )
    )
    return (
        customers.select("customer_id", "full_name", "email")
        .join(values, "customer_id")
        .orderBy(F.desc("value"), "customer_id")
        .limit(n)
        .select(
            "customer_id",
            "full_name",
            "email",
            "total_orders",
            F.round("value", 2).alias("lifetime_value"),
            money.mean(F.col("value"), F.col("amounts")).alias("avg_order_value"),
            "last_order_date",
        )
    )
