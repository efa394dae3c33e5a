"""Tables derived from an order-change feed and from inserted rows.

A change feed has one row per update of an order:
``seq`` (unique, rising in commit order), ``order_id``, ``old_status``,
``new_status``, ``changed_at`` and, for invoices, the order's money columns.
A snapshot feed lacks ``old_status`` and has ``status`` instead of ``new_status``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import money
from ..functions.lifecycle import DELIVERED, entered
from ..plans.scan import SLICE_BITS, last_before


def with_old_status(snapshots: DataFrame, bits: int = SLICE_BITS) -> DataFrame:
    """Adds the status an order had before each row; NULL on its first one."""
    return last_before(
        snapshots, "seq", F.col("new_status"), "old_status", keys=["order_id"], bits=bits
    )


def status_log(changes: DataFrame) -> DataFrame:
    """A log row for every change of status; none where it stays the same."""
    return changes.filter(F.col("old_status") != F.col("new_status")).select(
        "seq", "order_id", F.col("new_status").alias("status"), "changed_at"
    )


def invoice_number(year: Column, order_id: Column) -> Column:
    """INV-<year>-<order id, six digits or more>; long ids are kept whole, not cut."""
    return F.format_string("INV-%d-%06d", year, order_id)


def new_invoices(changes: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Invoices due from changes into delivered, at most one per order, none issued twice."""
    due = (
        changes.filter(entered(F.col("old_status"), F.col("new_status"), DELIVERED))
        .groupBy("order_id")
        .agg(
            F.min_by(
                F.struct(
                    "subtotal",
                    "tax_amount",
                    "delivery_fee",
                    "discount_amount",
                    F.col("total_amount").alias("grand_total"),
                    F.col("changed_at").alias("issued_at"),
                ),
                "seq",
            ).alias("first")
        )
        .select("order_id", "first.*")
    )
    if existing is not None:
        due = due.join(existing.select("order_id"), "order_id", "left_anti")
    return due.select(
        "order_id",
        invoice_number(F.year("issued_at"), F.col("order_id")).alias("invoice_number"),
        "subtotal",
        "tax_amount",
        "delivery_fee",
        "discount_amount",
        "grand_total",
        "issued_at",
    )


def rating_sums(reviews: DataFrame, key: str, rating: str) -> DataFrame:
    """Sum and number of ratings per key: what a running average keeps."""
    return (
        reviews.filter(F.col(key).isNotNull() & F.col(rating).isNotNull())
        .groupBy(key)
        .agg(F.sum(rating).cast("bigint").alias("rating_sum"), F.count("*").alias("rating_count"))
    )


def _rating(total: Column, n: Column) -> Column:
    return money.mean(total.cast(money.COUNT), n).cast("decimal(3,2)")


def restaurant_ratings(reviews: DataFrame, restaurants: DataFrame) -> DataFrame:
    """Average food rating and number of reviews per restaurant; 0.00 and 0 if none."""
    sums = rating_sums(reviews, "restaurant_id", "food_rating")
    return restaurants.select("restaurant_id").join(sums, "restaurant_id", "left").select(
        "restaurant_id",
        F.coalesce(
            _rating(F.col("rating_sum"), F.col("rating_count")), F.lit(0).cast("decimal(3,2)")
        ).alias("avg_rating"),
        F.coalesce("rating_count", F.lit(0)).alias("total_ratings"),
    )


def agent_ratings(reviews: DataFrame, agents: DataFrame) -> DataFrame:
    """Average delivery rating per agent over reviews that give one; 0.00 if none."""
    sums = rating_sums(reviews, "agent_id", "delivery_rating")
    return agents.select("agent_id").join(sums, "agent_id", "left").select(
        "agent_id",
        F.coalesce(
            _rating(F.col("rating_sum"), F.col("rating_count")), F.lit(0).cast("decimal(3,2)")
        ).alias("avg_rating"),
    )


def coupon_usage(order_coupons: DataFrame, coupons: DataFrame) -> DataFrame:
    """Each coupon's use count after the given uses are added to it."""
    uses = order_coupons.groupBy("coupon_id").agg(F.count("*").alias("uses"))
    return coupons.select("coupon_id", "used_count").join(uses, "coupon_id", "left").select(
        "coupon_id",
        (F.col("used_count") + F.coalesce("uses", F.lit(0))).alias("used_count"),
    )


def delivered_at(changes: DataFrame) -> DataFrame:
    """The latest time each order entered delivered."""
    return (
        changes.filter(entered(F.col("old_status"), F.col("new_status"), DELIVERED))
        .groupBy("order_id")
        .agg(F.max_by("changed_at", "seq").alias("delivered_at"))
    )


def upsert(current: DataFrame, fresh: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """The next version of a table: ``columns`` taken from ``fresh`` where its key appears."""
    new = fresh.select(key, F.struct(*columns).alias("_new"))
    merged = current.join(new, key, "left")
    return merged.select(
        *[
            F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c)
            if c in columns
            else F.col(c)
            for c in current.columns
        ]
    )
