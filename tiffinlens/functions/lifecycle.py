"""Order lifecycle and the other closed value domains."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The closed domains of the data model, in lifecycle order.
ORDER_STATUSES = (
    "placed",
    "confirmed",
    "preparing",
    "ready_for_pickup",
    "out_for_delivery",
    "delivered",
    "cancelled",
)
TERMINAL_STATUSES = ("delivered", "cancelled")
PAYMENT_METHODS = ("upi", "card", "netbanking", "cod", "wallet")
PAYMENT_STATUSES = ("pending", "success", "failed", "refunded")
DISCOUNT_TYPES = ("flat", "percentage")
VEHICLE_TYPES = ("bike", "bicycle", "scooter")

DELIVERED = "delivered"
CANCELLED = "cancelled"


def lifecycle_rank(status: Column) -> Column:
    """1-based place in the lifecycle; 0 for anything else, NULL included."""
    stages = F.array(*[F.lit(s) for s in ORDER_STATUSES])
    return F.coalesce(F.array_position(stages, status), F.lit(0)).cast("int")


def is_status(status: Column, *wanted: str) -> Column:
    """True or False, never NULL."""
    return F.coalesce(status.isin(*wanted), F.lit(False))


def entered(old: Column, new: Column, status: str) -> Column:
    """True where a change moves an order into ``status`` from another one."""
    return F.coalesce((new == status) & (old != status), F.lit(False))


def count_if(condition: Column) -> Column:
    """Rows where the condition holds: 0, not NULL, when none does."""
    return F.count(F.when(condition, F.lit(1)))


def delivery_flag(delivered_at: Column, estimated_delivery: Column) -> Column:
    """A missing time on either side counts as Delayed."""
    return F.when(delivered_at <= estimated_delivery, F.lit("On-time")).otherwise(F.lit("Delayed"))
