"""Analytics over time: cohorts, lifetime-value spread, status durations, strict histories, positions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import money, time
from ..functions.lifecycle import (
    CANCELLED,
    DELIVERED,
    ORDER_STATUSES,
    TERMINAL_STATUSES,
    is_status,
    lifecycle_rank,
)
from ..plans.joins import hot_lookup
from ..plans.scan import LEVEL_BITS, SLICE_BITS, first_after, levels, running_sum_before, slice_of
from .customers import customer_values, segment_label
from .intake import NO_ORDER, ORDER_ENDED, STATUS_OK


def cohorts_by_registration(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Buyers and delivered revenue by month of registration and months since.

    Orders shrink to one row per customer and month before customers are joined,
    so buyers are counted without a distinct.
    """
    monthly = (
        orders.filter(F.col("order_status") == DELIVERED)
        .groupBy("customer_id", time.month_number(F.col("placed_at")).alias("order_month"))
        .agg(F.sum("total_amount").alias("revenue"))
    )
    joined = customers.select(
        "customer_id", time.month_number(F.col("created_at")).alias("cohort_number")
    )
    return (
        monthly.join(joined, "customer_id")
        .groupBy("cohort_number", (F.col("order_month") - F.col("cohort_number")).alias("months_since"))
        .agg(F.count("*").alias("buyers"), F.sum("revenue").alias("revenue"))
        .select(
            time.month_label(F.col("cohort_number")).alias("cohort_month"),
            "months_since",
            "buyers",
            "revenue",
        )
        .orderBy("cohort_month", "months_since")
    )


def ltv_distribution(
    orders: DataFrame, percentiles: Sequence[int] = (25, 50, 75, 90), bits: int = SLICE_BITS
) -> DataFrame:
    """Spread of lifetime value per customer segment: smallest, largest and exact percentiles.

    A percentile is the smallest value that at least that share of the segment's
    customers do not exceed. Customers are counted per distinct value first, and ranks
    come from bounded slices: no group is gathered in memory.
    """
    levels = (
        customer_values(orders)
        .select(
            segment_label(F.col("order_count")).alias("segment"),
            money.cents(F.col("lifetime_value")).alias("value"),
        )
        .groupBy("segment", "value")
        .agg(F.count("*").alias("n"))
    )
    ranked = running_sum_before(
        levels, "value", F.col("n"), "before", ["segment"], bits, total="customers"
    )

    def at(percentile: int) -> Column:
        rank = F.ceil(F.col("customers") * F.lit(percentile) / F.lit(100).cast("decimal(3,0)"))
        hit = (F.col("before") < rank) & (rank <= F.col("before") + F.col("n"))
        return F.max(F.when(hit, F.col("value")))

    def amount(column: str) -> Column:
        return (F.col(column).cast("decimal(20,0)") / F.lit(100)).cast("decimal(20,2)").alias(column)

    spread = ranked.groupBy("segment").agg(
        F.sum("n").alias("customers"),
        F.min("value").alias("min_ltv"),
        *[at(p).alias(f"p{p}_ltv") for p in percentiles],
        F.max("value").alias("max_ltv"),
    )
    return spread.select(
        "segment",
        "customers",
        amount("min_ltv"),
        *[amount(f"p{p}_ltv") for p in percentiles],
        amount("max_ltv"),
    )


def status_durations(log: DataFrame, bits: int = SLICE_BITS) -> DataFrame:
    """Log rows (log_id, order_id, status, changed_at) with the time the status was left, NULL if open."""
    ended = first_after(log, "log_id", F.col("changed_at"), "left_at", ["order_id"], bits)
    return ended.withColumn(
        "minutes", time.minutes_between(F.col("changed_at"), F.col("left_at"))
    )


def _limits(limits: DataFrame) -> DataFrame:
    """One limit per status of the lifecycle, the tightest: seven rows at most, so safe to broadcast."""
    known = limits.filter(F.col("status").isin(*ORDER_STATUSES))
    return F.broadcast(known.groupBy("status").agg(F.min("limit_minutes").alias("limit_minutes")))


def sla_breaches(log: DataFrame, limits: DataFrame, bits: int = SLICE_BITS) -> DataFrame:
    """Finished stays longer than the status's limit (status, limit_minutes)."""
    return (
        status_durations(log, bits)
        .join(_limits(limits), "status")
        .filter(F.col("minutes") > F.col("limit_minutes"))
        .select("log_id", "order_id", "status", "changed_at", "minutes", "limit_minutes")
    )


def sla_report(log: DataFrame, limits: DataFrame, bits: int = SLICE_BITS) -> DataFrame:
    """Per status with a limit: finished stays, breaches, breach percentage, mean and longest stay."""
    stays = status_durations(log, bits).filter(F.col("minutes").isNotNull()).join(_limits(limits), "status")
    over = F.col("minutes") > F.col("limit_minutes")
    return (
        stays.groupBy("status", "limit_minutes")
        .agg(
            F.count("*").alias("stays"),
            F.count(F.when(over, F.lit(1))).alias("breaches"),
            F.sum("minutes").alias("total"),
            F.max("minutes").alias("longest_min"),
        )
        .select(
            "status",
            "limit_minutes",
            "stays",
            "breaches",
            money.percent_of_count(F.col("breaches"), F.col("stays")).alias("breach_pct"),
            money.mean(F.col("total").cast(money.COUNT), F.col("stays"), 1).alias("avg_min"),
            "longest_min",
        )
        .orderBy(lifecycle_rank(F.col("status")))
    )


def cumulative_funnel(
    log: DataFrame, stages: Sequence[str] = ("placed", "confirmed", "delivered")
) -> DataFrame:
    """Orders that ever reached each stage, against those that reached the first."""
    per_order = log.groupBy("order_id").agg(
        *[F.max((F.col("status") == s).cast("int")).alias(s) for s in stages]
    )
    totals = per_order.agg(*[F.coalesce(F.sum(s), F.lit(0)).alias(s) for s in stages])
    # One row: the funnel is read off it sideways.
    first = totals.withColumn("first_stage", F.col(stages[0]))
    return (
        first.unpivot(["first_stage"], list(stages), "stage", "orders")
        .select(
            "stage",
            "orders",
            money.percent_of_count(F.col("orders"), F.col("first_stage")).alias("pct_of_first"),
        )
        .orderBy(lifecycle_rank(F.col("stage")))
    )


def latest_agent_position(locations: DataFrame) -> DataFrame:
    """Each agent's newest position; on equal times the higher ``location_id`` wins."""
    newest = F.max_by(
        F.struct("latitude", "longitude", "recorded_at", "order_id"),
        F.struct("recorded_at", "location_id"),
    )
    return locations.groupBy("agent_id").agg(newest.alias("p")).select("agent_id", "p.*")


_DELIVERED_INDEX = ORDER_STATUSES.index(DELIVERED)
_CANCELLED_INDEX = ORDER_STATUSES.index(CANCELLED)


def _standing_still(state: str) -> str:
    nothing = "cast(array() as array<struct<seq:bigint,state:int>>)"
    return f"named_struct('state', {state}, 'accepted', {nothing})"


# Where every starting stage that is not final would end: a table of outcomes.
_STARTS = f"array({', '.join(_standing_still(str(s)) for s in range(_DELIVERED_INDEX))})"

# One strict step: to the next stage, or to cancelled from any stage that is not final.
_STEP = f"""
    case when so_far.state < {_DELIVERED_INDEX}
              and (part.state = so_far.state + 1 or part.state = {_CANCELLED_INDEX})
         then named_struct('state', part.state, 'accepted', concat(so_far.accepted, array(part)))
         else so_far end"""

# Many steps at once, through a part's table of outcomes.
_LEAP = f"""
    case when so_far.state between 0 and {_DELIVERED_INDEX - 1}
         then named_struct('state', part.moves[so_far.state].state,
                           'accepted', concat(so_far.accepted, part.moves[so_far.state].accepted))
         else so_far end"""


def _outcomes(parts: str, step: str) -> str:
    return f"aggregate({parts}, {_STARTS}, (table, part) -> transform(table, so_far -> {step}))"


def strict_transitions(
    orders: DataFrame, updates: DataFrame, bits: int = SLICE_BITS
) -> DataFrame:
    """Replies to updates when stages may not be skipped or reversed.

    Replaying an order is sequential, but a run of updates is a function from
    starting stage to final stage, and such functions compose. So updates are
    replayed in slices of ``seq`` for every starting stage, and slices composed
    level by level as in ``plans.scan``: 2**16 to a list at most, however dense or
    sparse ``seq`` is. An order accepts at most six updates, so the lists carried
    along stay tiny.
    """
    known = updates.filter(is_status(F.col("new_status"), *ORDER_STATUSES)).select(
        "order_id",
        slice_of(F.col("seq"), bits).alias("slice"),
        F.struct(
            F.col("seq").cast("bigint").alias("seq"),
            (lifecycle_rank(F.col("new_status")) - 1).alias("state"),
        ).alias("part"),
    )
    in_order = F.array_sort(F.collect_list("part")).alias("parts")
    step = _STEP
    for _ in levels(bits):
        known = (
            known.groupBy("order_id", "slice")
            .agg(in_order)
            .select(
                "order_id",
                slice_of(F.col("slice"), LEVEL_BITS).alias("up"),
                F.expr(f"named_struct('at', slice, 'moves', {_outcomes('parts', step)})").alias("part"),
            )
            .withColumnRenamed("up", "slice")
        )
        step = _LEAP
    histories = known.groupBy("order_id").agg(in_order)
    start = (lifecycle_rank(F.col("order_status")) - 1).alias("start")
    played = (
        orders.select("order_id", F.col("order_status").alias("first_status"), start)
        .join(histories, "order_id", "left")
        .selectExpr(
            "order_id",
            "first_status",
            f"aggregate(parts, {_standing_still('start')}, (so_far, part) -> {_LEAP}).accepted"
            " as accepted_moves",
        )
    )
    earlier = F.expr("try_element_at(filter(accepted_moves, m -> m.seq < seq), -1).state")
    names = F.array(*[F.lit(s) for s in ORDER_STATUSES])
    standing = F.coalesce(F.get(names, earlier), F.col("first_status"))
    accepted = F.expr("coalesce(exists(accepted_moves, m -> m.seq = seq), false)")
    new = F.coalesce("new_status", F.lit("NULL"))
    message = (
        F.when(F.col("first_status").isNull(), F.lit(NO_ORDER))
        .when(F.col("accepted"), F.concat(F.lit(STATUS_OK), new, F.lit(".")))
        .when(
            F.col("standing").isin(*TERMINAL_STATUSES),
            F.concat(F.lit(ORDER_ENDED), F.col("standing"), F.lit(".")),
        )
        .otherwise(
            F.concat(F.lit("Cannot move from "), F.col("standing"), F.lit(" to "), new, F.lit("."))
        )
    )
    return (
        hot_lookup(updates, played, "order_id")
        .withColumn("accepted", accepted)
        .withColumn("standing", standing)
        .select("seq", "order_id", "new_status", "accepted", message.alias("message"))
    )
