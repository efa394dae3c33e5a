"""Batch intake: place orders, update statuses, confirm payments, assign agents.

Each job takes a DataFrame of requests with a unique, rising ``seq`` and gives
what handling them one by one in ``seq`` order would give. Serial rules become
aggregates per key (the first terminal update, the first confirmation, the
first request for an agent), which combine before they shuffle; only coupon
limits and order numbers need an order, and those use bounded slices.
Replies carry ``accepted`` and the message the caller gets.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import money, time
from ..functions.lifecycle import (
    DELIVERED,
    ORDER_STATUSES,
    TERMINAL_STATUSES,
    entered,
    is_status,
)
from ..plans.joins import hot_lookup
from ..plans.lineage import settle as settle_frame
from ..plans.scan import SLICE_BITS, last_before, running_sum_before
from ..schemas import SUBTOTAL_TAX
from .changefeed import status_log, upsert

# Charges and replies.
DELIVERY_FEE = "30.00"
UNCAPPED_DISCOUNT = "9999"
DELIVERY_PROMISE = "INTERVAL 45 MINUTES"
CLOSED = "Restaurant is closed or inactive."
PLACED_OK = "Order placed successfully. Order ID: "
NO_ORDER = "Order not found."
ORDER_ENDED = "Cannot update. Order already "
STATUS_OK = "Status updated to "
NO_PAYMENT = "Payment record not found."
PAYMENT_DONE = "Payment already "
PAYMENT_OK = "Payment confirmed and order status updated."
NO_AGENT = "Agent not found or inactive."
AGENT_BUSY = "Agent is currently unavailable."
ASSIGNED_OK = "Agent %d assigned to order %d."

# Ours: a store with a closed status domain would raise an error instead.
UNKNOWN_STATUS = "Unknown status "

_NO_DISCOUNT = "0.00"


@dataclass(frozen=True)
class PlacedOrders:
    """What a batch of order requests leads to."""

    orders: DataFrame
    order_items: DataFrame
    status_log: DataFrame
    payments: DataFrame
    order_coupons: DataFrame
    replies: DataFrame


def _amount(text: str) -> Column:
    return F.lit(text).cast(money.MONEY)


def open_requests(requests: DataFrame, restaurants: DataFrame) -> DataFrame:
    """Adds ``is_open``: the restaurant is active and the request falls in its hours, ends included."""
    hours = restaurants.select("restaurant_id", "is_active", "opening_time", "closing_time")
    now = time.seconds_of_day(F.col("requested_at"))
    is_open = (F.col("is_active") == 1) & now.between(F.col("opening_time"), F.col("closing_time"))
    return (
        requests.join(hours, "restaurant_id", "left")
        .withColumn("is_open", F.coalesce(is_open, F.lit(False)))
        .drop("is_active", "opening_time", "closing_time")
    )


def cart_subtotals(cart: DataFrame) -> DataFrame:
    """Sum of quantity times snapshot price per request."""
    return cart.groupBy("seq").agg(
        F.sum(F.col("quantity") * F.col("unit_price")).cast(money.MONEY).alias("cart_total")
    )


def _code_key(code: Column) -> Column:
    """Codes match whatever their case, accents and trailing blanks."""
    return F.collate(code, "UNICODE_CI_AI_RTRIM")


def grant_coupons(
    requests: DataFrame,
    coupons: DataFrame,
    enforce_min_order: bool = False,
    bits: int = SLICE_BITS,
) -> DataFrame:
    """The coupon each open request may use, by ``seq``; a code that fails is passed over silently.

    A limited coupon goes to the first requests in ``seq`` order until its limit
    is reached. Only those requests are numbered; unlimited coupons skip it.
    """
    known = coupons.filter(
        (F.col("is_active") == 1)
        & (F.col("usage_limit").isNull() | (F.col("used_count") < F.col("usage_limit")))
    ).select(
        _code_key(F.col("code")).alias("code_key"),
        "coupon_id",
        "discount_type",
        "discount_value",
        "max_discount",
        "min_order_value",
        "valid_from",
        "valid_until",
        (F.col("usage_limit") - F.col("used_count")).alias("uses_left"),
    )
    today = F.to_date("requested_at")
    wanting = (
        requests.filter(F.col("is_open") & F.col("coupon_code").isNotNull() & (F.col("coupon_code") != ""))
        .withColumn("code_key", _code_key(F.col("coupon_code")))
        .join(known, "code_key")
        .filter(today.between(F.col("valid_from"), F.col("valid_until")))
    )
    if enforce_min_order:
        wanting = wanting.filter(F.col("subtotal") >= F.col("min_order_value"))
    wanting = wanting.select(
        "seq", "coupon_id", "discount_type", "discount_value", "max_discount", "uses_left"
    )
    unlimited = wanting.filter(F.col("uses_left").isNull())
    limited = running_sum_before(
        wanting.filter(F.col("uses_left").isNotNull()),
        "seq",
        F.lit(1),
        "used_before",
        keys=["coupon_id"],
        bits=bits,
    ).filter(F.col("used_before") < F.col("uses_left"))
    return unlimited.unionByName(limited.drop("used_before")).drop("uses_left")


def discount(subtotal: Column) -> Column:
    """Flat value, or a percentage of the subtotal up to the coupon's cap; 0 without a coupon."""
    share = subtotal * F.col("discount_value") / F.lit(100)
    cap = F.coalesce(F.col("max_discount"), _amount(UNCAPPED_DISCOUNT))
    value = F.when(F.col("discount_type") == "flat", F.col("discount_value")).otherwise(
        F.when(share.isNotNull(), F.least(share, cap))
    )
    rounded = F.round(value, 2).cast(money.MONEY)
    return F.when(F.col("coupon_id").isNull(), _amount(_NO_DISCOUNT)).otherwise(rounded)


def priced_requests(
    checked: DataFrame,
    coupons: DataFrame,
    cart: DataFrame | None = None,
    enforce_min_order: bool = False,
    bits: int = SLICE_BITS,
) -> DataFrame:
    """Open-checked requests with subtotal, coupon, discount, fee, tax and total."""
    if cart is None:
        filled = checked.withColumn("subtotal", _amount(_NO_DISCOUNT))
    else:
        filled = (
            checked.join(cart_subtotals(cart), "seq", "left")
            .withColumn("subtotal", F.coalesce("cart_total", _amount(_NO_DISCOUNT)))
            .drop("cart_total")
        )
    # Carts are only needed to grant coupons where a least order value is asked for.
    granted = grant_coupons(filled if enforce_min_order else checked, coupons, enforce_min_order, bits)
    subtotal = F.col("subtotal")
    return (
        filled.join(granted, "seq", "left")
        .withColumn("discount_amount", discount(subtotal))
        .withColumn("delivery_fee", _amount(DELIVERY_FEE))
        .withColumn(
            "tax_amount", F.round(subtotal * F.lit(SUBTOTAL_TAX).cast("decimal(3,2)"), 2).cast(money.MONEY)
        )
        .withColumn(
            "total_amount",
            (
                subtotal + F.col("delivery_fee") + F.col("tax_amount") - F.col("discount_amount")
            ).cast(money.MONEY),
        )
        .drop("discount_type", "discount_value", "max_discount")
    )


def place_orders(
    requests: DataFrame,
    restaurants: DataFrame,
    coupons: DataFrame,
    cart: DataFrame | None = None,
    first_order_id: int = 1,
    enforce_min_order: bool = False,
    settle: bool = True,
    bits: int = SLICE_BITS,
) -> PlacedOrders:
    """Orders, lines, log, pending payments and coupon uses for requests at open restaurants.

    ``requests``: seq, customer_id, restaurant_id, address_id, payment_method,
    special_notes, coupon_code, requested_at. ``cart``: seq, item_id, quantity,
    unit_price; without it every subtotal is 0. Order ids follow ``seq`` without
    gaps from ``first_order_id``. ``settle`` checkpoints the checked and the priced
    requests, which several results draw on; leave it off when only one is used.
    """
    checked = open_requests(requests, restaurants)
    if settle:
        checked = settle_frame(checked)
    priced = priced_requests(checked, coupons, cart, enforce_min_order, bits)
    opened = checked.filter("is_open").select("seq")
    numbers = running_sum_before(opened, "seq", F.lit(1), "earlier", bits=bits).select(
        "seq", (F.col("earlier") + F.lit(first_order_id)).alias("order_id")
    )
    priced = priced.join(numbers, "seq", "left")
    if settle:
        priced = settle_frame(priced)
    numbered = priced.filter("is_open")

    orders = numbered.select(
        "order_id",
        "customer_id",
        "restaurant_id",
        F.lit(None).cast("bigint").alias("agent_id"),
        F.col("address_id").alias("delivery_address_id"),
        F.lit("placed").alias("order_status"),
        "subtotal",
        "delivery_fee",
        "discount_amount",
        "tax_amount",
        "total_amount",
        F.col("special_notes").alias("special_instructions"),
        (F.col("requested_at") + F.expr(DELIVERY_PROMISE)).alias("estimated_delivery"),
        F.col("requested_at").alias("placed_at"),
        F.lit(None).cast("timestamp_ntz").alias("delivered_at"),
    )
    log = numbered.select(
        "order_id",
        F.lit("placed").alias("status"),
        F.col("requested_at").alias("changed_at"),
        F.lit(None).cast("string").alias("note"),
    )
    payments = numbered.select(
        "order_id",
        "payment_method",
        F.lit("pending").alias("payment_status"),
        F.col("total_amount").alias("amount"),
    )
    uses = numbered.filter(F.col("coupon_id").isNotNull()).select(
        "order_id", "coupon_id", F.col("discount_amount").alias("discount_applied")
    )
    replies = priced.select(
        "seq",
        F.col("is_open").alias("accepted"),
        "order_id",
        F.when(
            F.col("is_open"), F.concat(F.lit(PLACED_OK), F.col("order_id").cast("string"))
        ).otherwise(F.lit(CLOSED)).alias("message"),
    )
    if cart is None:
        lines = numbered.sparkSession.createDataFrame(
            [],
            "order_id bigint, item_id bigint, quantity int, unit_price decimal(10,2), item_total decimal(10,2)",
        )
    else:
        lines = hot_lookup(cart, numbered.select("seq", "order_id"), "seq", "inner").select(
            "order_id",
            "item_id",
            "quantity",
            "unit_price",
            (F.col("quantity") * F.col("unit_price")).cast(money.MONEY).alias("item_total"),
        )
    return PlacedOrders(orders, lines, log, payments, uses, replies)


@dataclass(frozen=True)
class StatusUpdates:
    """What a batch of status updates leads to."""

    orders: DataFrame
    changes: DataFrame
    log: DataFrame
    notes: DataFrame
    replies: DataFrame


# Columns of an order that its invoice repeats.
BILLED = ("subtotal", "tax_amount", "delivery_fee", "discount_amount", "total_amount")


def judge_updates(orders: DataFrame, updates: DataFrame) -> DataFrame:
    """Adds ``accepted`` and ``message`` to updates (seq, order_id, new_status, note, changed_at).

    An order that is or becomes terminal takes no further update. An unknown
    status is refused and does not end the order.
    """
    new = F.col("new_status")
    first_end = (
        updates.filter(is_status(new, *TERMINAL_STATUSES))
        .groupBy("order_id")
        .agg(F.min(F.struct("seq", "new_status")).alias("ending"))
    )
    billed = [c for c in BILLED if c in orders.columns]
    standing = orders.select("order_id", F.col("order_status").alias("current_status"), *billed).join(
        first_end, "order_id", "left"
    )
    ended = F.when(
        is_status(F.col("current_status"), *TERMINAL_STATUSES), F.col("current_status")
    ).when(F.col("ending.seq") < F.col("seq"), F.col("ending.new_status"))
    message = (
        F.when(F.col("current_status").isNull(), F.lit(NO_ORDER))
        .when(ended.isNotNull(), F.concat(F.lit(ORDER_ENDED), ended, F.lit(".")))
        .when(
            ~is_status(new, *ORDER_STATUSES),
            F.concat(F.lit(UNKNOWN_STATUS), F.coalesce(new, F.lit("NULL")), F.lit(".")),
        )
    )
    return (
        hot_lookup(updates, standing, "order_id")
        .withColumn("refusal", message)
        .withColumn("accepted", F.col("refusal").isNull())
        .withColumn(
            "message",
            F.coalesce("refusal", F.concat(F.lit(STATUS_OK), new, F.lit("."))),
        )
        .drop("refusal", "ending")
    )


def accepted_changes(judged: DataFrame, bits: int = SLICE_BITS) -> DataFrame:
    """The change feed of accepted updates: the old status is the update before, or the order's own."""
    accepted = judged.filter("accepted").drop("accepted", "message")
    return (
        last_before(accepted, "seq", F.col("new_status"), "earlier", keys=["order_id"], bits=bits)
        .withColumn("old_status", F.coalesce("earlier", "current_status"))
        .drop("earlier", "current_status")
    )


def placed_notes(changes: DataFrame, bits: int = SLICE_BITS) -> DataFrame:
    """Notes by the log row they end on: (order_id, log_seq, note).

    A note goes to the order's newest log row. That is the row of the latest
    real change so far; ``log_seq`` is NULL where the batch made none yet, and
    the note then belongs to the newest row logged before the batch.
    A later note on the same row replaces an earlier one.
    """
    logged = F.when(F.col("old_status") != F.col("new_status"), F.col("seq"))
    rows = last_before(
        changes.withColumn("logged", logged), "seq", F.col("logged"), "before", ["order_id"], bits
    )
    return (
        rows.filter(F.col("note") != "")
        .groupBy("order_id", F.coalesce("logged", "before").alias("log_seq"))
        .agg(F.max_by("note", "seq").alias("note"))
    )


def noted_log(changes: DataFrame, notes: DataFrame) -> DataFrame:
    """New log rows (seq, order_id, status, changed_at, note) with the notes that end on them."""
    mine = notes.filter(F.col("log_seq").isNotNull()).select(F.col("log_seq").alias("seq"), "note")
    return status_log(changes).join(mine, "seq", "left")


def annotate_log(log: DataFrame, notes: DataFrame) -> DataFrame:
    """The next version of the log before the batch: notes without a new row go to each order's newest.

    ``log`` has log_id, order_id and note; an order without any row takes no note.
    """
    newest = log.groupBy("order_id").agg(F.max("log_id").alias("log_id"))
    late = notes.filter(F.col("log_seq").isNull()).select("order_id", F.col("note").alias("_note"))
    placed = newest.join(late, "order_id").select("log_id", "_note")
    return log.join(placed, "log_id", "left").select(
        *[F.coalesce("_note", "note").alias(c) if c == "note" else F.col(c) for c in log.columns]
    )


def apply_status_updates(
    orders: DataFrame, updates: DataFrame, settle: bool = True, bits: int = SLICE_BITS
) -> StatusUpdates:
    """New order versions, the change feed, log rows with their notes, note placements and replies.

    ``delivered_at`` is set where an update enters delivered. ``changes`` carries
    the orders' amounts: feed it to ``changefeed.new_invoices``, and ``notes`` to
    ``annotate_log`` for orders whose newest log row is an earlier one.
    """
    judged = judge_updates(orders, updates)
    if settle:
        judged = settle_frame(judged)
    changes = accepted_changes(judged, bits)
    if settle:
        changes = settle_frame(changes)
    arrived = entered(F.col("old_status"), F.col("new_status"), DELIVERED)
    last = changes.groupBy("order_id").agg(
        F.max_by("new_status", "seq").alias("last_status"),
        F.max_by(F.when(arrived, F.col("changed_at")), F.when(arrived, F.col("seq"))).alias("arrived_at"),
    )
    updated = orders.join(last, "order_id", "left").select(
        *[
            F.coalesce("last_status", "order_status").alias(c)
            if c == "order_status"
            else F.coalesce("arrived_at", "delivered_at").alias(c)
            if c == "delivered_at"
            else F.col(c)
            for c in orders.columns
        ]
    )
    replies = judged.select("seq", "order_id", "accepted", "message")
    notes = placed_notes(changes, bits)
    if settle:
        notes = settle_frame(notes)
    return StatusUpdates(updated, changes, noted_log(changes, notes), notes, replies)


@dataclass(frozen=True)
class ConfirmedPayments:
    """What a batch of payment confirmations leads to."""

    payments: DataFrame
    orders: DataFrame
    changes: DataFrame
    replies: DataFrame


def judge_confirmations(payments: DataFrame, confirmations: DataFrame) -> DataFrame:
    """Adds ``accepted`` and ``message`` to confirmations (seq, order_id, transaction_ref, confirmed_at).

    The first confirmation of a pending payment succeeds; later ones find it paid.
    """
    first = confirmations.groupBy("order_id").agg(F.min("seq").alias("first_seq"))
    standing = payments.select("order_id", "payment_status").join(first, "order_id")
    found = F.when(F.col("payment_status") != "pending", F.col("payment_status")).when(
        F.col("seq") > F.col("first_seq"), F.lit("success")
    )
    message = F.when(F.col("payment_status").isNull(), F.lit(NO_PAYMENT)).when(
        found.isNotNull(), F.concat(F.lit(PAYMENT_DONE), found, F.lit("."))
    )
    return (
        hot_lookup(confirmations, standing, "order_id")
        .withColumn("refusal", message)
        .withColumn("accepted", F.col("refusal").isNull())
        .withColumn("message", F.coalesce("refusal", F.lit(PAYMENT_OK)))
        .drop("refusal", "payment_status", "first_seq")
    )


def confirm_payments(
    payments: DataFrame, orders: DataFrame, confirmations: DataFrame, settle: bool = True
) -> ConfirmedPayments:
    """New payment and order versions, the change feed and replies.

    A confirmed payment sets its order to confirmed whatever its status was;
    ``changes.regressed`` marks orders moved back from a later stage or an end.
    """
    judged = judge_confirmations(payments, confirmations)
    if settle:
        judged = settle_frame(judged)
    paid = judged.filter("accepted").select("seq", "order_id", "transaction_ref", "confirmed_at")
    paid_payments = upsert(
        payments,
        paid.select(
            "order_id",
            F.lit("success").alias("payment_status"),
            "transaction_ref",
            F.col("confirmed_at").alias("paid_at"),
        ),
        "order_id",
        ["payment_status", "transaction_ref", "paid_at"],
    )
    touched = paid.join(orders, "order_id")
    changes = touched.select(
        "seq",
        "order_id",
        F.col("order_status").alias("old_status"),
        F.lit("confirmed").alias("new_status"),
        F.col("confirmed_at").alias("changed_at"),
        (~is_status(F.col("order_status"), "placed", "confirmed")).alias("regressed"),
    )
    confirmed = upsert(
        orders,
        paid.select("order_id", F.lit("confirmed").alias("order_status")),
        "order_id",
        ["order_status"],
    )
    return ConfirmedPayments(
        paid_payments, confirmed, changes, judged.select("seq", "order_id", "accepted", "message")
    )


@dataclass(frozen=True)
class AssignedAgents:
    """What a batch of assignments leads to."""

    orders: DataFrame
    agents: DataFrame
    replies: DataFrame


def judge_assignments(agents: DataFrame, assignments: DataFrame) -> DataFrame:
    """Adds ``accepted`` and ``message`` to assignments (seq, order_id, agent_id).

    The first request for a free, active agent takes that agent. Whether the order exists
    is not asked.
    """
    first = assignments.groupBy("agent_id").agg(F.min("seq").alias("first_seq"))
    standing = agents.select("agent_id", "is_active", "is_available").join(first, "agent_id")
    usable = F.coalesce(F.col("is_active") == 1, F.lit(False))
    message = F.when(~usable, F.lit(NO_AGENT)).when(
        (F.col("is_available") == 0) | (F.col("seq") > F.col("first_seq")), F.lit(AGENT_BUSY)
    )
    done = F.format_string(ASSIGNED_OK, "agent_id", "order_id")
    return (
        hot_lookup(assignments, standing, "agent_id")
        .withColumn("refusal", message)
        .withColumn("accepted", F.col("refusal").isNull())
        .withColumn("message", F.coalesce("refusal", done))
        .drop("refusal", "is_active", "is_available", "first_seq")
    )


def assign_agents(
    orders: DataFrame, agents: DataFrame, assignments: DataFrame, settle: bool = True
) -> AssignedAgents:
    """New order and agent versions and replies. Nothing frees an agent again."""
    judged = judge_assignments(agents, assignments)
    if settle:
        judged = settle_frame(judged)
    taken = judged.filter("accepted")
    per_order = taken.groupBy("order_id").agg(F.max_by("agent_id", "seq").alias("agent_id"))
    per_agent = taken.select("agent_id", F.lit(0).alias("is_available"))
    assigned = upsert(orders, per_order, "order_id", ["agent_id"])
    busy = upsert(agents, per_agent, "agent_id", ["is_available"])
    return AssignedAgents(assigned, busy, judged.select("seq", "order_id", "agent_id", "accepted", "message"))
