"""Batch intake against handling the same requests one by one in plain Python."""

import datetime as dt
import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from tiffinlens.functions.lifecycle import ORDER_STATUSES
from tiffinlens.operators import changefeed, history, intake

from .helpers import rows
from .seed import frame

T0 = dt.datetime(2024, 5, 1, 12, 0, 0)

RESTAURANTS = """
    restaurant_id is_active opening_time closing_time
    1 1 32400 79200
    2 0 0 86399
    3 1 79200 7200"""
COUPONS = """
    coupon_id code discount_type discount_value min_order_value max_discount usage_limit used_count valid_from valid_until is_active
    1 FLAT50 flat 50.00 500.00 - - 7 2024-01-01 2024-12-31 1
    2 PCT20 percentage 20.00 0.00 100.00 - 0 2024-01-01 2024-12-31 1
    3 OPEN10 percentage 10.00 0.00 - - 0 2024-01-01 2024-12-31 1
    4 LAST2 flat 30.00 0.00 - 5 3 2024-01-01 2024-12-31 1
    5 OLD flat 30.00 0.00 - - 0 2023-01-01 2023-12-31 1
    6 GONE flat 30.00 0.00 - 5 5 2024-01-01 2024-12-31 1
    7 OFF flat 30.00 0.00 - - 0 2024-01-01 2024-12-31 0"""


def place(spark, requests, cart=None, **options):
    asked = spark.createDataFrame(
        [
            (seq, 1, restaurant, 1, "upi", None, code, moment)
            for seq, restaurant, code, moment in requests
        ],
        "seq bigint, customer_id bigint, restaurant_id bigint, address_id bigint, payment_method string, "
        "special_notes string, coupon_code string, requested_at timestamp_ntz",
    )
    lines = None
    if cart is not None:
        lines = spark.createDataFrame(
            [(seq, item, n, Decimal(price)) for seq, item, n, price in cart],
            "seq bigint, item_id bigint, quantity int, unit_price decimal(10,2)",
        )
    return intake.place_orders(
        asked,
        frame(spark, "restaurants", RESTAURANTS),
        frame(spark, "coupons", COUPONS),
        lines,
        **options,
    )


def test_opening_hours_include_both_ends_and_never_match_overnight(spark):
    day = dt.datetime(2024, 5, 1)
    placed = place(
        spark,
        [
            (1, 1, None, day.replace(hour=9)),
            (2, 1, None, day.replace(hour=22)),
            (3, 1, None, day.replace(hour=22, second=1)),
            (4, 2, None, T0),
            (5, 3, None, day.replace(hour=23)),
            (6, 9, None, T0),
        ],
        first_order_id=11,
    )
    got = rows(placed.replies.orderBy("seq"))
    ok = "Order placed successfully. Order ID: "
    closed = (False, None, "Restaurant is closed or inactive.")
    assert got == [
        (1, True, 11, ok + "11"),
        (2, True, 12, ok + "12"),
        (3, *closed),
        (4, *closed),
        (5, *closed),
        (6, *closed),
    ]
    order = placed.orders.filter("order_id = 11").first()
    assert order.order_status == "placed" and order.subtotal == 0 and order.total_amount == 30
    assert order.estimated_delivery == day.replace(hour=9, minute=45)
    assert rows(placed.status_log.select("order_id", "status").orderBy("order_id")) == [
        (11, "placed"),
        (12, "placed"),
    ]


def test_coupons(spark):
    codes = ["flat50", "PCT20 ", "open10", "LAST2", "last2", "Last2", "OLD", "GONE", "OFF", "NOPE", ""]
    placed = place(
        spark,
        [(i, 1, code, T0) for i, code in enumerate(codes, 1)],
        [(i, 5, 3, "300.00") for i in range(1, 12)],
        bits=1,
    )
    got = rows(placed.order_coupons.orderBy("order_id"))
    assert got == [(1, 1, "50.00"), (2, 2, "100.00"), (3, 3, "90.00"), (4, 4, "30.00"), (5, 4, "30.00")]
    totals = {r.order_id: (r.subtotal, r.tax_amount, r.total_amount) for r in placed.orders.collect()}
    assert totals[2] == (Decimal("900.00"), Decimal("45.00"), Decimal("875.00"))
    assert totals[6] == (Decimal("900.00"), Decimal("45.00"), Decimal("975.00"))
    assert placed.payments.filter("payment_status = 'pending'").count() == 11
    assert placed.order_items.count() == 11


def test_flat_coupon_above_subtotal_and_uncapped_percentage(spark):
    placed = place(
        spark,
        [(1, 1, "FLAT50", T0), (2, 1, "OPEN10", T0)],
        [(1, 5, 1, "10.00"), (2, 5, 200, "1000.01")],
    )
    got = {r.order_id: (r.discount_amount, r.total_amount) for r in placed.orders.collect()}
    assert got[1] == (Decimal("50.00"), Decimal("-9.50"))
    assert got[2][0] == Decimal("9999.00")


def test_minimum_order_value_only_where_asked_for(spark):
    request, cart = [(1, 1, "FLAT50", T0)], [(1, 5, 1, "10.00")]
    assert place(spark, request, cart, enforce_min_order=True).order_coupons.count() == 0
    assert place(spark, request, cart).order_coupons.count() == 1


def test_tax_rounds_half_up(spark):
    placed = place(spark, [(1, 1, None, T0)], [(1, 5, 1, "10.10")])
    want = (Decimal("10.10") * Decimal("0.05")).quantize(Decimal("0.01"), ROUND_HALF_UP)
    assert placed.orders.first().tax_amount == want == Decimal("0.51")


def replay(status, updates, strict=False):
    """Replies, log, final status and delivery time, one update after the other."""
    replies, log, arrived, notes, newest = [], [], None, {}, None
    for seq, new, note in updates:
        if status in ("delivered", "cancelled"):
            replies.append((seq, f"Cannot update. Order already {status}."))
            continue
        if new not in ORDER_STATUSES:
            text = f"Cannot move from {status} to {new}." if strict else f"Unknown status {new}."
            replies.append((seq, text))
            continue
        step = ORDER_STATUSES.index(new) - ORDER_STATUSES.index(status)
        if strict and new != "cancelled" and step != 1:
            replies.append((seq, f"Cannot move from {status} to {new}."))
            continue
        if new != status:
            log.append((seq, new))
            newest = seq
            if new == "delivered":
                arrived = seq
        if note:
            notes[newest] = note
        status = new
        replies.append((seq, f"Status updated to {new}."))
    return replies, log, status, arrived, notes


def random_updates(spark, seed, n=600):
    rng = random.Random(seed)
    start = {o: rng.choice(ORDER_STATUSES) for o in range(1, 60)}
    start[1] = "placed"
    data = []
    choices = [*ORDER_STATUSES[:5]] * 6 + ["delivered", "cancelled", "lost"]
    for seq in rng.sample(range(10_000), n):
        order = rng.choice([1, rng.randrange(1, 64)])
        data.append((seq, order, rng.choice(choices), rng.choice([None, "", f"note {seq}"])))
    orders = spark.createDataFrame(
        [(o, s, None) for o, s in start.items()],
        "order_id bigint, order_status string, delivered_at timestamp_ntz",
    )
    updates = spark.createDataFrame(
        [(s, o, new, note, T0 + dt.timedelta(minutes=s)) for s, o, new, note in data],
        "seq bigint, order_id bigint, new_status string, note string, changed_at timestamp_ntz",
    )
    return start, sorted(data), orders, updates


@pytest.mark.parametrize("seed,bits", [(1, 3), (2, 5), (3, 20)])
def test_status_updates_equal_a_serial_replay(spark, seed, bits):
    start, data, orders, updates = random_updates(spark, seed)
    result = intake.apply_status_updates(orders, updates, settle=seed == 1, bits=bits)
    want_replies, want_log, want_orders, want_notes = {}, set(), {}, {}
    for order in range(1, 64):
        mine = [(s, new, note) for s, o, new, note in data if o == order]
        if order not in start:
            want_replies.update({s: "Order not found." for s, _, _ in mine})
            continue
        replies, log, status, arrived, notes = replay(start[order], mine)
        want_replies.update(replies)
        want_log |= {(s, order, new) for s, new in log}
        want_orders[order] = (status, arrived and T0 + dt.timedelta(minutes=arrived))
        want_notes.update({(order, at): note for at, note in notes.items()})
    assert {r.seq: r.message for r in result.replies.collect()} == want_replies
    assert {(r.seq, r.order_id, r.status) for r in changefeed.status_log(result.changes).collect()} == want_log
    assert {r.order_id: (r.order_status, r.delivered_at) for r in result.orders.collect()} == want_orders
    assert {(r.order_id, r.log_seq): r.note for r in result.notes.collect()} == want_notes


@pytest.mark.parametrize("seed,bits", [(4, 2), (5, 6), (6, 20)])
def test_strict_transitions_equal_a_serial_replay(spark, seed, bits):
    start, data, orders, updates = random_updates(spark, seed, n=2000)
    got = {r.seq: (r.accepted, r.message) for r in history.strict_transitions(orders, updates, bits).collect()}
    want = {}
    for order in range(1, 64):
        mine = [(s, new, note) for s, o, new, note in data if o == order]
        if order not in start:
            want.update({s: (False, "Order not found.") for s, _, _ in mine})
            continue
        replies, *_ = replay(start[order], mine, strict=True)
        want.update({s: (m.startswith("Status updated"), m) for s, m in replies})
    assert got == want


def test_batches_can_be_split(spark):
    start, data, orders, updates = random_updates(spark, 8, n=200)
    whole = intake.apply_status_updates(orders, updates, settle=False)
    early = intake.apply_status_updates(orders, updates.filter("seq < 5000"), settle=True)
    late = intake.apply_status_updates(early.orders, updates.filter("seq >= 5000"), settle=False)
    assert sorted(map(tuple, whole.orders.collect())) == sorted(map(tuple, late.orders.collect()))


def test_confirmations(spark):
    orders = frame(
        spark,
        "orders",
        """order_id order_status
        1 placed
        2 cancelled
        3 placed""",
    )
    payments = frame(
        spark,
        "payments",
        """order_id payment_status transaction_ref paid_at
        1 pending - -
        2 pending - -
        3 failed X -""",
    )
    asked = spark.createDataFrame(
        [(1, 1, "A", T0), (2, 1, "B", T0), (3, 2, "C", T0), (4, 3, "D", T0), (5, 9, "E", T0)],
        "seq bigint, order_id bigint, transaction_ref string, confirmed_at timestamp_ntz",
    )
    result = intake.confirm_payments(payments, orders, asked)
    assert rows(result.replies.orderBy("seq").select("seq", "accepted", "message")) == [
        (1, True, "Payment confirmed and order status updated."),
        (2, False, "Payment already success."),
        (3, True, "Payment confirmed and order status updated."),
        (4, False, "Payment already failed."),
        (5, False, "Payment record not found."),
    ]
    assert rows(result.payments.orderBy("order_id")) == [
        (1, "success", "A", T0),
        (2, "success", "C", T0),
        (3, "failed", "X", None),
    ]
    assert rows(result.orders.orderBy("order_id")) == [(1, "confirmed"), (2, "confirmed"), (3, "placed")]
    assert result.changes.filter("regressed").select("order_id").first()[0] == 2
    assert changefeed.status_log(result.changes).count() == 2


def test_assignments(spark):
    agents = frame(
        spark,
        "delivery_agents",
        """agent_id is_available is_active
        1 1 1
        2 0 1
        3 1 0
        4 1 1""",
    )
    orders = frame(
        spark,
        "orders",
        """order_id agent_id
        1 -
        2 7""",
    )
    asked = spark.createDataFrame(
        [(1, 1, 1), (2, 2, 1), (3, 2, 2), (4, 2, 3), (5, 2, 9), (6, 1, 4)],
        "seq bigint, order_id bigint, agent_id bigint",
    )
    result = intake.assign_agents(orders, agents, asked)
    assert rows(result.replies.orderBy("seq").select("accepted", "message")) == [
        (True, "Agent 1 assigned to order 1."),
        (False, "Agent is currently unavailable."),
        (False, "Agent is currently unavailable."),
        (False, "Agent not found or inactive."),
        (False, "Agent not found or inactive."),
        (True, "Agent 4 assigned to order 1."),
    ]
    assert rows(result.orders.orderBy("order_id")) == [(1, 4), (2, 7)]
    assert rows(result.agents.orderBy("agent_id").select("is_available")) == [(0,), (0,), (1,), (0,)]


def test_settled_and_unsettled_batches_agree(spark):
    requests = [(i, 1 + i % 3, ["LAST2", None, "open10"][i % 3], T0) for i in range(40)]
    cart = [(i, 5, 1 + i % 4, "99.99") for i in range(40)]
    a, b = (place(spark, requests, cart, settle=s, bits=2) for s in (True, False))
    for name in ("orders", "order_items", "status_log", "payments", "order_coupons", "replies"):
        left, right = getattr(a, name), getattr(b, name)
        assert sorted(map(str, left.collect())) == sorted(map(str, right.collect())), name
    assert a.orders.agg(F.max("order_id")).first()[0] == a.orders.count()


def test_updates_lead_to_invoices_and_noted_logs(spark):
    """The chain from updates to invoices, and notes on new and on earlier log rows."""
    orders = spark.createDataFrame(
        [(1, "placed", 10, 5, 30, 0, 45), (2, "delivered", 20, 1, 30, 0, 51), (3, "placed", 7, 1, 30, 0, 38)],
        "order_id bigint, order_status string, subtotal int, tax_amount int, delivery_fee int, "
        "discount_amount int, total_amount int",
    ).withColumn("delivered_at", F.lit(None).cast("timestamp_ntz"))
    when = F.lit("2024-05-01 10:00:00").cast("timestamp_ntz")
    updates = spark.createDataFrame(
        [
            (1, 1, "placed", "on hold"),  # no change: belongs to the row logged before
            (2, 1, "confirmed", "called"),
            (3, 1, "confirmed", "called again"),
            (4, 1, "delivered", None),
            (5, 3, "placed", "only a note"),
            (6, 2, "placed", "refused"),
        ],
        "seq bigint, order_id bigint, new_status string, note string",
    ).withColumn("changed_at", when)
    log = spark.createDataFrame(
        [(10, 1, None), (11, 1, "old"), (12, 2, None), (13, 3, None)], "log_id bigint, order_id bigint, note string"
    )
    result = intake.apply_status_updates(orders, updates)
    assert [(r.order_id, r.grand_total) for r in changefeed.new_invoices(result.changes).collect()] == [(1, 45)]
    assert {(r.seq, r.status, r.note) for r in result.log.collect()} == {
        (2, "confirmed", "called again"),
        (4, "delivered", None),
    }
    assert {(r.log_id, r.note) for r in intake.annotate_log(log, result.notes).collect()} == {
        (10, None),
        (11, "on hold"),
        (12, None),
        (13, "only a note"),
    }
