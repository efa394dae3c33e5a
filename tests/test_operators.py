"""Cases the sample rows leave open: gaps, ties, NULLs, limits, broken rows."""

import datetime as dt
import itertools
import random
import re
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tiffinlens.functions import time
from tiffinlens.operators import audits, changefeed, customers, delivery, finance, history, menu, revenue
from tiffinlens.schemas import TABLES
from tiffinlens.sources import tables as sources

from .helpers import rows
from .seed import frame, seed

T0 = dt.datetime(2024, 5, 1, 12, 0, 0)


def orders(spark, text):
    return frame(spark, "orders", text)


def test_growth_over_missing_and_zero_months(spark):
    o = orders(
        spark,
        """order_id order_status total_amount placed_at
        1 placed 100.00 2023-12-31T23:59:59
        2 cancelled 0.00 2024-02-01T00:00:00
        3 placed 50.00 2024-03-01T00:00:00
        4 placed 25.00 2024-04-01T00:00:00""",
    )
    assert rows(revenue.monthly_revenue_growth(o)) == [
        ("2023-12", "100.00", 1, 0, None),
        ("2024-02", "0.00", 1, 1, "-100.00"),
        ("2024-03", "50.00", 1, 0, None),
        ("2024-04", "25.00", 1, 0, "-50.00"),
    ]


def test_equal_revenues_share_a_running_value(spark):
    o = orders(
        spark,
        """order_id restaurant_id order_status total_amount
        1 1 delivered 40.00
        2 2 delivered 20.00
        3 3 delivered 20.00
        4 4 delivered 20.00
        5 5 placed 900.00
        6 6 delivered -0.50""",
    )
    r = spark.range(1, 7).select(F.col("id").alias("restaurant_id"), F.concat(F.lit("r"), "id").alias("name"))
    assert rows(revenue.restaurant_pareto(o, r)) == [
        ("r1", "40.00", "40.20", "40.20"),
        ("r2", "20.00", "20.10", "100.50"),
        ("r3", "20.00", "20.10", "100.50"),
        ("r4", "20.00", "20.10", "100.50"),
        ("r6", "-0.50", "-0.50", "100.00"),
    ]


def test_commission_counts_repeated_orders_once(spark):
    o = orders(
        spark,
        """order_id restaurant_id order_status total_amount
        1 1 delivered 10.00
        1 1 delivered 10.01""",
    )
    r = seed(spark)["restaurants"]
    got = rows(revenue.restaurant_revenue_commission(r, o))
    assert got == [(1, "Spice Garden", 1, "20.01", "3.00", "10.01", "5.00")]


def test_segments_and_gap_with_ties(spark):
    lines = ["order_id customer_id order_status total_amount placed_at"]
    number = 0
    for customer in range(1, 6):
        for i in range(customer):
            number += 1
            # Customer 2 orders twice at one moment; customer 3 ten days apart.
            day = "01" if customer == 2 else f"{1 + 10 * i:02d}" if customer == 3 else f"{1 + i:02d}"
            lines.append(f"{number} {customer} delivered 10.00 2024-01-{day}T10:00:00")
    o = orders(spark, "\n".join(lines))
    assert rows(customers.customer_segments(o)) == [
        ("Loyal (4+ orders)", 2, "45.00", "4.5", "40.00"),
        ("Occasional (2–3 orders)", 2, "25.00", "2.5", "40.00"),
        ("One-time buyer", 1, "10.00", "1.0", "20.00"),
    ]
    assert rows(customers.repeat_purchase_gap(o)) == [("3.0", 0, 10, 4)]


def test_top_customer_ties_go_to_the_lower_id(spark):
    t = seed(spark)
    o = orders(
        spark,
        """order_id customer_id order_status total_amount placed_at
        1 3 delivered 10.00 2024-01-01T00:00:00
        2 2 delivered 10.00 2024-01-01T00:00:00
        3 1 placed 99.00 2024-01-01T00:00:00""",
    )
    assert [r[0] for r in rows(customers.top_customers_ltv(t["customers"], o, n=1))] == [2]


def test_orphans_take_no_place_in_top_lists(spark):
    t = seed(spark)
    o = orders(
        spark,
        """order_id customer_id order_status total_amount placed_at
        1 77 delivered 90.00 2024-01-01T00:00:00
        2 78 delivered 80.00 2024-01-01T00:00:00
        3 2 delivered 10.00 2024-01-01T00:00:00
        4 3 delivered 20.00 2024-01-01T00:00:00""",
    )
    assert [r[0] for r in rows(customers.top_customers_ltv(t["customers"], o, n=2))] == [3, 2]
    lines = t["order_items"].unionByName(
        t["order_items"].selectExpr(
            *[f"item_id + 1000 as {c}" if c == "item_id" else f"{c} * 9 as {c}" if c == "item_total" else c
              for c in t["order_items"].columns]
        )
    )
    known = rows(menu.top_items(t["order_items"], t["menu_items"], t["restaurants"], t["orders"]))
    assert len(known) == 10
    assert rows(menu.top_items(lines, t["menu_items"], t["restaurants"], t["orders"])) == known
    closed = t["restaurants"].filter("restaurant_id <> 4")
    assert len(rows(menu.top_items(lines, t["menu_items"], closed, t["orders"]))) == 10


def test_punctuality(spark):
    o = orders(
        spark,
        """order_id agent_id order_status placed_at estimated_delivery delivered_at
        1 1 delivered 2024-01-01T10:00:00 2024-01-01T10:45:00 2024-01-01T10:44:59
        2 1 delivered 2024-01-01T10:00:00 2024-01-01T10:45:00 2024-01-01T10:45:00
        3 1 delivered 2024-01-01T10:00:00 2024-01-01T10:45:00 2024-01-01T10:46:30
        4 1 delivered 2024-01-01T10:00:00 - 2024-01-01T11:00:00
        5 1 delivered 2024-01-01T10:00:00 2024-01-01T10:45:00 -
        6 - delivered 2024-01-01T10:00:00 2024-01-01T10:45:00 2024-01-01T10:50:00""",
    )
    reviews = frame(
        spark,
        "reviews",
        """order_id food_rating delivery_rating
        1 5 -
        3 2 1""",
    )
    got = {r[0]: r[1:] for r in rows(delivery.on_time_vs_delayed(o, reviews))}
    assert got == {
        "On-time": (2, "44.5", "5.00", None),
        "Delayed": (2, "48.0", "2.00", "1.00"),
    }
    agents = seed(spark)["delivery_agents"]
    assert rows(delivery.agent_leaderboard(agents, o)) == [
        (1, "Karthik Reddy", "bike", 4, "48.8", "4.00", 1, "50.0")
    ]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_minutes_ignore_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        # The clocks of New York go forward between these two.
        frame_ = spark.sql(
            "select timestamp_ntz'2024-03-10 01:30:00' a, timestamp_ntz'2024-03-10 03:29:59' b"
        )
        got = frame_.select(
            time.minutes_between(F.col("a"), F.col("b")),
            time.minutes_between(F.col("b"), F.col("a")),
            time.month_label(time.month_number(F.col("a"))),
            time.seconds_of_day(F.col("b")),
            time.event_time(F.col("b")).cast("bigint"),
        ).first()
        assert tuple(got) == (119, -119, "2024-03", 12599, 1710041399)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_cancelled_without_payment_is_left_out_but_counts_below(spark):
    o = orders(
        spark,
        """order_id order_status
        1 cancelled
        2 cancelled
        3 placed""",
    )
    p = frame(
        spark,
        "payments",
        """order_id amount refund_amount
        1 10.00 4.00
        3 5.00 0.00""",
    )
    assert rows(finance.cancellation_impact(o, p)) == [(1, "10.00", "4.00", "10.00", "33.33")]


def test_coupon_effectiveness(spark):
    t = seed(spark)
    uses = frame(
        spark,
        "order_coupons",
        """order_id coupon_id discount_applied
        1 1 50.00
        5 1 50.00
        3 2 80.00
        9 2 10.00""",
    )
    assert rows(finance.coupon_effectiveness(t["coupons"], uses, t["orders"])) == [
        ("WELCOME50", "flat", "50.00", 2, "100.00", "1220.00", "610.00", "7.58"),
        ("SAVE20", "percentage", "20.00", 1, "80.00", "790.00", "790.00", "9.20"),
    ]
    assert rows(changefeed.coupon_usage(uses, t["coupons"]).orderBy("coupon_id")) == [
        (1, 2),
        (2, 2),
        (3, 0),
        (4, 0),
    ]


def feed(spark, changes):
    money = [Decimal("1.00")] * 5
    return spark.createDataFrame(
        [(s, o, old, new, T0 + dt.timedelta(minutes=s), *money) for s, o, old, new in changes],
        "seq bigint, order_id bigint, old_status string, new_status string, changed_at timestamp_ntz, "
        "subtotal decimal(10,2), tax_amount decimal(10,2), delivery_fee decimal(10,2), "
        "discount_amount decimal(10,2), total_amount decimal(10,2)",
    )


def test_invoices_keep_long_ids_and_are_issued_once(spark):
    changes = feed(
        spark,
        [
            (1, 7, "placed", "delivered"),
            (2, 7, "delivered", "delivered"),
            (3, 7, "delivered", "placed"),
            (4, 7, "placed", "delivered"),
            (5, 1_000_000, "placed", "delivered"),
            (6, 1_000_001, "placed", "delivered"),
            (7, 8, None, "delivered"),
        ],
    )
    first = changefeed.new_invoices(changes)
    assert [r.invoice_number for r in first.orderBy("order_id").collect()] == [
        "INV-2024-000007",
        "INV-2024-1000000",
        "INV-2024-1000001",
    ]
    assert first.filter("order_id = 7").first().issued_at == T0 + dt.timedelta(minutes=1)
    assert changefeed.new_invoices(changes, first).count() == 0
    assert rows(changefeed.delivered_at(changes.filter("order_id = 7"))) == [(7, T0 + dt.timedelta(minutes=4))]
    assert [r.seq for r in changefeed.status_log(changes).orderBy("seq").collect()] == [1, 3, 4, 5, 6]


def test_upsert(spark):
    current = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k bigint, s string, n int")
    fresh = spark.createDataFrame([(2, None), (3, "z")], "k bigint, s string")
    got = changefeed.upsert(current, fresh, "k", ["s"])
    assert rows(got.orderBy("k")) == [(1, "a", 1), (2, None, 2)]


def test_audits_find_what_is_broken(spark):
    t = seed(spark)
    lines = frame(
        spark,
        "order_items",
        """order_item_id order_id item_id quantity unit_price item_total
        1 1 1 2 5.00 10.00
        1 77 1 2 5.00 11.00
        3 77 99 - 5.00 10.00
        - - 1 1 5.00 5.00""",
    )
    model = {**t, "order_items": lines}
    report = {r.rule: (r.referring_rows, r.missing_keys, r.orphan_rows) for r in audits.reference_report(model).collect()}
    assert report["order_items.order_id -> orders"] == (3, 1, 2)
    assert report["order_items.item_id -> menu_items"] == (4, 1, 1)
    assert audits.orphan_rows(lines, "order_id", t["orders"], "order_id").count() == 2
    assert rows(audits.orphan_keys(lines, "order_id", t["orders"], "order_id")) == [(77, 2)]
    assert rows(audits.duplicate_keys(lines, ["order_item_id"])) == [(1, 2)]
    assert dict(map(tuple, audits.missing_values("order_items", lines).collect())) == {
        "order_item_id": 1,
        "order_id": 1,
        "item_id": 0,
        "quantity": 1,
        "unit_price": 0,
        "item_total": 0,
    }
    assert audits.line_total_problems(lines).count() == 1


@pytest.mark.parametrize("limit", [0, 3 * 224, 64 << 20])
def test_references_of_any_key(spark, limit):
    """Dense, sparse, negative and 64-bit keys: equal reports with no, some and all parents as bitmaps."""
    ids = [-(1 << 63), -(1 << 40), -32769, -32768, -32767, -1, 0, 1, 32767, 32768, 32769, 65536, 1 << 40, (1 << 63) - 1]
    held = spark.createDataFrame([(i,) for i in ids] + [(None,)], "order_id bigint")
    used = [*ids, *ids, *[i + 1 for i in ids[:-1]], *[i - 1 for i in ids[1:]], None]
    lines = spark.createDataFrame([(i, n, n % 3) for n, i in enumerate(used)], "order_id bigint, order_item_id bigint, item_id bigint")
    items = spark.createDataFrame([(0,), (1,)], "item_id bigint")
    lost = [i for i in used if i is not None and i not in ids]
    model = {"orders": held, "menu_items": items, "order_items": lines}
    got = {r.rule: (r.referring_rows, r.missing_keys, r.orphan_rows) for r in audits.reference_report(model, limit).collect()}
    assert got == {
        "order_items.order_id -> orders": (len(used) - 1, len(set(lost)), len(lost)),
        "order_items.item_id -> menu_items": (len(used), 1, len([n for n in range(len(used)) if n % 3 == 2])),
    }
    empty = {name: table.limit(0) for name, table in model.items()}
    assert {tuple(r)[1:] for r in audits.reference_report(empty, limit).collect()} == {(0, 0, 0)}


def test_references_read_a_child_once(spark, tmp_path):
    for name, cols in {"orders": "id AS order_id", "menu_items": "id AS item_id",
                       "order_items": "id AS order_item_id, id AS order_id, id AS item_id"}.items():
        spark.range(1000).selectExpr(*cols.split(", ")).write.parquet(f"{tmp_path}/{name}")
    model = {name: spark.read.parquet(f"{tmp_path}/{name}") for name in ("orders", "menu_items", "order_items")}
    report = audits.reference_report(model)
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 3 and "BroadcastHashJoin" in plan
    assert "SortMergeJoin [parent" not in plan


def test_codes_are_duplicates_in_any_case(spark):
    codes = frame(
        spark,
        "coupons",
        """coupon_id code
        1 SAVE20
        2 save20
        3 Other""",
    )
    assert audits.duplicate_keys(codes, ["code"]).count() == 1
    assert {r.rule: r.surplus_rows for r in audits.duplicate_report("coupons", codes).collect()} == {
        "coupons(coupon_id)": 0,
        "coupons(code)": 1,
    }


def test_value_problems(spark):
    reviews = frame(
        spark,
        "reviews",
        """review_id food_rating delivery_rating
        1 5 -
        2 0 6
        3 1 5""",
    )
    got = audits.value_problems("reviews", reviews).collect()
    assert [(r.review_id, r.problems) for r in got] == [(2, ["food_rating", "delivery_rating"])]


def test_purge_follows_cascades_and_refuses_held_rows(spark):
    t = seed(spark)
    model = {k: t[k] for k in ("restaurants", "menu_items", "orders", "order_items", "payments")}
    model["orders"] = t["orders"].filter("order_id in (1, 2)")
    model["order_items"] = t["order_items"].filter("order_id in (1, 2)").withColumn(
        "order_item_id", F.monotonically_increasing_id()
    )
    model["payments"] = t["payments"].filter("order_id = 1").withColumn("payment_id", F.col("order_id"))
    erase = spark.createDataFrame([(1,), (2,), (55,)], "order_id bigint")
    left, refused = audits.purge(model, "orders", erase)
    assert rows(refused) == [(1, "payments")]
    assert [r.order_id for r in left["orders"].collect()] == [1]
    assert {r.order_id for r in left["order_items"].collect()} == {1}
    assert left["payments"].count() == 1

    # Restaurant 5 has no order, yet its items are in none either: it goes with its menu.
    erase = spark.createDataFrame([(1,), (5,)], "restaurant_id bigint")
    left, refused = audits.purge(model, "restaurants", erase)
    assert {tuple(r) for r in refused.collect()} == {(1, "orders"), (1, "order_items")}
    assert sorted(r.restaurant_id for r in left["restaurants"].collect()) == [1, 2, 3, 4]
    assert left["menu_items"].filter("restaurant_id = 5").count() == 0
    assert left["menu_items"].filter("restaurant_id = 1").count() == 6


def test_large_baskets_are_paired_by_blocks(spark):
    rng = random.Random(5)
    baskets = {1: set(range(90)), 2: set(range(40, 130)), 3: set(rng.sample(range(130), 25)), 4: {1, 2}, 5: {7}}
    data = [(o, i) for o, items in baskets.items() for i in items for _ in range(1 + (i == 3))] + [(None, 1), (4, None)]
    lines = spark.createDataFrame(data, "order_id bigint, item_id bigint")
    want = Counter(pair for items in baskets.values() for pair in itertools.combinations(sorted(items), 2))
    for block in (1, 7, 25, 1000):
        got = menu.bought_together(lines, 2, block).collect()
        assert {(r.item_id, r.other_id): r.orders_together for r in got} == {p: n for p, n in want.items() if n > 1}
        assert len(got) == len({r[:2] for r in got})


def test_a_huge_basket_is_many_small_units(spark):
    lines = spark.range(20_000).selectExpr("1L AS order_id", "id AS item_id", "1L AS item_orders")
    firsts, seconds = menu.basket_units(lines, menu.BASKET_BLOCK)
    unit = ["order_id", "first", "second"]
    sizes = firsts.groupBy(unit).count().join(seconds.groupBy(unit).agg(F.count("*").alias("others")), unit).collect()
    assert len(sizes) == 20 * 21 // 2
    assert max(max(r["count"], r.others) for r in sizes) < 1.2 * menu.BASKET_BLOCK


def test_more_pairs_are_counted_by_more_tasks(spark, monkeypatch):
    """Every count is spread by the pairs to be made, and a pair of many orders is counted in parts."""
    rng = random.Random(3)
    baskets = {o: set(rng.sample(range(12), rng.randint(1, 6))) | {1, 2} for o in range(90)} | {90: set(range(20))}
    data = [(o, i) for o, items in baskets.items() for i in items for _ in range(1 + (i == 3))] + [(None, 1), (4, None)]
    lines = spark.createDataFrame(data, "order_id bigint, item_id bigint")
    orders = Counter(i for items in baskets.values() for i in items) + Counter([1])
    counts = Counter(pair for items in baskets.values() for pair in itertools.combinations(sorted(items), 2))
    n_pairs = sum(counts.values())
    for size, block in ((n_pairs // 30, 1000), (20, 1000), (20, 7)):
        monkeypatch.setattr(menu, "TASK_PAIRS", size)
        frame = menu.bought_together(lines, 2, block)
        got = {tuple(r)[:2]: (r[2], float(r[3])) for r in frame.collect()}
        assert got == {p: (n, pytest.approx(100 * n / orders[p[0]], abs=0.006)) for p, n in counts.items() if n > 1}
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        sizes = [int(n) for n in re.findall(r"RepartitionByExpression \[.*\], (\d+)", plan)]
        assert len(sizes) >= 4 and max(sizes) >= n_pairs / size


def test_bought_together_finds_every_frequent_pair(spark):
    lines = frame(
        spark,
        "order_items",
        """order_id item_id
        1 1
        1 2
        1 2
        2 1
        2 2
        2 3
        3 1
        4 3""",
    )
    got = {(r[0], r[1]): r[2:] for r in rows(menu.bought_together(lines))}
    assert got == {(1, 2): (2, "66.67")}
    got = {(r[0], r[1]): r[2:] for r in rows(menu.bought_together(lines, min_orders=1))}
    assert got == {(1, 2): (2, "66.67"), (1, 3): (1, "33.33"), (2, 3): (1, "50.00")}


def test_category_performance(spark):
    t = seed(spark)
    names = t["menu_items"].select("category_id").distinct().withColumn(
        "category_name", F.when(F.col("category_id").isin(3, 11), "Biryani").otherwise("Other")
    )
    got = rows(menu.category_performance(t["order_items"], t["menu_items"], names, t["orders"]))
    # 60 + 420 + 420 + 350 + 380 of 5400.
    assert got[1] == ("Biryani", 4, 5, "1630.00", "30.19")
    assert sum(Decimal(r[4]) for r in got) == 100


def test_sla_and_funnel_and_positions(spark):
    log = frame(
        spark,
        "order_status_log",
        """log_id order_id status changed_at
        1 1 placed 2024-01-01T10:00:00
        2 1 confirmed 2024-01-01T10:05:59
        3 2 placed 2024-01-01T10:00:00
        4 1 delivered 2024-01-01T11:00:00
        5 2 confirmed 2024-01-01T10:11:00
        6 3 placed 2024-01-01T10:00:00""",
    )
    limits = spark.createDataFrame([("placed", 10), ("confirmed", 60)], "status string, limit_minutes bigint")
    assert rows(history.sla_breaches(log, limits, bits=1).select("log_id", "minutes")) == [(3, 11)]
    assert rows(history.sla_report(log, limits, bits=1)) == [
        ("placed", 10, 2, 1, "50.00", "8.0", 11),
        ("confirmed", 60, 1, 0, "0.00", "54.0", 54),
    ]
    assert rows(history.cumulative_funnel(log)) == [
        ("placed", 3, "100.00"),
        ("confirmed", 2, "66.67"),
        ("delivered", 1, "33.33"),
    ]
    places = frame(
        spark,
        "agent_locations",
        """location_id agent_id order_id latitude longitude recorded_at
        1 1 - 17.10000000 78.10000000 2024-01-01T10:00:00
        3 1 - 17.30000000 78.30000000 2024-01-01T10:01:00
        2 1 - 17.20000000 78.20000000 2024-01-01T10:01:00""",
    )
    assert rows(history.latest_agent_position(places).select("agent_id", "latitude")) == [(1, "17.30000000")]


def test_ltv_percentiles_are_exact(spark):
    lines = ["order_id customer_id order_status total_amount"]
    lines += [f"{i} {i} delivered {i % 10 + 1}.00" for i in range(1, 41)]
    got = history.ltv_distribution(orders(spark, "\n".join(lines)), bits=3)
    assert rows(got) == [("One-time buyer", 40, "1.00", "3.00", "5.00", "8.00", "9.00", "10.00")]


@pytest.mark.parametrize("file_format", sources.FORMATS)
def test_tables_come_back_with_their_declared_types(spark, tmp_path, file_format):
    coupons = seed(spark)["coupons"]
    path = str(tmp_path / "coupons")
    writer = coupons.write.format(file_format)
    (writer.option("header", True) if file_format == "csv" else writer).save(path)
    got = sources.read_table(spark, "coupons", path, file_format)
    assert got.schema == coupons.schema
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, coupons.collect()))


def test_partitions_and_buckets(spark, tmp_path):
    t = seed(spark)
    path = str(tmp_path / "by_month")
    sources.write_by_month(t["orders"], path)
    one = spark.read.parquet(path).filter("order_month = '2024-03'")
    assert "PartitionFilters: [isnotnull(order_month" in one._jdf.queryExecution().executedPlan().toString()
    assert one.count() == 10
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("orders", "payments"):
            sources.write_bucketed(t[name], f"bucketed_{name}", "order_id", 4)
        joined = spark.table("bucketed_orders").join(spark.table("bucketed_payments"), "order_id")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 10
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in ("orders", "payments"):
            spark.sql(f"drop table if exists bucketed_{name}")


def test_insert_absent_twice_is_once(spark):
    a = spark.createDataFrame([(1,)], "k bigint")
    b = spark.createDataFrame([(1, 0, "x"), (2, 9, "later"), (2, 5, "first")], "k bigint, n int, s string")
    once = sources.insert_absent(a, b, "k", "n")
    assert rows(once) == [(2, 5, "first")]
    assert sources.insert_absent(a.union(once.select("k")), b, "k", "n").count() == 0


def test_views_can_be_queried(spark):
    t = seed(spark)
    t["orders"] = t["orders"].selectExpr("*", "cast(null as timestamp_ntz) as estimated_delivery")
    sources.register_views(t)
    assert spark.sql("select sum(total_orders) from vw_daily_kpi").first()[0] == 10
    assert spark.sql("select count(*) from vw_order_summary where agent_name is not null").first()[0] == 10


def test_model_has_seventeen_tables_and_sound_references():
    assert len(TABLES) == 17
    references = [(n, p) for n, t in TABLES.items() for p in t.parents]
    assert len(references) == 23
    for name, parent in references:
        assert parent.column in TABLES[name].names
        assert len(TABLES[parent.table].key) == 1
