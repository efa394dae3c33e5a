"""A third of all rows on one key: joins on rows must end up split, results unchanged."""

import pytest
from pyspark.sql import functions as F

from tiffinlens.operators import audits, history, intake, menu, revenue, views

N = 300_000

TIGHT = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture(scope="module")
def tight(spark):
    before = {name: spark.conf.get(name) for name in TIGHT}
    for name, value in TIGHT.items():
        spark.conf.set(name, value)
    yield spark
    for name, value in before.items():
        spark.conf.set(name, value)


def numbers(spark, hot):
    """n, and a key that is ``hot`` for a third of the rows and spread over 20,000 otherwise."""
    return spark.range(0, N, 1, 16).selectExpr(
        "id as n", f"if(id % 3 = 0, {hot}, id % 20000) as k", "substr(sha2(cast(id as string), 256), 1, 24) as filler"
    )


def splits(frame):
    total = frame.select(F.count("*"), F.sum(F.hash(*frame.columns).cast("bigint"))).first()
    assert total[0] >= 0
    frame.write.format("noop").mode("overwrite").save()
    check = frame.select(F.sum(F.hash(*frame.columns).cast("bigint")).alias("h"))
    check.collect()
    final = check._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return final.count("skew=true")


def wide_orders(spark, hot_customer=7):
    return numbers(spark, hot_customer).selectExpr(
        "n as order_id",
        "k as customer_id",
        "k % 500 as restaurant_id",
        "if(n % 3 = 0, null, k % 300) as agent_id",
        "if(n % 2 = 0, 'delivered', 'cancelled') as order_status",
        *[f"cast(n % 1000 as decimal(10,2)) as {c}" for c in (
            "subtotal", "delivery_fee", "discount_amount", "tax_amount", "total_amount")],
        "timestamp_ntz'2024-01-01 00:00:00' as placed_at",
        "timestamp_ntz'2024-01-01 00:40:00' as estimated_delivery",
        "timestamp_ntz'2024-01-01 00:30:00' as delivered_at",
    )


def test_lines_of_one_order(tight):
    lines = numbers(tight, 5).selectExpr(
        "k as order_id", "n % 977 as item_id", "1 as quantity",
        "cast(n % 1000 as decimal(10,2)) as unit_price", "cast(n % 1000 as decimal(10,2)) as item_total",
    )
    orders = tight.range(20000).selectExpr("id as order_id", "'delivered' as order_status")
    sales = menu.item_sales(lines, orders)
    assert splits(sales) == 1
    assert sales.agg(F.sum("qty")).first()[0] == N


def test_lines_of_one_item(tight):
    lines = numbers(tight, 5).selectExpr("n % 90000 as order_id", "k as item_id", "filler")
    items = tight.range(20000).selectExpr("id as item_id", "cast(id % 2 as int) as is_veg")
    orders = tight.range(90000).selectExpr("id as order_id", "'delivered' as order_status")
    split = menu.basket_veg_split(lines, items, orders)
    assert splits(split) == 1
    assert split.agg(F.sum("orders")).first()[0] == 90000


def test_flat_view_with_a_hot_customer_and_unassigned_orders(tight):
    orders = wide_orders(tight)
    flat = views.order_summary(
        orders,
        tight.range(20000).selectExpr("id as customer_id", "'a' as full_name", "'b' as email"),
        tight.range(500).selectExpr("id as restaurant_id", "'r' as name", "'c' as city"),
        tight.range(300).selectExpr("id as agent_id", "'g' as full_name"),
        orders.selectExpr("order_id", "'upi' as payment_method", "'success' as payment_status"),
        orders.selectExpr("order_id", "5 as food_rating", "4 as delivery_rating"),
    )
    assert splits(flat) >= 1
    assert flat.count() == N
    assert flat.filter("agent_name is null").count() == N // 3


@pytest.mark.parametrize("operator", ["updates", "strict", "confirm", "assign"])
def test_replies_to_requests_on_one_key(tight, operator):
    ids = tight.range(20000)
    asked = numbers(tight, 5).selectExpr(
        "n as seq", "k as order_id", "k as agent_id", "filler as transaction_ref", "filler as note",
        "element_at(array('confirmed', 'preparing', 'placed'), cast(n % 3 as int) + 1) as new_status",
        "timestamp_ntz'2024-01-01 00:00:00' as changed_at", "timestamp_ntz'2024-01-01 00:00:00' as confirmed_at",
    )
    orders = ids.selectExpr("id as order_id", "'placed' as order_status")
    if operator == "updates":
        replies = intake.judge_updates(orders, asked)
    elif operator == "strict":
        replies = history.strict_transitions(orders, asked.withColumn("seq", F.col("seq") * 7))
    elif operator == "confirm":
        payments = ids.selectExpr("id as order_id", "'pending' as payment_status")
        replies = intake.judge_confirmations(payments, asked)
    else:
        agents = ids.selectExpr("id as agent_id", "1 as is_active", "1 as is_available")
        replies = intake.judge_assignments(agents, asked)
    assert splits(replies) >= 1
    assert replies.count() == N


def test_orders_at_one_restaurant_and_with_one_code(tight):
    asked = numbers(tight, 5).selectExpr(
        "n as seq", "n as customer_id", "k as restaurant_id", "n as address_id", "'upi' as payment_method",
        "filler as special_notes", "concat('code', k) as coupon_code",
        "timestamp_ntz'2024-01-01 12:00:00' as requested_at",
    )
    restaurants = tight.range(20000).selectExpr(
        "id as restaurant_id", "1 as is_active", "0 as opening_time", "86399 as closing_time"
    )
    checked = intake.open_requests(asked, restaurants)
    assert splits(checked) == 1
    coupons = tight.range(20000).selectExpr(
        "id as coupon_id", "concat('CODE', id) as code", "'flat' as discount_type",
        "cast(1 as decimal(10,2)) as discount_value", "cast(0 as decimal(10,2)) as min_order_value",
        "cast(null as decimal(10,2)) as max_discount", "cast(50 as bigint) as usage_limit",
        "cast(0 as bigint) as used_count", "date'2024-01-01' as valid_from", "date'2024-12-31' as valid_until",
        "1 as is_active",
    )
    granted = intake.grant_coupons(checked, coupons)
    assert splits(granted) >= 1
    # Ten requests at most for each of the other codes, all granted; the hot one stops at its limit.
    hot = granted.filter("coupon_id = 5")
    assert hot.count() == 50
    want = asked.filter("restaurant_id = 5").select("seq").orderBy("seq").limit(50)
    assert sorted(map(tuple, hot.select("seq").collect())) == sorted(map(tuple, want.collect()))
    assert granted.count() == 50 + asked.filter("restaurant_id <> 5").count()


def test_orphans_of_one_missing_parent(tight):
    child = numbers(tight, 50_000_000)
    parents = tight.range(20000).withColumnRenamed("id", "k")
    orphans = audits.orphan_rows(child, "k", parents, "k")
    assert splits(orphans) == 1
    assert orphans.count() == N // 3


def test_revenue_of_one_restaurant(tight):
    orders = wide_orders(tight, hot_customer=3)
    report = revenue.restaurant_revenue_commission(
        tight.range(500).selectExpr(
            "id as restaurant_id", "'r' as name", "cast(10 as decimal(5,2)) as commission_pct",
            "cast(4 as decimal(3,2)) as avg_rating",
        ),
        orders,
    )
    assert report.agg(F.sum("total_orders")).first()[0] == N // 2
