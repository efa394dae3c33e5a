"""Results on the sample rows, in output order."""

import datetime as dt

import pytest

from tiffinlens.operators import (
    audits,
    changefeed,
    customers,
    delivery,
    finance,
    history,
    menu,
    revenue,
    views,
)

from .helpers import rows
from .seed import seed


@pytest.fixture(scope="module")
def t(spark):
    return {name: frame.cache() for name, frame in seed(spark).items()}


def test_monthly_growth(t):
    assert rows(revenue.monthly_revenue_growth(t["orders"])) == [("2024-03", "6070.00", 10, 1, None)]


def test_monthly_growth_delivered_only(t):
    assert rows(revenue.monthly_revenue_growth(t["orders"], delivered_only=True)) == [
        ("2024-03", "5567.50", 9, 0, None)
    ]


@pytest.mark.parametrize("unique", [False, True])
def test_commission(t, unique):
    assert rows(revenue.restaurant_revenue_commission(t["restaurants"], t["orders"], unique)) == [
        (4, "Biryani Express", 2, "1600.00", "240.00", "800.00", "4.50"),
        (1, "Spice Garden", 2, "1228.00", "184.20", "614.00", "5.00"),
        (5, "Green Bowl", 2, "1081.00", "129.72", "540.50", "4.00"),
        (2, "Dragon Palace", 2, "868.50", "156.33", "434.25", "3.50"),
        (3, "Pizza Hub", 1, "790.00", "158.00", "790.00", "5.00"),
    ]


def test_pareto(t):
    assert rows(revenue.restaurant_pareto(t["orders"], t["restaurants"])) == [
        ("Biryani Express", "1600.00", "28.74", "28.74"),
        ("Spice Garden", "1228.00", "22.06", "50.79"),
        ("Green Bowl", "1081.00", "19.42", "70.21"),
        ("Dragon Palace", "868.50", "15.60", "85.81"),
        ("Pizza Hub", "790.00", "14.19", "100.00"),
    ]


def test_pareto_cut(t):
    cut = rows(revenue.restaurant_pareto(t["orders"], t["restaurants"], threshold=80))
    assert [r[0] for r in cut] == ["Biryani Express", "Spice Garden", "Green Bowl", "Dragon Palace"]


def test_payment_methods(t):
    assert rows(revenue.revenue_by_payment_method(t["payments"])) == [
        ("upi", 3, "2161.50", "720.50", "38.82"),
        ("cod", 2, "1267.50", "633.75", "22.77"),
        ("card", 2, "910.50", "455.25", "16.35"),
        ("netbanking", 1, "618.00", "618.00", "11.10"),
        ("wallet", 1, "610.00", "610.00", "10.96"),
    ]


def test_segments(t):
    assert rows(customers.customer_segments(t["orders"])) == [
        ("Occasional (2–3 orders)", 4, "1182.25", "2.0", "80.00"),
        ("One-time buyer", 1, "838.50", "1.0", "20.00"),
    ]


def test_repeat_gap(t):
    assert rows(customers.repeat_purchase_gap(t["orders"])) == [("11.5", 9, 15, 4)]


def test_repeat_gap_without_repeats(t):
    one = t["orders"].filter("order_id = 1")
    assert rows(customers.repeat_purchase_gap(one)) == [(None, None, None, 0)]


def test_top_customers(t):
    got = rows(customers.top_customers_ltv(t["customers"], t["orders"]))
    assert [(r[0], r[3], r[4], r[5]) for r in got] == [
        (1, 2, "1371.50", "685.75"),
        (3, 2, "1261.00", "630.50"),
        (2, 2, "1057.50", "528.75"),
        (5, 2, "1039.00", "519.50"),
        (4, 1, "838.50", "838.50"),
    ]
    assert got[0][1:3] == ("Arjun Mehta", "arjun.mehta@email.com")
    assert got[0][6] == dt.datetime(2024, 3, 10, 13, 0)


def test_no_estimates_no_punctuality(t, spark):
    orders = t["orders"].selectExpr("*", "cast(null as timestamp_ntz) as estimated_delivery")
    assert rows(delivery.on_time_vs_delayed(orders, t["reviews"])) == []
    got = rows(delivery.agent_leaderboard(t["delivery_agents"], orders))
    assert [(r[0], r[3], r[4], r[5], r[6], r[7]) for r in got] == [
        (2, 2, "50.0", "5.00", 0, "0.0"),
        (5, 2, "45.0", "4.50", 0, "0.0"),
        (1, 2, "52.5", "4.00", 0, "0.0"),
        (3, 2, "47.5", "4.00", 0, "0.0"),
        (4, 1, "55.0", "3.00", 0, "0.0"),
    ]


def test_funnel(t):
    assert rows(delivery.order_status_funnel(t["orders"])) == [
        ("delivered", 9, "90.00"),
        ("cancelled", 1, "10.00"),
    ]


def test_top_items(t):
    got = rows(menu.top_items(t["order_items"], t["menu_items"], t["restaurants"], t["orders"]))
    assert [(r[0], r[3], r[4]) for r in got] == [
        (15, 2, "840.00"),
        (19, 2, "680.00"),
        (12, 1, "450.00"),
        (8, 2, "400.00"),
        (5, 1, "380.00"),
        (11, 1, "350.00"),
        (16, 1, "350.00"),
        (3, 1, "320.00"),
        (17, 1, "300.00"),
        (20, 1, "260.00"),
    ]
    assert got[0] == (15, "Mutton Biryani", "Biryani Express", 2, "840.00", "420.00", "Non-Veg")


def test_veg_split(t):
    assert rows(menu.basket_veg_split(t["order_items"], t["menu_items"], t["orders"])) == [
        ("Mixed", 5, "55.56"),
        ("Full Veg", 3, "33.33"),
        ("Full Non-Veg", 1, "11.11"),
    ]


def test_no_coupons_used(t):
    assert rows(finance.coupon_effectiveness(t["coupons"], t["order_coupons"], t["orders"])) == []


def test_cancellations(t):
    assert rows(finance.cancellation_impact(t["orders"], t["payments"])) == [
        (1, "502.50", "0.00", "502.50", "10.00")
    ]
    none = t["orders"].filter("order_status <> 'cancelled'")
    assert rows(finance.cancellation_impact(none, t["payments"])) == [(0, None, None, None, "0.00")]


def test_order_summary(t):
    orders = t["orders"].selectExpr("*", "cast(null as timestamp_ntz) as estimated_delivery")
    flat = views.order_summary(
        orders,
        t["customers"],
        t["restaurants"],
        t["delivery_agents"],
        t["payments"],
        t["reviews"],
    ).orderBy("order_id")
    assert len(flat.columns) == 20
    got = flat.collect()
    assert [r.delivery_duration_min for r in got] == [45, 50, 50, 55, 40, 60, 50, 45, None, 50]
    assert {r.delivery_flag for r in got} == {"Delayed"}
    assert got[8].food_rating is None and got[8].payment_status == "refunded"


def test_daily_kpi(t):
    got = rows(views.daily_kpi(t["orders"]))
    assert len(got) == 10
    assert got[8] == (dt.date(2024, 3, 18), 1, 0, 1, "0.00", None, 1)
    assert all(r[4] == r[5] for i, r in enumerate(got) if i != 8)


def test_ratings(t):
    got = rows(changefeed.restaurant_ratings(t["reviews"], t["restaurants"]).orderBy("restaurant_id"))
    assert got == [(1, "5.00", 2), (2, "3.50", 2), (3, "5.00", 1), (4, "4.50", 2), (5, "4.00", 2)]
    got = rows(changefeed.agent_ratings(t["reviews"], t["delivery_agents"]).orderBy("agent_id"))
    assert got == [(1, "4.00"), (2, "5.00"), (3, "4.00"), (4, "3.00"), (5, "4.50")]


def test_reconciliation(t):
    assert rows(audits.line_total_problems(t["order_items"])) == []
    assert rows(audits.order_total_problems(t["orders"])) == []
    assert rows(audits.amount_problems(t["orders"], t["payments"], "amount")) == []
    got = rows(audits.subtotal_problems(t["orders"], t["order_items"]).orderBy("order_id"))
    assert got == [
        (4, "770.00", "840.00"),
        (7, "560.00", "620.00"),
        (9, "450.00", "470.00"),
        (10, "380.00", "360.00"),
    ]


def test_nothing_bought_together_twice(t):
    assert menu.bought_together(t["order_items"]).count() == 0
    pairs = menu.bought_together(t["order_items"], min_orders=1).collect()
    assert pairs and {p.orders_together for p in pairs} == {1}


def test_references_hold(t):
    report = audits.reference_report(t).collect()
    assert {r.orphan_rows for r in report} == {0}
    by_rule = {r.rule: r.referring_rows for r in report}
    assert by_rule["order_items.order_id -> orders"] == 22
    assert by_rule["order_coupons.order_id -> orders"] == 0


def test_cohort(t):
    assert rows(history.cohorts_by_registration(t["customers"], t["orders"])) == [
        ("2024-02", 1, 5, "5567.50")
    ]
