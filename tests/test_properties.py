"""Sums and orders that must hold on any data, here on the smallest given tables."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tiffinlens.operators import changefeed, customers, delivery, history, menu, revenue, views
from tiffinlens.operators.intake import judge_updates
from verification import bindings as b

SMALL = "/root/testdata/sf0.001"


def get(spark, name):
    return getattr(b, name)(spark, SMALL)


def close_to_hundred(values):
    return abs(sum(values) - 100) <= Decimal("0.005") * len(values)


def test_shares_add_up(spark):
    orders, payments = get(spark, "orders"), get(spark, "payments")
    reports = {
        "revenue_share_pct": revenue.revenue_by_payment_method(payments),
        "pct_of_customers": customers.customer_segments(orders),
        "pct_of_total": delivery.order_status_funnel(orders),
        "pct": menu.basket_veg_split(get(spark, "order_items"), get(spark, "menu_items"), orders),
    }
    for column, report in reports.items():
        assert close_to_hundred([r[column] for r in report.collect()]), column


def test_pareto_runs_up_to_hundred(spark):
    rows = revenue.restaurant_pareto(get(spark, "suborders"), get(spark, "restaurants")).collect()
    running = [r.cumulative_pct for r in rows]
    assert running == sorted(running) and running[-1] == 100
    assert [r.revenue for r in rows] == sorted((r.revenue for r in rows), reverse=True)
    cut = revenue.restaurant_pareto(get(spark, "suborders"), get(spark, "restaurants"), threshold=50).collect()
    assert cut == rows[: len(cut)]
    assert cut[-1].cumulative_pct >= 50 and cut[-2].cumulative_pct < 50


def test_segments_hold_every_buyer_once(spark):
    orders = get(spark, "orders")
    buyers = orders.filter("order_status = 'delivered'").select("customer_id").distinct().count()
    assert customers.customer_segments(orders).agg(F.sum("customer_count")).first()[0] == buyers
    assert history.ltv_distribution(orders).agg(F.sum("customers")).first()[0] == buyers


def test_daily_rows_hold_every_order_once(spark):
    orders = get(spark, "orders")
    total = views.daily_kpi(orders).agg(F.sum("total_orders"), F.sum("daily_revenue")).first()
    assert total[0] == orders.count()
    assert total[1] == orders.filter("order_status = 'delivered'").agg(F.sum("total_amount")).first()[0]


def test_approximate_customers_stay_close(spark):
    orders = get(spark, "orders").withColumn("placed_at", F.date_trunc("year", "placed_at").cast("timestamp_ntz"))
    exact = {r.order_date: r.unique_customers for r in views.daily_kpi(orders).collect()}
    rough = {r.order_date: r.unique_customers for r in views.daily_kpi(orders, approximate=True).collect()}
    assert all(abs(exact[d] - rough[d]) <= 0.2 * exact[d] for d in exact)


def test_the_first_row_of_an_order_logs_no_change(spark):
    feed = get(spark, "snapshots")
    changes = changefeed.with_old_status(feed)
    assert changes.count() == feed.count()
    assert changes.filter("old_status is null").count() == feed.select("order_id").distinct().count()


@pytest.mark.parametrize("bits", [3, 7])
def test_slices_do_not_change_results(spark, bits):
    feed = get(spark, "snapshots")
    one, other = changefeed.with_old_status(feed), changefeed.with_old_status(feed, bits)
    assert sorted(map(str, one.collect())) == sorted(map(str, other.collect()))


def test_every_update_gets_one_reply(spark):
    updates = get(spark, "status_updates")
    judged = judge_updates(get(spark, "orders"), updates)
    assert judged.count() == updates.count()
    assert judged.filter("message is null").count() == 0
