"""What the plans must look like for large and uneven data."""

import re

import pytest

from tiffinlens.operators import customers, delivery, menu, revenue, views
from verification import bindings as b
from verification import queries as registry

SMALL = "/root/testdata/sf0.001"


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Model tables as Parquet, the way operators meet them outside the tests."""
    folder = tmp_path_factory.mktemp("model")
    tables = {}
    for name in ("orders", "payments", "order_items", "menu_items", "reviews", "restaurants"):
        path = str(folder / name)
        getattr(b, name)(spark, SMALL).write.parquet(path)
        tables[name] = spark.read.parquet(path)
    return tables


@pytest.mark.parametrize("name", [n for n in registry.QUERIES if "stream" not in n])
def test_no_query_pairs_everything_with_everything(spark, no_broadcast, name):
    text = plan(registry.queries()[name](spark, SMALL))
    assert "NestedLoop" not in text and "Cartesian" not in text


@pytest.mark.parametrize("name", [n for n in registry.QUERIES if "stream" not in n])
def test_no_query_leaves_the_engine(spark, name):
    text = plan(registry.queries()[name](spark, SMALL))
    assert not re.search(r"Python|MapInPandas|FlatMapGroups|ArrowEval", text)


def test_status_filter_and_columns_reach_the_scan(stored):
    text = plan(customers.customer_values(stored["orders"]))
    assert "PushedFilters: [IsNotNull(order_status), EqualTo(order_status,delivered)]" in text
    read = text[text.index("ReadSchema") :].split("\n")[0]
    assert read.count(":") - 1 == 4
    assert all(c in read for c in ("order_id", "customer_id", "order_status", "total_amount"))


def test_first_two_orders_are_cut_before_the_shuffle(stored):
    text = plan(customers.repeat_purchase_gap(stored["orders"]))
    partial = text.index("WindowGroupLimit [customer_id", text.index("Exchange hashpartitioning(customer_id"))
    assert "Partial" in text[partial:].split("\n")[0]


def test_aggregates_combine_before_they_shuffle(stored):
    for frame in (
        revenue.revenue_by_payment_method(stored["payments"]),
        delivery.order_status_funnel(stored["orders"]),
        views.daily_kpi(stored["orders"]),
    ):
        assert "partial_" in plan(frame)


def test_top_items_takes_the_top_without_a_full_sort(stored):
    text = plan(
        menu.top_items(
            stored["order_items"], stored["menu_items"], stored["restaurants"], stored["orders"]
        )
    )
    assert "TakeOrderedAndProject(limit=10" in text


def test_revenue_is_computed_once_for_the_pareto_report(spark, stored, no_broadcast):
    frame = revenue.restaurant_pareto(stored["orders"], stored["restaurants"])
    frame.collect()
    final = plan(frame).split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final


def test_only_bounded_results_are_ever_collected_in_one_task(spark, no_broadcast):
    """Single-partition shuffles appear only over group totals of closed domains, block sums and totals."""
    allowed = {
        "q01_monthly_revenue_growth": 1,
        "q01r_monthly_growth_delivered": 1,
        # The top level of a scan has 2**16 rows at most; the other is the one row of the total.
        "q03_restaurant_pareto": 2,
        "x6_pareto_cut": 2,
        "q04_revenue_by_payment_method": 1,
        "q05_customer_segments": 1,
        "q10_order_status_funnel": 1,
        "q12_basket_veg_split": 1,
    }
    for name, most in allowed.items():
        text = plan(registry.queries()[name](spark, SMALL))
        assert text.count("SinglePartition") <= most, name
