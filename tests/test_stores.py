"""Stored tables under batches: results against whole tables, and folders that stay untouched."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from tiffinlens.operators import changefeed, history, intake, views
from tiffinlens.sources import stores
from tiffinlens.sources.tables import insert_absent, write_by_month
from verification import bindings as b

SMALL = "/root/testdata/sf0.001"


def files(path):
    return {f for f in glob.glob(f"{path}/**/*.parquet", recursive=True)}


def rows_of(frame):
    return sorted(map(str, frame.collect()))


def folder(file):
    return os.path.basename(os.path.dirname(file)).split("=")[1]


@pytest.fixture(scope="module")
def orders(spark):
    return b.orders(spark, SMALL).cache()


def test_updates_write_touched_months_only(spark, orders, tmp_path):
    path = str(tmp_path / "orders")
    write_by_month(orders, path)
    before = files(path)
    few = orders.orderBy("placed_at").limit(5)
    updates = few.select("order_id", F.lit("cancelled").alias("order_status"))
    touched = stores.update_stored(spark, path, updates, "order_id", ["order_status"])
    after = files(path)
    assert touched and {folder(f) for f in before - after} == set(touched) == {folder(f) for f in after - before}
    assert before & after
    want = changefeed.upsert(orders, updates, "order_id", ["order_status"])
    assert rows_of(spark.read.parquet(path).select(*orders.columns)) == rows_of(want)
    assert stores.update_stored(spark, path, updates.limit(0), "order_id", ["order_status"]) == []
    assert files(path) == after


def test_intake_results_on_a_stored_table(spark, orders, tmp_path):
    path = str(tmp_path / "orders")
    write_by_month(orders, path)
    result = intake.apply_status_updates(orders, b.status_updates(spark, SMALL))
    fresh = result.orders.join(result.changes.select("order_id").distinct(), "order_id", "left_semi")
    stores.update_stored(spark, path, fresh, "order_id", ["order_status", "delivered_at"])
    assert rows_of(spark.read.parquet(path).select(*orders.columns)) == rows_of(result.orders)


def test_refreshed_views_equal_whole_ones(spark, orders, tmp_path):
    daily, summary = str(tmp_path / "daily"), str(tmp_path / "summary")
    tables = {
        "customers": b.customers(spark, SMALL),
        "restaurants": b.restaurants(spark, SMALL),
        "delivery_agents": b.agents(spark, SMALL),
        "payments": b.payments_made(spark, SMALL),
        "reviews": b.reviews(spark, SMALL),
    }
    # Two batches of new orders, then a batch that changes some.
    first, rest = orders.filter("order_id % 3 <> 0"), orders.filter("order_id % 3 = 0")
    stores.refresh_daily_view(first, first, daily)
    stores.refresh_order_view(tables | {"orders": first}, first, summary)
    stores.refresh_daily_view(orders, rest, daily)
    stores.refresh_order_view(tables | {"orders": orders}, rest, summary)
    some = orders.orderBy("placed_at", "order_id").limit(3)
    changed = changefeed.upsert(
        orders, some.select("order_id", F.lit("cancelled").alias("order_status")), "order_id", ["order_status"]
    )
    before = files(daily) | files(summary)
    days = stores.refresh_daily_view(changed, some, daily)
    months = stores.refresh_order_view(tables | {"orders": changed}, some, summary)
    gone = before - (files(daily) | files(summary))
    assert {folder(f) for f in gone} == set(days) | set(months) and len(gone) < len(before)
    want = views.daily_kpi(changed)
    assert rows_of(spark.read.parquet(daily).select(*want.columns)) == rows_of(want)
    want = views.order_summary(changed, *[tables[n] for n in ("customers", "restaurants", "delivery_agents", "payments", "reviews")])
    got = spark.read.parquet(summary).withColumn("order_month", F.col("order_month").cast("string"))
    assert rows_of(got.select(*want.columns)) == rows_of(want)


def keyed(spark, keys, label):
    rows = [(k, f"{label}{i}", i) for i, k in enumerate(keys)]
    return spark.createDataFrame(rows, "k long, name string, seq long")


def test_inserts_meet_bitmaps_and_not_the_table(spark, tmp_path):
    path = str(tmp_path / "keyed")
    far = 1 << 50
    batches = [
        [5, 1, 5, None, 32768, 32769, -7, 0, far, 3 * stores.KEY_RANGE],
        [5, 2, 2, 32770, -7, -8, 1, far + 1, far, -(1 << 62), 0],
        [],
        [far + 1, 2, 7 * stores.KEY_RANGE + 1, 32767, -(1 << 62), (1 << 63) - 1],
    ]
    current = keyed(spark, [], "x")
    for number, keys in enumerate(batches):
        fresh = keyed(spark, keys, f"b{number}-")
        want = insert_absent(current, fresh.filter("k IS NOT NULL"), "k", "seq")
        for _ in range(2 if number == 1 else 1):  # the second batch is run again
            got = stores.insert_absent_stored(spark, path, fresh, "k", "seq", number)
            assert rows_of(got) == rows_of(want)
        current = current.unionByName(want)
        if number == 1:
            for table in glob.glob(f"{path}/rows/version=0/*/*.parquet"):
                os.remove(table)  # never read again
    stored = spark.read.parquet(f"{path}/rows").filter("version > 0").select("k", "name", "seq")
    assert rows_of(stored) == rows_of(current.filter("name NOT LIKE 'b0-%'"))


def test_positions_are_walked_back_by_day(spark, tmp_path):
    path = str(tmp_path / "positions")
    rows = [(i, i % 5, i, i // 4) for i in range(40)] + [(100, 9, 1, 0), (101, 3, 0, None), (102, 77, 0, None)]
    locations = spark.createDataFrame(rows, "location_id long, agent_id long, minute int, day int").selectExpr(
        "location_id",
        "agent_id",
        "cast(null as bigint) as order_id",
        "cast(location_id % 90 as decimal(10,8)) as latitude",
        "cast(0 as decimal(11,8)) as longitude",
        "timestamp_ntz '2024-03-01' + make_dt_interval(day, 0, minute, 0) as recorded_at",
    )
    stores.write_by_day(locations, path, "recorded_at")
    whole = history.latest_agent_position(locations)
    everyone = locations.select("agent_id").distinct()
    assert rows_of(stores.latest_positions_stored(spark, path, everyone)) == rows_of(whole)
    # Agents 0 to 4 are all found in the last three days: the older ones need not be there.
    for file in files(path):
        if folder(file) < "2024-03-08":
            os.remove(file)
    recent = spark.createDataFrame([(i,) for i in range(5)], "agent_id long")
    got = stores.latest_positions_stored(spark, path, recent)
    assert rows_of(got) == rows_of(whole.filter("agent_id < 5"))
    assert stores.latest_positions_stored(spark, path, recent.limit(0)).count() == 0
