"""Streams over several micro-batches against the batch operators on the same rows."""

import pytest
from pyspark.sql import functions as F

from tiffinlens.operators import changefeed
from tiffinlens.operators.views import daily_kpi
from tiffinlens.plans.lineage import scratch_path, settle, shared_folder
from tiffinlens.streaming import feeds
from verification import bindings as b

SMALL = "/root/testdata/sf0.001"


def in_files(frame, path, parts=3):
    """The frame as several files, and a stream that takes one per micro-batch."""
    frame.repartition(parts).write.parquet(path)
    spark = frame.sparkSession
    return spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", 1).parquet(path)


def finish(query):
    query.awaitTermination()
    assert query.exception() is None
    assert len({p["batchId"] for p in query.recentProgress if p["numInputRows"]}) > 1


def same(left, right):
    assert left.columns == right.columns
    assert sorted(map(str, left.collect())) == sorted(map(str, right.collect()))


@pytest.fixture(scope="module")
def changes(spark):
    return b.imaged(b.snapshots(spark, SMALL)).cache()


def test_status_log(spark, changes, tmp_path):
    stream = in_files(changes, str(tmp_path / "in"))
    out = str(tmp_path / "out")
    finish(feeds.start_append(feeds.status_log_stream(stream), out, str(tmp_path / "c")))
    same(spark.read.parquet(out), changefeed.status_log(changes))


def test_invoices_are_issued_once_across_batches_and_restarts(spark, changes, tmp_path):
    stream = in_files(changes, str(tmp_path / "in"))
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "c")
    finish(feeds.start_invoices(stream, out, checkpoint))
    want = {r.order_id for r in changefeed.new_invoices(changes).collect()}
    got = [r.order_id for r in spark.read.parquet(out).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    changes.limit(50).write.mode("append").parquet(str(tmp_path / "in"))
    feeds.start_invoices(stream, out, checkpoint).awaitTermination()
    again = [r.order_id for r in spark.read.parquet(out).collect()]
    assert sorted(again) == sorted(got)


def test_late_and_repeated_deliveries_lose_no_invoice(spark, changes, tmp_path):
    """Files in turn: a delivery, one days earlier, a repeat of the first, two of one order with the newer first."""
    one = changes.filter("new_status = 'delivered'").limit(1)

    def delivery(seq, order, day):
        return one.selectExpr(
            f"cast({seq} as bigint) as seq", f"cast({order} as bigint) as order_id", "new_status",
            f"timestamp_ntz'2024-01-{day:02d} 10:00:00' as changed_at", f"cast({seq} as decimal(10,2)) as subtotal",
            "tax_amount", "delivery_fee", "discount_amount", "total_amount", "'placed' as old_status",
        )

    files = [
        delivery(1, 1, 10),
        delivery(2, 2, 2),
        delivery(3, 1, 11).union(delivery(4, 3_000_000, 1)),
        delivery(6, 5, 9).union(delivery(5, 5, 3)).coalesce(1),
    ]
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "c")
    for frame in files:
        frame.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(files[0].schema).parquet(str(tmp_path / "in"))
        feeds.start_invoices(stream, out, checkpoint).awaitTermination()
    everything = files[0].union(files[1]).union(files[2]).union(files[3])
    same(spark.read.parquet(out).drop("version", "orders_from"), changefeed.new_invoices(everything))


def test_running_ratings(spark, tmp_path):
    reviews = b.reviews(spark, SMALL)
    stream = in_files(reviews, str(tmp_path / "in"))
    out = str(tmp_path / "out")
    totals = feeds.rating_totals_stream(stream, "restaurant_id", "food_rating")
    finish(feeds.start_versioned(totals, out, str(tmp_path / "c")))
    same(
        feeds.latest(spark, out, "restaurant_id"),
        changefeed.rating_sums(reviews, "restaurant_id", "food_rating"),
    )


def test_coupon_uses(spark, tmp_path):
    uses = b.order_coupons(spark, SMALL)
    stream = in_files(uses, str(tmp_path / "in"))
    out = str(tmp_path / "out")
    finish(feeds.start_versioned(feeds.coupon_uses_stream(stream), out, str(tmp_path / "c")))
    assert {r.coupon_id: r.uses for r in feeds.latest(spark, out, "coupon_id").collect()} == {
        r.coupon_id: r["count"] for r in uses.groupBy("coupon_id").count().collect()
    }


def test_daily_view(spark, tmp_path):
    """Files that mix all days, a customer's orders among them: nothing comes too late."""
    orders = b.orders(spark, SMALL)
    stream = in_files(orders, str(tmp_path / "in"))
    out = str(tmp_path / "out")
    finish(feeds.start_versioned(feeds.daily_customer_stream(stream), out, str(tmp_path / "c")))
    same(feeds.daily_kpi_of(feeds.latest(spark, out, "order_date", "customer_id")), daily_kpi(orders))


def test_compacted_versions_read_the_same(spark, tmp_path):
    rows = [(1, "a", 0), (2, "b", 0), (1, "c", 1)]
    path, to = str(tmp_path / "v"), str(tmp_path / "base")
    spark.createDataFrame(rows, "k long, x string, version int").write.partitionBy("version").parquet(path)
    feeds.compact(spark, path, to, "k")
    assert {(r.k, r.x, r.version) for r in spark.read.parquet(to).collect()} == {(1, "c", 1), (2, "b", 1)}
    same(feeds.latest(spark, to, "k"), feeds.latest(spark, path, "k"))


def test_daily_view_exact(spark, tmp_path):
    orders = b.orders(spark, SMALL)
    stream = in_files(orders, str(tmp_path / "in"))
    out = str(tmp_path / "out")
    finish(
        feeds.start_daily_kpi_recompute(
            stream, lambda s: s.read.parquet(str(tmp_path / "in")), out, str(tmp_path / "c")
        )
    )
    same(feeds.latest(spark, out, "order_date"), daily_kpi(orders))


def test_scratch_files_go_to_the_shared_folder(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) == folder
    assert scratch_path(spark, "x").startswith(folder)
    kept = settle(spark.range(5).select((F.col("id") * 2).alias("x")))
    assert sorted(r.x for r in kept.collect()) == [0, 2, 4, 6, 8]
    assert folder in spark.sparkContext.getCheckpointDir()


@pytest.fixture(scope="module")
def snapshots(spark):
    return b.snapshots(spark, SMALL).cache()


def log_of(spark, stream, stored, tmp_path):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "c")
    query = feeds.start_status_log(stream, lambda s: s.read.parquet(stored), out, checkpoint)
    query.awaitTermination()
    assert query.exception() is None
    return feeds.status_log_of(spark, out), query


def test_status_log_without_old_images(spark, snapshots, tmp_path):
    """Files hold rows of all times, so most rows come late; then a restart with what else arrives."""
    stored = str(tmp_path / "in")
    first = snapshots.filter("seq % 7 <> 0")
    stream = in_files(first, stored, 4)
    found, query = log_of(spark, stream, stored, tmp_path)
    finish(query)
    same(found, changefeed.status_log(changefeed.with_old_status(first)))
    snapshots.filter("seq % 7 = 0").write.mode("append").parquet(stored)
    found, _ = log_of(spark, stream, stored, tmp_path)
    same(found, changefeed.status_log(changefeed.with_old_status(snapshots)))


def snapshot_rows(spark, rows):
    frame = spark.createDataFrame(rows, "seq long, order_id long, new_status string")
    return frame.withColumn("changed_at", F.expr("timestamp_ntz '2024-01-01' + make_dt_interval(0, 0, 0, seq)"))


@pytest.mark.parametrize("recent", [1, 2, 64])
def test_rows_older_than_the_state_are_replayed(spark, tmp_path, monkeypatch, recent):
    """An endless order, rows that repeat, a row with no status, a late row that makes a log row go."""
    monkeypatch.setattr(feeds, "RECENT", recent)
    # Workers get the function by value here, its bound included.
    monkeypatch.setattr(feeds._follow, "__module__", "__main__")
    batches = [
        [(10, 1, "placed"), (30, 1, "preparing"), (50, 1, "delivered"), (5, 2, "placed")],
        [(20, 1, "preparing"), (30, 1, "preparing"), (60, 1, None), (70, 1, "delivered")],
        [(1, 1, "delivered"), (65, 1, "delivered"), (4, 2, "confirmed"), (8, 3, "placed")],
        [(300 + i, 9, ("placed", "confirmed", "confirmed")[i % 3]) for i in range(200)],
        [(200 + i, 9, ("ready", "placed")[i % 2]) for i in range(60)],
    ]
    stored = str(tmp_path / "in")
    for rows in batches:
        snapshot_rows(spark, rows).coalesce(1).write.mode("append").parquet(stored)
    schema = snapshot_rows(spark, batches[0]).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(stored)
    found, _ = log_of(spark, stream, stored, tmp_path)
    whole = spark.read.parquet(stored).dropDuplicates(["seq"])
    same(found, changefeed.status_log(changefeed.with_old_status(whole)))


@pytest.mark.parametrize("apart", [1 << 17, 1 << 40])
def test_replays_of_rows_that_lie_far_apart(spark, tmp_path, monkeypatch, apart):
    """A replay inside a micro-batch goes over one level of slices, or over several."""
    monkeypatch.setattr(feeds, "RECENT", 1)
    monkeypatch.setattr(feeds._follow, "__module__", "__main__")
    names = ["placed", "preparing", "preparing", "ready", "delivered", "placed", "delivered"]
    rows = [(apart * i, 1, name) for i, name in enumerate(names)] + [(7, 2, "placed")]
    stored = str(tmp_path / "in")
    for batch in (rows[4:], rows[2:4], rows[:2]):
        snapshot_rows(spark, batch).withColumn("changed_at", F.expr("timestamp_ntz '2024-01-01'")).coalesce(1).write.mode("append").parquet(stored)
    stream = spark.readStream.schema(spark.read.parquet(stored).schema).option("maxFilesPerTrigger", 1).parquet(stored)
    found, _ = log_of(spark, stream, stored, tmp_path)
    assert sorted((r.seq // apart, r.status) for r in found.collect()) == [(1, "preparing"), (3, "ready"), (4, "delivered"), (5, "placed"), (6, "delivered")]


def test_only_ranges_of_the_batch_are_read(spark, tmp_path, monkeypatch):
    ids = [1, 2, 5 * feeds.INVOICE_RANGE, 9 * feeds.INVOICE_RANGE + 3, 12 * feeds.INVOICE_RANGE]
    path = str(tmp_path / "issued")
    frame = spark.createDataFrame([(i,) for i in ids], "order_id long").withColumn("orders_from", feeds._range_of("order_id"))
    frame.write.partitionBy("orders_from").parquet(path)
    stored = spark.read.schema("order_id long, orders_from long").parquet(path)
    touched = frame.filter(F.col("order_id").isin(2, 12 * feeds.INVOICE_RANGE)).select("orders_from").distinct()
    for named in (256, 0):
        monkeypatch.setattr(feeds, "NAMED_RANGES", named)
        found = feeds.in_ranges(stored, touched)
        assert sorted(r.order_id for r in found.collect()) == [1, 2, 12 * feeds.INVOICE_RANGE]
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [" in plan and ("dynamicpruning" in plan or " IN (" in plan)
    assert feeds.in_ranges(stored, touched.limit(0)).count() == 0


def days_left(query):
    return [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]


def orders_of_days(spark, rows):
    frame = spark.createDataFrame(rows, "order_id long, day int, hour int, customer_id long, order_status string, amount int")
    return frame.selectExpr(
        "order_id",
        "customer_id",
        "order_status",
        "timestamp_ntz '2024-01-01' + make_dt_interval(day, hour, 0, 0) as placed_at",
        "cast(amount as decimal(10,2)) as total_amount",
    )


def test_daily_view_with_days_that_close(spark, tmp_path):
    """Days go by, many customers each; rows come days late, one for a day never seen; then a restart."""
    stored, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "c"))
    status = ("delivered", "cancelled", "placed")

    def day(d, hour=9, n=30, first=0):
        return [(1000 * d + first + i, d, hour, i % 20 if i % 7 else None, status[i % 3], 10 + i) for i in range(n)]

    late = [(90_001, 2, 1, 77, "delivered", 5), (90_002, 2, 23, 1, None, None), (90_003, -40, 0, 3, "delivered", 7)]
    files = [day(0), day(1) + day(0, 23, 3, 500), day(2), day(3), day(4) + late, day(9), day(1, 5, 4, 700), day(10)]
    for rows in files[:6]:
        orders_of_days(spark, rows).coalesce(1).write.mode("append").parquet(stored)
    schema = orders_of_days(spark, late).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(stored)

    def run():
        running, correcting = feeds.start_daily_kpi(stream, lambda s: s.read.parquet(stored), out, checkpoint, "1 day")
        for query in (running, correcting):
            query.awaitTermination()
            assert query.exception() is None
        return running

    held = days_left(run())
    # Two open days of some twenty customers at most, however many days went by; in the end one.
    assert max(held) <= 3 * 22 and held[-1] <= 22
    same(feeds.daily_kpi_now(spark, out), daily_kpi(spark.read.parquet(stored)))
    for rows in files[6:]:
        orders_of_days(spark, rows).coalesce(1).write.mode("append").parquet(stored)
    held = days_left(run())
    assert max(held) <= 3 * 22
    same(feeds.daily_kpi_now(spark, out), daily_kpi(spark.read.parquet(stored)))
