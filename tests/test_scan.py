"""Bounded scans against plain Python, with slices small enough to cross many borders."""

import random

import pytest
from pyspark.sql import functions as F

from tiffinlens.plans import scan
from tiffinlens.plans.scan import first_after, last_before, levels, running_sum_before, slice_of


@pytest.fixture(autouse=True, params=[scan.WINDOW, 0], ids=["one window", "levels"])
def window(request, monkeypatch):
    """Each test with as few levels as will do, and with all of them."""
    monkeypatch.setattr(scan, "WINDOW", request.param)


def make(spark, seed, n=400, keys=3, spread=5000):
    rng = random.Random(seed)
    positions = rng.sample(range(-spread, spread), n)
    # A third of all rows and more sit at key 0.
    data = [
        (rng.choice([0, 0, *range(keys)]), p, rng.randrange(100), rng.choice([None, "a", "b", "c"]))
        for p in positions
    ]
    return data, spark.createDataFrame(data, "k bigint, p bigint, x bigint, s string")


@pytest.mark.parametrize("bits", [1, 4, 20])
def test_running_sum(spark, bits):
    data, frame = make(spark, bits)
    got = running_sum_before(frame, "p", F.col("x"), "before", ["k"], bits, total="all")
    want = {}
    for k, p, x, _ in data:
        want[k, p] = (
            sum(r[2] for r in data if r[0] == k and r[1] < p),
            sum(r[2] for r in data if r[0] == k),
        )
    assert {(r.k, r.p): (r.before, r.all) for r in got.collect()} == want


@pytest.mark.parametrize("bits", [1, 6])
def test_running_count_without_keys(spark, bits):
    data, frame = make(spark, 7)
    got = running_sum_before(frame, "p", F.lit(1), "before", bits=bits)
    ordered = sorted(r[1] for r in data)
    assert {r.p: r.before for r in got.collect()} == {p: i for i, p in enumerate(ordered)}


@pytest.mark.parametrize("bits", [1, 4, 20])
def test_last_before_and_first_after(spark, bits):
    data, frame = make(spark, 10 + bits)
    before = last_before(frame, "p", F.col("s"), "o", ["k"], bits)
    after = first_after(frame, "p", F.col("s"), "o", ["k"], bits)
    want_before, want_after = {}, {}
    for k, p, _, _ in data:
        mine = sorted((r[1], r[3]) for r in data if r[0] == k and r[3] is not None)
        want_before[k, p] = next((s for q, s in reversed(mine) if q < p), None)
        want_after[k, p] = next((s for q, s in mine if q > p), None)
    assert {(r.k, r.p): r.o for r in before.collect()} == want_before
    assert {(r.k, r.p): r.o for r in after.collect()} == want_after


def test_slices_survive_an_earlier_partitioning_by_key(spark):
    """A join by key beforehand must not keep a hot key in one task."""
    _, frame = make(spark, 3)
    keyed = frame.join(spark.range(3).withColumnRenamed("id", "k"), "k")
    plan = last_before(keyed, "p", F.col("s"), "o", ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "_slice" in plan[plan.index("REPARTITION_BY_COL") - 200 : plan.index("REPARTITION_BY_COL")]


def rows_per_task(frame):
    """Rows read by each task of the widest window stage: what no key or id may make large."""
    return [r["count"] for r in frame.groupBy(F.spark_partition_id()).count().collect()]


@pytest.mark.parametrize("spread", [1, 1 << 20, 1 << 40])
def test_no_window_meets_more_than_a_slice(spark, spread):
    """Dense, sparse and time-based ids: summaries of any level are few per window."""
    n = 150_000 if spread == 1 else 3000
    frame = spark.range(n).select((F.col("id") * spread).alias("p"))
    per_slice = frame.groupBy(slice_of(F.col("p"))).count()
    assert per_slice.agg(F.max("count")).first()[0] <= 1 << 16
    for low, high in zip(levels(), [*levels()[1:], 63]):
        summaries = frame.select(slice_of(F.col("p"), low).alias("s"), slice_of(F.col("p"), high).alias("up")).distinct()
        assert summaries.groupBy("up").count().agg(F.max("count")).first()[0] <= 1 << 16
    got = running_sum_before(frame, "p", F.lit(1), "before")
    assert got.where(F.col("before") != F.col("p") / spread).count() == 0


def test_numbering_uses_several_tasks(spark):
    frame = spark.range(150_000).withColumnRenamed("id", "p")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tasks = rows_per_task(frame.withColumn("s", slice_of(F.col("p"))).repartition("s"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert max(tasks) < 150_000
