"""Streaming forms of status log, invoices, ratings, coupon use and the daily view.

A feed without old images keeps the newest rows of each order as state; a feed
of orders keeps sums of the days that are still open. What comes later than the
state reaches is put right from the stored rows, so nothing is lost.

Aggregates run in update mode. Each micro-batch writes the rows it changed under
``version=<batch id>``, replacing that folder if the batch is run again after a
failure, so a restart neither loses nor doubles anything. ``latest`` reads the
current rows. Checkpoints belong in the shared folder (``lineage.scratch_path``)
or a path of the caller's.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions import money
from ..functions.lifecycle import CANCELLED, DELIVERED, count_if, entered
from ..operators import changefeed
from ..operators.views import daily_kpi


def status_log_stream(changes: DataFrame) -> DataFrame:
    """Log rows as changes arrive; stateless, since the feed carries old images."""
    return changefeed.status_log(changes)


# Rows of an order kept as state: a later row is put in its place among them.
RECENT = 64

_ROW = "order_id long, seq long, old_status string, new_status string, changed_at string, beyond boolean"
_STATE = "seqs array<long>, statuses array<string>, times array<string>, cut boolean"


def _follow(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Rows of an order with the status before each, and again the rows that a late one now stands before.

    State is the order's newest RECENT rows. A row older than these, where older
    ones were let go, is marked ``beyond``.
    """
    new = pd.concat(list(frames), ignore_index=True).dropna(subset="new_status").drop_duplicates("seq")
    if state.exists:
        seqs, statuses, times, cut = state.get
    else:
        seqs, statuses, times, cut = [], [], [], False
    held = pd.DataFrame({"seq": list(seqs), "new_status": list(statuses), "changed_at": list(times)})
    new = new[~new["seq"].isin(held["seq"])]
    rows = pd.concat([held.assign(fresh=False), new.assign(fresh=True)], ignore_index=True)
    rows = rows.sort_values("seq", ignore_index=True)
    rows["old_status"] = rows["new_status"].shift().where(rows.index > 0, None)
    lowest = min(seqs) if cut else None
    rows["beyond"] = rows["fresh"] & (rows["seq"] < lowest) if cut else False
    # The lowest row held follows one that was let go: its old status is known from before.
    told = rows["fresh"] | (rows["fresh"].shift(fill_value=False) & ~((rows["seq"] == lowest) if cut else False))
    kept = rows.iloc[-RECENT:]
    state.update(
        (
            [int(s) for s in kept["seq"]],
            [str(s) for s in kept["new_status"]],
            [None if pd.isna(t) else str(t) for t in kept["changed_at"]],
            bool(cut or len(rows) > RECENT),
        )
    )
    out = rows[told].assign(order_id=key[0])
    yield out[["order_id", "seq", "old_status", "new_status", "changed_at", "beyond"]]


def start_status_log(
    snapshots: DataFrame,
    read_snapshots: Callable[[SparkSession], DataFrame],
    path: str,
    checkpoint: str,
    **trigger,
) -> StreamingQuery:
    """The status log of a live feed without old images; ``status_log_of`` reads it.

    Rows carry seq, order_id, new_status, changed_at; none of the first two is
    NULL, a NULL status says nothing, and a row that comes again changes nothing. Each order's last rows are keyed state, so a row meets the status before
    it without reading what is stored, in whatever micro-batch that came. A late
    row is put in its place and the row after it told anew. Only where a row is
    older than all the state keeps, its order is replayed from ``read_snapshots``,
    which must hold every row that has arrived. An order's rows of one
    micro-batch meet in a task: the source's limits per trigger bound them.
    """
    time = snapshots.schema["changed_at"].dataType
    rows = snapshots.select("order_id", "seq", "new_status", F.col("changed_at").cast("string").alias("changed_at"))
    followed = rows.groupBy("order_id").applyInPandasWithState(
        _follow, _ROW, _STATE, "append", GroupStateTimeout.NoTimeout
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        staged_at = f"{path}/told={batch_id}"
        batch.write.mode("overwrite").parquet(staged_at)
        told = spark.read.schema(batch.schema).parquet(staged_at)
        behind = told.filter("beyond").select("order_id").distinct()
        near = told.join(behind, "order_id", "left_anti") if not behind.isEmpty() else told
        near = near.withColumn("changed_at", F.col("changed_at").cast(time)).drop("beyond")
        out = near
        if not behind.isEmpty():
            again = read_snapshots(spark).select("order_id", "seq", "new_status", "changed_at")
            again = again.join(behind, "order_id", "left_semi").dropDuplicates(["seq"])
            again = changefeed.with_old_status(again)
            out = near.unionByName(again)
        out.write.mode("overwrite").parquet(f"{path}/rows/version={batch_id}")

    return _start(followed, write, checkpoint, "append", trigger)


def status_log_of(spark: SparkSession, path: str) -> DataFrame:
    """The log rows that ``start_status_log`` wrote, each as it was told last."""
    return changefeed.status_log(latest(spark, f"{path}/rows", "seq"))


# Invoices are stored by ranges of this many order ids, so a micro-batch reads the ranges it touches.
INVOICE_RANGE = 1 << 20


def start_invoices(changes: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Appends due invoices to ``path``: the earliest delivery of each order in a micro-batch, if not issued before.

    No watermark and no state: however late a delivery comes, its invoice is
    issued, and what is already issued is found in the stored invoices. Of those
    only the ranges that hold an order of the batch are read: named in the filter
    where they are few, found by the join while it runs where they are many.
    """

    def issue(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        due = changefeed.new_invoices(batch).withColumn("orders_from", _range_of("order_id"))
        if batch_id > 0:
            issued = spark.read.schema("order_id bigint, version int, orders_from bigint").parquet(path)
            issued = in_ranges(issued.filter(F.col("version") < batch_id), due.select("orders_from").distinct())
            due = due.join(issued.select("order_id"), "order_id", "left_anti")
        due.write.mode("overwrite").partitionBy("orders_from").parquet(f"{path}/version={batch_id}")

    deliveries = changes.filter(entered(F.col("old_status"), F.col("new_status"), DELIVERED))
    return _start(deliveries, issue, checkpoint, "append", trigger)


# Ranges that are named one by one in a filter.
NAMED_RANGES = 256


def _range_of(order_id: str) -> Column:
    return F.col(order_id) - F.pmod(order_id, F.lit(INVOICE_RANGE))


def in_ranges(stored: DataFrame, ranges: DataFrame) -> DataFrame:
    """Rows of ``stored``, a table in folders by ``orders_from``, whose range is among ``ranges``; other folders stay unread."""
    named = [row.orders_from for row in ranges.limit(NAMED_RANGES + 1).collect()]
    if len(named) <= NAMED_RANGES:
        return stored.filter(F.col("orders_from").isin(named) if named else F.lit(False))
    return stored.join(ranges, "orders_from", "left_semi")


def rating_totals_stream(reviews: DataFrame, key: str, rating: str) -> DataFrame:
    """Running rating sum and count per key: one small state row per restaurant or agent."""
    return changefeed.rating_sums(reviews, key, rating)


def coupon_uses_stream(order_coupons: DataFrame) -> DataFrame:
    """Running use count per coupon."""
    return order_coupons.groupBy("coupon_id").agg(F.count("*").alias("uses"))


def _daily_sums(orders: DataFrame, day: Column) -> DataFrame:
    delivered = F.col("order_status") == DELIVERED
    return orders.groupBy(day, "customer_id").agg(
        F.count("*").alias("total_orders"),
        count_if(delivered).alias("delivered"),
        count_if(F.col("order_status") == CANCELLED).alias("cancelled"),
        F.sum(F.when(delivered, F.col("total_amount"))).alias("revenue"),
        F.count(F.when(delivered, F.col("total_amount"))).alias("amounts"),
    )


def daily_customer_stream(orders: DataFrame) -> DataFrame:
    """Running sums per day and customer: whole numbers and amounts that add up, so no order comes too late.

    State holds one row per customer and day; ``daily_kpi_of`` makes the exact
    daily view of its latest rows. Orders carry the status they have on arrival.
    ``start_daily_kpi`` does the same with state that closed days leave.
    """
    return _daily_sums(orders, F.to_date("placed_at").alias("order_date"))


EPOCH = dt.date(1970, 1, 1)


def start_daily_kpi(
    orders: DataFrame,
    read_orders: Callable[[SparkSession], DataFrame],
    path: str,
    checkpoint: str,
    delay: str = "2 days",
    **trigger,
) -> tuple[StreamingQuery, StreamingQuery]:
    """The daily view in bounded state, and its corrections; ``daily_kpi_now`` reads both.

    ``placed_at`` is never NULL. The first query keeps sums per customer of the days that are open: once the
    newest order is ``delay`` past a day's end, its state goes, and Spark leaves
    later orders of that day out. The second finds these: it keeps the newest
    moment seen so far, and computes every day that an order reached too late
    anew from ``read_orders``, which must hold all that has arrived. It may see
    more of the feed at a time than the first, so it takes at least the orders
    that the first left out. A day that was corrected once is corrected for every
    further order, so its correction always counts.
    """
    placed = F.col("placed_at")
    # Watermarks take instants only: the same clock in UTC, whatever the session's zone does to its days.
    seconds = F.date_diff(placed, F.lit(EPOCH)).cast("long") * 86400 + F.hour(placed) * 3600 + F.minute(placed) * 60 + F.second(placed)
    clocked = orders.withColumn("moment", F.timestamp_seconds(seconds)).withWatermark("moment", delay)
    open_days = _daily_sums(clocked, F.window("moment", "1 day").alias("day"))
    day = (F.unix_seconds("day.start") / 86400).cast("int")
    open_days = open_days.withColumn("order_date", F.date_add(F.lit(EPOCH), day)).drop("day")
    running = start_versioned(open_days, f"{path}/running", f"{checkpoint}/running", **trigger)

    def correct(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        newest = batch.agg(F.max("placed_at").alias("newest"))
        if batch_id > 0:
            marks = spark.read.schema("newest timestamp_ntz, version int").parquet(f"{path}/marks")
            seen = marks.filter(F.col("version") < batch_id).select("newest")
            newest = newest.unionByName(seen).agg(F.max("newest").alias("newest"))
        mark = newest.first()["newest"]
        spark.createDataFrame([(mark,)], "newest timestamp_ntz").write.mode("overwrite").parquet(f"{path}/marks/version={batch_id}")
        late = batch.filter(F.date_add(F.to_date("placed_at"), 1) <= F.lit(mark) - F.expr(f"interval {delay}"))
        _recomputed(late, read_orders(spark)).write.mode("overwrite").parquet(f"{path}/corrected/version={batch_id}")

    return running, _start(orders.select("placed_at"), correct, f"{checkpoint}/corrected", "append", trigger)


def daily_kpi_now(spark: SparkSession, path: str) -> DataFrame:
    """The daily view as ``start_daily_kpi`` has written it so far: a day's correction, else its running sums."""
    corrected = latest(spark, f"{path}/corrected", "order_date")
    running = daily_kpi_of(latest(spark, f"{path}/running", "order_date", "customer_id"))
    untouched = running.join(corrected.select("order_date"), running["order_date"].eqNullSafe(corrected["order_date"]), "left_anti")
    return untouched.unionByName(corrected.select(*untouched.columns))


def daily_kpi_of(rows: DataFrame) -> DataFrame:
    """The daily view from the latest rows of ``daily_customer_stream``."""
    return (
        rows.groupBy("order_date")
        .agg(
            *[F.sum(c).alias(c) for c in ("total_orders", "delivered", "cancelled", "revenue", "amounts")],
            F.count("customer_id").alias("unique_customers"),
        )
        .select(
            "order_date",
            "total_orders",
            "delivered",
            "cancelled",
            F.coalesce("revenue", F.lit(0).cast(money.MONEY)).alias("daily_revenue"),
            money.mean(F.col("revenue"), F.col("amounts")).alias("avg_order_value"),
            "unique_customers",
        )
    )


# Touched days that are named one by one in the filter; beyond, their span is read and days are joined.
NAMED_DAYS = 64


def start_daily_kpi_recompute(
    arrivals: DataFrame,
    read_orders: Callable[[SparkSession], DataFrame],
    path: str,
    checkpoint: str,
    **trigger,
) -> StreamingQuery:
    """Exact daily rows for every day an arriving order touches, recomputed from the orders table.

    Touched days become ranges in the filter, so the scan skips files of other
    days; of very many days the span is read instead.
    """

    def recompute(batch: DataFrame, batch_id: int) -> None:
        touched = _recomputed(batch, read_orders(batch.sparkSession))
        touched.write.mode("overwrite").parquet(f"{path}/version={batch_id}")

    return _start(arrivals, recompute, checkpoint, "append", trigger)


def _recomputed(arrived: DataFrame, orders: DataFrame) -> DataFrame:
    """Exact daily rows of the days of ``arrived``, from all orders."""
    days = arrived.select(F.to_date("placed_at").alias("order_date")).distinct()
    named = [row.order_date for row in days.limit(NAMED_DAYS + 1).collect()]
    if len(named) <= NAMED_DAYS:
        inside = [_on(day) for day in named if day is not None] or [F.lit(False)]
        return daily_kpi(orders.filter(reduce(lambda a, b: a | b, inside)))
    first, last = days.agg(F.min("order_date"), F.max("order_date")).first()
    span = orders.filter(_on(first, last)).withColumn("order_date", F.to_date("placed_at"))
    return daily_kpi(span.join(days, "order_date", "left_semi").drop("order_date"))


def _on(first, last=None) -> Column:
    """``placed_at`` within the days from ``first`` to ``last``."""
    placed = F.col("placed_at")
    start = F.lit(first).cast("timestamp_ntz")
    return (placed >= start) & (placed < F.date_add(F.lit(last or first), 1).cast("timestamp_ntz"))


def start_versioned(rows: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Writes the rows each micro-batch changed under ``path``; read them back with ``latest``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/version={batch_id}")

    return _start(rows, write, checkpoint, "update", trigger)


def start_append(rows: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Appends a stateless stream to Parquet files, each row once."""
    writer = rows.writeStream.format("parquet").option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).outputMode("append").start(path)


def latest(spark: SparkSession, path: str, *keys: str) -> DataFrame:
    """The newest version of every key written by ``start_versioned``."""
    versions = spark.read.parquet(path)
    rest: list[Column] = [F.col(c) for c in versions.columns if c not in (*keys, "version")]
    return (
        versions.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), "version").alias("row"))
        .select(*keys, "row.*")
    )


def compact(spark: SparkSession, path: str, to: str, *keys: str) -> None:
    """Writes the newest version of every key as one base version under ``to``, for readers to go on from.

    ``to`` takes the number of the newest version read, so versions of later
    micro-batches, written or moved beside it, still win in ``latest``.
    """
    newest = spark.read.parquet(path).agg(F.max("version")).first()[0]
    latest(spark, path, *keys).write.mode("overwrite").parquet(f"{to}/version={newest}")


def _start(rows: DataFrame, each, checkpoint: str, mode: str, trigger: dict) -> StreamingQuery:
    return (
        rows.writeStream.foreachBatch(each)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
