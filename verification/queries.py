"""Every operator over the given tables, each a function of (spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiffinlens.operators import (
    audits,
    changefeed,
    customers,
    delivery,
    finance,
    history,
    intake,
    menu,
    revenue,
    views,
)
from tiffinlens.plans.lineage import scratch_path
from tiffinlens.schemas import TABLES
from tiffinlens.session import tune
from tiffinlens.sources import stores
from tiffinlens.sources.tables import insert_absent, register_views, write_by_month
from tiffinlens.streaming import feeds

from . import bindings as b

Query = Callable[[SparkSession, str], DataFrame]


def plain(frame: DataFrame) -> DataFrame:
    """Decimals as double and every integer as bigint, for comparison."""
    kinds = {field.name: field.dataType for field in frame.schema.fields}

    def same(name: str):
        kind = kinds[name]
        if isinstance(kind, T.DecimalType):
            return F.col(name).cast("double").alias(name)
        if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
            return F.col(name).cast("bigint").alias(name)
        if isinstance(kind, T.StringType) and kind != T.StringType():
            return F.col(name).cast("string").alias(name)
        return F.col(name)

    return frame.select(*[same(name) for name in frame.columns])


def _finished(query) -> None:
    query.awaitTermination()
    failure = query.exception()
    if failure:
        raise failure


def _changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changefeed.with_old_status(b.snapshots(spark, sf_dir))


def _placed(spark: SparkSession, sf_dir: str, settle: bool = True) -> intake.PlacedOrders:
    return intake.place_orders(
        b.order_requests(spark, sf_dir),
        b.restaurants(spark, sf_dir),
        b.coupons(spark, sf_dir),
        b.cart(spark, sf_dir),
        settle=settle,
    )


def _updated(spark: SparkSession, sf_dir: str, settle: bool = True) -> intake.StatusUpdates:
    return intake.apply_status_updates(
        b.orders(spark, sf_dir), b.status_updates(spark, sf_dir), settle=settle
    )


def _confirmed(spark: SparkSession, sf_dir: str, settle: bool = True) -> intake.ConfirmedPayments:
    return intake.confirm_payments(
        b.payments(spark, sf_dir), b.orders(spark, sf_dir), b.confirmations(spark, sf_dir), settle=settle
    )


def _assigned(spark: SparkSession, sf_dir: str, settle: bool = True) -> intake.AssignedAgents:
    return intake.assign_agents(
        b.orders(spark, sf_dir), b.agents(spark, sf_dir), b.assignments(spark, sf_dir), settle=settle
    )


def _model(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "customers": b.customers(spark, sf_dir),
        "customer_addresses": b.customer_addresses(spark, sf_dir),
        "cuisines": b.cuisines(spark, sf_dir),
        "restaurant_cuisines": b.restaurant_cuisines(spark, sf_dir),
        "invoices": b.invoices(spark, sf_dir),
        "restaurants": b.restaurants(spark, sf_dir),
        "delivery_agents": b.agents(spark, sf_dir),
        "menu_categories": b.menu_categories(spark, sf_dir),
        "menu_items": b.menu_items(spark, sf_dir),
        "orders": b.orders(spark, sf_dir),
        "order_items": b.order_items(spark, sf_dir),
        "payments": b.payments(spark, sf_dir),
        "reviews": b.reviews(spark, sf_dir),
        "coupons": b.coupons(spark, sf_dir),
        "order_coupons": b.order_coupons(spark, sf_dir),
        "order_status_log": b.status_log(spark, sf_dir),
        "agent_locations": b.locations(spark, sf_dir),
    }


def _status_log_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = b.imaged(b.snapshots_of(b.stream(spark, sf_dir, "events")))
    path = scratch_path(spark, "status-log")
    _finished(feeds.start_append(feeds.status_log_stream(changes), f"{path}/rows", f"{path}/checkpoint"))
    return spark.read.parquet(f"{path}/rows")


def _status_log_snapshots_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "status-log")
    feed = b.snapshots_of(b.stream(spark, sf_dir, "events"))
    _finished(feeds.start_status_log(feed, lambda s: b.snapshots(s, sf_dir), f"{path}/log", f"{path}/checkpoint"))
    return feeds.status_log_of(spark, f"{path}/log")


def _invoices_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = b.imaged(b.snapshots_of(b.stream(spark, sf_dir, "events")))
    path = scratch_path(spark, "invoices")
    _finished(feeds.start_invoices(changes, f"{path}/rows", f"{path}/checkpoint"))
    return spark.read.parquet(f"{path}/rows").drop("version", "orders_from")


def _totals_stream(rows: DataFrame, name: str, *keys: str) -> DataFrame:
    spark = rows.sparkSession
    path = scratch_path(spark, name)
    _finished(feeds.start_versioned(rows, f"{path}/rows", f"{path}/checkpoint"))
    return feeds.latest(spark, f"{path}/rows", *keys)


def _restaurant_ratings_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    reviews = b.reviews_of(b.stream(spark, sf_dir, "orders"))
    return _totals_stream(
        feeds.rating_totals_stream(reviews, "restaurant_id", "food_rating"), "ratings", "restaurant_id"
    )


def _agent_ratings_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    reviews = b.reviews_of(b.stream(spark, sf_dir, "orders"))
    return _totals_stream(
        feeds.rating_totals_stream(reviews, "agent_id", "delivery_rating"), "agents", "agent_id"
    )


def _coupon_uses_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    uses = b.order_coupons_of(b.stream(spark, sf_dir, "orders"))
    return _totals_stream(feeds.coupon_uses_stream(uses), "coupons", "coupon_id")


def _daily_kpi_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = b.orders_of(b.stream(spark, sf_dir, "orders"))
    rows = _totals_stream(feeds.daily_customer_stream(orders), "daily", "order_date", "customer_id")
    return feeds.daily_kpi_of(rows)


def _daily_kpi_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = b.orders_of(b.stream(spark, sf_dir, "orders"))
    path = scratch_path(spark, "daily-bounded")
    for query in feeds.start_daily_kpi(orders, lambda s: b.orders(s, sf_dir), f"{path}/rows", f"{path}/checkpoint"):
        _finished(query)
    return feeds.daily_kpi_now(spark, f"{path}/rows")


def _daily_kpi_recompute(spark: SparkSession, sf_dir: str) -> DataFrame:
    arrivals = b.orders_of(b.stream(spark, sf_dir, "orders"))
    path = scratch_path(spark, "daily-exact")
    _finished(
        feeds.start_daily_kpi_recompute(
            arrivals, lambda s: b.orders(s, sf_dir), f"{path}/rows", f"{path}/checkpoint"
        )
    )
    return feeds.latest(spark, f"{path}/rows", "order_date")


def _purge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ask to erase every cancelled order: rows left per table, and orders held back per holding table."""
    model = _model(spark, sf_dir)
    tables = {name: model[name] for name in ("orders", "order_items", "order_status_log")}
    tables |= {"payments": b.payments_made(spark, sf_dir), "reviews": b.raw_reviews(spark, sf_dir)}
    erase = tables["orders"].filter(F.col("order_status") == "cancelled").select("order_id")
    left, refused = audits.purge(tables, "orders", erase)
    counts = [
        frame.agg(F.count("*").alias("rows_left")).select(F.lit(name).alias("table_name"), "rows_left")
        for name, frame in left.items()
    ]
    held = refused.groupBy("held_by").agg(F.count("*").alias("rows_left")).select(
        F.concat(F.lit("held by "), F.col("held_by")).alias("table_name"), "rows_left"
    )
    return reduce(DataFrame.unionByName, counts, held)


# Added to an id, it makes that of a newcomer whom no given order knows.
NEWCOMER = 1_000_000_000


def _with_newcomers(table: DataFrame, *ids: str) -> DataFrame:
    """The rows, and each again with its ids moved past all given ones."""
    moved = table.select(*[(F.col(c) + NEWCOMER).alias(c) if c in ids else F.col(c) for c in table.columns])
    return table.unionByName(moved)


def _moved_at(column: str, condition: str) -> Column:
    return F.when(F.expr(condition), F.col(column) + NEWCOMER).otherwise(F.col(column))


def _purged(tables: dict[str, DataFrame], root: str, erase: DataFrame, ids: dict[str, str]) -> DataFrame:
    """table_name, id: the rows left of each table, and the root keys held back per holding table."""
    left, refused = audits.purge(tables, root, erase)
    rows = [
        left[name].select(F.lit(name).alias("table_name"), F.col(key).cast("bigint").alias("id")) for name, key in ids.items()
    ]
    held = refused.select(
        F.concat(F.lit("held by "), F.col("held_by")).alias("table_name"), F.col("root_key").cast("bigint").alias("id")
    )
    return reduce(DataFrame.unionByName, rows, held)


def _purge_customers_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ask to erase who left no phone, newcomers among them: any order of theirs, or to their address, holds them.

    Every 97th order goes to a newcomer's address. All tables are whole.
    """
    tables = {
        "customers": _with_newcomers(b.customers(spark, sf_dir), "customer_id"),
        "customer_addresses": _with_newcomers(b.customer_addresses(spark, sf_dir), "address_id", "customer_id"),
        "orders": b.orders(spark, sf_dir).withColumn(
            "delivery_address_id", _moved_at("delivery_address_id", "order_id % 97 = 0")
        ),
    }
    return _purged(
        tables,
        "customers",
        tables["customers"].where("phone IS NULL").select("customer_id"),
        {"customers": "customer_id", "customer_addresses": "address_id", "orders": "order_id"},
    )


def _purge_restaurants_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ask to erase the restaurants of some cities, newcomers among them: any order or sold item holds them.

    Every 997th line sells a newcomer's item. All tables are whole.
    """
    tables = {
        "restaurants": _with_newcomers(b.restaurants(spark, sf_dir), "restaurant_id"),
        "restaurant_cuisines": _with_newcomers(b.restaurant_cuisines(spark, sf_dir), "restaurant_id"),
        "menu_items": _with_newcomers(b.menu_items(spark, sf_dir), "item_id", "restaurant_id"),
        "orders": b.orders(spark, sf_dir),
        "order_items": b.order_items(spark, sf_dir).withColumn("item_id", _moved_at("item_id", "order_item_id % 997 = 0")),
    }
    return _purged(
        tables,
        "restaurants",
        tables["restaurants"].where("city LIKE 'CITY_1%'").select("restaurant_id"),
        {
            "restaurants": "restaurant_id",
            "restaurant_cuisines": "restaurant_id",
            "menu_items": "item_id",
            "orders": "order_id",
            "order_items": "order_item_id",
        },
    )


def _audited(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The model with reviews as they came in, unchecked."""
    return _model(spark, sf_dir) | {"reviews": b.raw_reviews(spark, sf_dir)}


def _duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    reports = [audits.duplicate_report(name, table) for name, table in _audited(spark, sf_dir).items()]
    return reduce(DataFrame.unionByName, reports)


def _missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = _audited(spark, sf_dir)
    reports = [
        audits.missing_values(name, tables[name]).select(F.lit(name).alias("table_name"), "*")
        for name in ("orders", "customers", "customer_addresses", "reviews")
    ]
    return reduce(DataFrame.unionByName, reports)


# Of the rows as they are taken for received, one in this many lacks a given column or has a value past its domain.
FAULT_EVERY = 40


def _faulty(name: str, column: str, place: int) -> Column:
    """Whether a row of the table, by its key, is one received with a fault in the column."""
    return (F.col(TABLES[name].key[0]).cast("bigint") * 7 + place) % FAULT_EVERY == 0


def _missing_received(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NULLs in all 17 tables as received: each required column lacks some values."""
    reports = []
    for name, table in _audited(spark, sf_dir).items():
        required = [c for c in TABLES[name].required if c in table.columns]
        received = table.select(*[F.when(~_faulty(name, c, i), F.col(c)).alias(c) for i, c in enumerate(required)])
        reports.append(audits.missing_values(name, received).select(F.lit(name).alias("table_name"), "*"))
    return reduce(DataFrame.unionByName, reports)


def _values_received(spark: SparkSession, sf_dir: str) -> DataFrame:
    """table_name, id, problems: rows of all tables with value rules as received, some past a domain or range."""
    reports = []
    for name, table in _audited(spark, sf_dir).items():
        spec = TABLES[name]
        rules = [c for c in (*spec.domains, *spec.ranges) if c in table.columns]
        if not rules:
            continue
        received = table
        for place, c in enumerate(rules):
            wrong = F.lit("?") if c in spec.domains else F.lit(9)
            received = received.withColumn(c, F.when(_faulty(name, c, place), wrong).otherwise(F.col(c)))
        reports.append(
            audits.value_problems(name, received).select(
                F.lit(name).alias("table_name"),
                F.col(spec.key[0]).cast("bigint").alias("id"),
                F.concat_ws(",", "problems").alias("problems"),
            )
        )
    return reduce(DataFrame.unionByName, reports)


def _views_for_bi(spark: SparkSession, sf_dir: str) -> None:
    register_views(_model(spark, sf_dir) | {"payments": b.payments_made(spark, sf_dir)})


def _view_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A question asked of the daily view in SQL, as a BI tool would."""
    _views_for_bi(spark, sf_dir)
    return spark.sql(
        "SELECT date_format(order_date, 'yyyy-MM') AS month, sum(total_orders) AS orders, "
        "sum(daily_revenue) AS revenue FROM vw_daily_kpi GROUP BY 1"
    )


def _stored_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order view, stored in a folder per month and read back for one of them and by its sums."""
    _views_for_bi(spark, sf_dir)
    path = scratch_path(spark, "by-month")
    write_by_month(spark.table("vw_order_summary").drop("order_month"), path)
    return spark.read.parquet(path).groupBy(F.col("order_month").cast("string").alias("order_month")).agg(
        F.count("*").alias("orders"), F.sum("total_amount").alias("total")
    )


def _insert_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whoever sends an event becomes an agent from the first one on, unless the id is taken."""
    fresh = b.snapshots(spark, sf_dir).select(
        F.col("order_id").alias("agent_id"), F.col("changed_at").alias("created_at"), "seq"
    )
    return insert_absent(b.agents(spark, sf_dir), fresh, "agent_id", "seq")


def _updated_in_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status updates set in a table stored by month, and the whole table read back."""
    path = scratch_path(spark, "orders-by-month")
    write_by_month(b.orders(spark, sf_dir), path)
    result = _updated(spark, sf_dir, True)
    fresh = result.orders.join(result.changes.select("order_id").distinct(), "order_id", "left_semi")
    stores.update_stored(spark, path, fresh, "order_id", ["order_status", "delivered_at"])
    return spark.read.parquet(path).select("order_id", "order_status", "delivered_at")


def _daily_refreshed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored daily view after a batch of updates, of which it computes the days anew."""
    path = scratch_path(spark, "daily-view")
    orders = b.orders(spark, sf_dir)
    stores.refresh_daily_view(orders, orders, path)
    result = _updated(spark, sf_dir, True)
    stores.refresh_daily_view(result.orders, result.changes.select("order_id").distinct(), path)
    return spark.read.parquet(path).drop("order_day")


def _inserted_in_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Agents stored first, then whoever sends an event, unless the id is taken: those that were added."""
    path = scratch_path(spark, "agents")
    fresh = b.snapshots(spark, sf_dir).select(
        F.col("order_id").alias("agent_id"), F.col("changed_at").alias("created_at"), "seq"
    )
    first = b.agents(spark, sf_dir).select("agent_id", F.lit(None).cast(fresh.schema["created_at"].dataType).alias("created_at"))
    stores.insert_absent_stored(spark, path, first.withColumn("seq", F.lit(0).cast("long")), "agent_id", "seq", 0)
    return stores.insert_absent_stored(spark, path, fresh, "agent_id", "seq", 1)


def _positions_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "positions")
    stores.write_by_day(b.locations(spark, sf_dir), path, "recorded_at")
    return stores.latest_positions_stored(spark, path, b.agents(spark, sf_dir)).drop("order_id")


def _coupon_uses_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running uses, their versions made one base version, which is all that is read."""
    uses = b.order_coupons_of(b.stream(spark, sf_dir, "orders"))
    path = scratch_path(spark, "coupons")
    _finished(feeds.start_versioned(feeds.coupon_uses_stream(uses), f"{path}/rows", f"{path}/checkpoint"))
    feeds.compact(spark, f"{path}/rows", f"{path}/base", "coupon_id")
    return feeds.latest(spark, f"{path}/base", "coupon_id")


def _audit(check) -> Query:
    return lambda spark, sf_dir: check(lambda table: getattr(b, table)(spark, sf_dir))


QUERIES: dict[str, Query] = {
    "q01_monthly_revenue_growth": lambda s, d: revenue.monthly_revenue_growth(b.orders(s, d)),
    "q01r_monthly_growth_delivered": lambda s, d: revenue.monthly_revenue_growth(
        b.orders(s, d), delivered_only=True
    ),
    "q02_restaurant_revenue_commission": lambda s, d: revenue.restaurant_revenue_commission(
        b.restaurants(s, d), b.suborders(s, d)
    ),
    "q03_restaurant_pareto": lambda s, d: revenue.restaurant_pareto(b.suborders(s, d), b.restaurants(s, d)),
    "q04_revenue_by_payment_method": lambda s, d: revenue.revenue_by_payment_method(b.payments(s, d)),
    "q05_customer_segments": lambda s, d: customers.customer_segments(b.orders(s, d)),
    "q06_repeat_purchase_gap": lambda s, d: customers.repeat_purchase_gap(b.orders(s, d)),
    "q07_top_customers_ltv": lambda s, d: customers.top_customers_ltv(b.customers(s, d), b.orders(s, d)),
    "q08_on_time_vs_delayed": lambda s, d: delivery.on_time_vs_delayed(b.orders(s, d), b.reviews(s, d)),
    "q09_agent_leaderboard": lambda s, d: delivery.agent_leaderboard(b.agents(s, d), b.orders(s, d)),
    "q10_order_status_funnel": lambda s, d: delivery.order_status_funnel(b.orders(s, d)),
    "q11_top_items": lambda s, d: menu.top_items(
        b.order_items(s, d), b.menu_items(s, d), b.restaurants(s, d), b.orders(s, d)
    ),
    "q12_basket_veg_split": lambda s, d: menu.basket_veg_split(
        b.order_items(s, d), b.menu_items(s, d), b.orders(s, d)
    ),
    "q13_coupon_effectiveness": lambda s, d: finance.coupon_effectiveness(
        b.coupons(s, d), b.order_coupons(s, d), b.orders(s, d)
    ),
    "q14_cancellation_impact": lambda s, d: finance.cancellation_impact(
        b.orders(s, d), b.payments_made(s, d)
    ),
    "v1_order_summary": lambda s, d: views.order_summary(
        b.orders(s, d),
        b.customers(s, d),
        b.restaurants(s, d),
        b.agents(s, d),
        b.payments_made(s, d),
        b.reviews(s, d),
    ),
    "v2_daily_kpi": lambda s, d: views.daily_kpi(b.orders(s, d)),
    "v2_daily_kpi_stream": _daily_kpi_stream,
    "v2_daily_kpi_stream_exact": _daily_kpi_recompute,
    "v2_daily_kpi_stream_bounded": _daily_kpi_bounded,
    "t1_status_log": lambda s, d: changefeed.status_log(_changes(s, d)),
    "t1_status_log_stream": _status_log_stream,
    "t1_status_log_snapshots_stream": _status_log_snapshots_stream,
    "t2_invoices": lambda s, d: changefeed.new_invoices(_changes(s, d)),
    "t2_invoices_stream": _invoices_stream,
    "t3_restaurant_ratings": lambda s, d: changefeed.restaurant_ratings(b.reviews(s, d), b.restaurants(s, d)),
    "t3_restaurant_ratings_stream": _restaurant_ratings_stream,
    "t4_agent_ratings": lambda s, d: changefeed.agent_ratings(b.reviews(s, d), b.agents(s, d)),
    "t4_agent_ratings_stream": _agent_ratings_stream,
    "t5_coupon_usage": lambda s, d: changefeed.coupon_usage(b.order_coupons(s, d), b.coupons(s, d)),
    "t5_coupon_usage_stream": _coupon_uses_stream,
    "t5_coupon_usage_stream_compacted": _coupon_uses_compacted,
    "t6_delivered_at": lambda s, d: changefeed.delivered_at(_changes(s, d)),
    "p1_place_orders": lambda s, d: _placed(s, d).orders.select(
        "order_id",
        "customer_id",
        "restaurant_id",
        "subtotal",
        "discount_amount",
        "tax_amount",
        "total_amount",
        "estimated_delivery",
    ),
    "p1_place_orders_items": lambda s, d: _placed(s, d).order_items,
    "p1_place_orders_payments": lambda s, d: _placed(s, d).payments,
    "p1_place_orders_log": lambda s, d: _placed(s, d).status_log.drop("note"),
    "p1_place_orders_coupons": lambda s, d: _placed(s, d).order_coupons,
    "p1_place_orders_replies": lambda s, d: _placed(s, d, True).replies,
    "p2_status_updates_replies": lambda s, d: _updated(s, d).replies,
    "p2_status_updates_orders": lambda s, d: _updated(s, d).orders.select(
        "order_id", "order_status", "delivered_at"
    ),
    "p2_status_updates_log": lambda s, d: _updated(s, d).log.drop("note"),
    "p2_status_updates_log_notes": lambda s, d: _updated(s, d, True).log,
    "p2_status_updates_old_log": lambda s, d: intake.annotate_log(
        b.status_log(s, d).withColumn("note", F.lit(None).cast("string")), _updated(s, d).notes
    ).select("log_id", "order_id", "status", "note"),
    "p2_status_updates_invoices": lambda s, d: changefeed.new_invoices(_updated(s, d).changes),
    "p2_status_updates_notes": lambda s, d: _updated(s, d).notes,
    "p3_confirm_payments": lambda s, d: _confirmed(s, d).payments.select(
        "order_id", "payment_status", "transaction_ref", "paid_at"
    ),
    "p3_confirm_payments_orders": lambda s, d: _confirmed(s, d).orders.select("order_id", "order_status"),
    "p3_confirm_payments_changes": lambda s, d: _confirmed(s, d).changes.drop("changed_at"),
    "p3_confirm_payments_replies": lambda s, d: _confirmed(s, d, True).replies,
    "p4_assign_agents": lambda s, d: _assigned(s, d).orders.select("order_id", "agent_id"),
    "p4_assign_agents_agents": lambda s, d: _assigned(s, d).agents.select("agent_id", "is_available"),
    "p4_assign_agents_replies": lambda s, d: _assigned(s, d, True).replies,
    "c1_references": lambda s, d: audits.reference_report(_model(s, d)),
    "c1_orphan_positions": lambda s, d: audits.orphan_rows(
        b.locations(s, d), "agent_id", b.agents(s, d), "agent_id"
    ).select("location_id", "agent_id"),
    "c2_duplicates": _duplicates,
    "c2_duplicate_lines": _audit(lambda t: audits.duplicate_keys(t("order_items"), ["order_item_id"])),
    "c3_missing_values": _missing,
    "c3_missing_values_received": _missing_received,
    "c4_value_problems_received": _values_received,
    "c4_review_ranges": _audit(
        lambda t: audits.value_problems("reviews", t("raw_reviews")).select(
            "review_id", F.concat_ws(",", "problems").alias("problems")
        )
    ),
    "c4_value_problems": lambda s, d: audits.value_problems(
        "order_status_log",
        b.status_updates(s, d).select(F.col("seq").alias("log_id"), "order_id", F.col("new_status").alias("status")),
    ).select("log_id", "status", F.concat_ws(",", "problems").alias("problems")),
    "c5_line_totals": _audit(
        lambda t: audits.line_total_problems(t("order_items"))
        .groupBy("order_id")
        .agg(F.count("*").alias("bad_lines"))
    ),
    "c5_order_totals": _audit(lambda t: audits.order_total_problems(t("billed_orders"))),
    "c5_invoice_totals": _audit(lambda t: audits.amount_problems(t("orders"), t("invoices"), "grand_total")),
    "c5_subtotals": _audit(lambda t: audits.subtotal_problems(t("orders"), t("order_items"))),
    "c5_payment_amounts": _audit(
        lambda t: audits.amount_problems(t("orders"), t("collected_payments"), "amount")
    ),
    "c6_cascade_purge": _purge,
    "c6_purge_customers_whole": _purge_customers_whole,
    "c6_purge_restaurants_whole": _purge_restaurants_whole,
    "s1_view_scan": _view_scan,
    "s2_stored_by_month": _stored_by_month,
    "s3_insert_absent": _insert_absent,
    "s3_insert_absent_stored": _inserted_in_store,
    "s4_update_stored": _updated_in_store,
    "s5_daily_view_refreshed": _daily_refreshed,
    "x1_bought_together": lambda s, d: menu.bought_together(b.order_items(s, d)),
    "x2_cohort_by_registration_month": lambda s, d: history.cohorts_by_registration(
        b.customers(s, d), b.orders(s, d)
    ),
    "x3_ltv_distribution": lambda s, d: history.ltv_distribution(b.orders(s, d)),
    "x4_sla_breach": lambda s, d: history.sla_report(b.status_log(s, d), b.sla_limits(s, d)),
    "x4_sla_breach_rows": lambda s, d: history.sla_breaches(b.status_log(s, d), b.sla_limits(s, d)),
    "x5_category_performance": lambda s, d: menu.category_performance(
        b.order_items(s, d), b.menu_items(s, d), b.menu_categories(s, d), b.orders(s, d)
    ),
    "x6_pareto_cut": lambda s, d: revenue.restaurant_pareto(
        b.suborders(s, d), b.restaurants(s, d), threshold=80
    ),
    "x7_cumulative_funnel": lambda s, d: history.cumulative_funnel(b.status_log(s, d)),
    "x8_strict_transitions": lambda s, d: history.strict_transitions(b.orders(s, d), b.status_updates(s, d)),
    "x9_latest_position_stored": _positions_stored,
    "x9_latest_agent_position": lambda s, d: history.latest_agent_position(b.locations(s, d)).drop("order_id"),
}


def _compared(query: Query) -> Query:
    return lambda spark, sf_dir: plain(query(tune(spark), sf_dir))


def queries() -> dict[str, Query]:
    return {name: _compared(query) for name, query in QUERIES.items()}
