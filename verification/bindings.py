"""The given tables seen as the marketplace model.

Columns the given tables lack are derived from their keys by plain arithmetic,
so every table here grows with its source. ``model_sql`` states the same for
another SQL engine, in whole cents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# How codes of the given tables read in the model.
PAYMENT_METHOD = {
    "1-URGENT": "upi",
    "2-HIGH": "card",
    "3-MEDIUM": "netbanking",
    "4-NOT SPECIFIED": "cod",
    "5-LOW": "wallet",
}
EVENT_STATUS = {
    "signup": "placed",
    "view": "confirmed",
    "click": "preparing",
    "purchase": "delivered",
    "error": "cancelled",
}
OPEN_STAGES = ("placed", "confirmed", "preparing", "ready_for_pickup", "out_for_delivery")


# The columns of the given tables that are read; nothing is inferred.
GIVEN = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double",
}


def _case(column: str, mapping: dict[str, str]) -> str:
    whens = " ".join(f"when '{code}' then '{meaning}'" for code, meaning in mapping.items())
    return f"case {column} {whens} end"


def _amount(cents: str) -> str:
    # Exact: whole cents and their hundredth, rounded to two places, survive the double in between.
    return f"cast({cents} / 100D as decimal(10,2))"


# Literal branches only: a filter on the status then folds to one the scan can take.
_STATUS = (
    "case when o_orderstatus = 'F' then 'delivered' when o_orderstatus = 'P' then 'cancelled' "
    + " ".join(f"when o_orderkey % 5 = {i} then '{s}'" for i, s in enumerate(OPEN_STAGES[:-1]))
    + f" else '{OPEN_STAGES[-1]}' end"
)
_TOTAL = "cast(round(o_totalprice * 100) as bigint)"
_SUBTOTAL = f"((({_TOTAL} + (o_custkey % 5) * 500 - 3000) * 20 + 10) div 21)"
_TAX = f"(({_SUBTOTAL} * 5 + 50) div 100)"
_PLACED = "(o_orderdate + make_dt_interval(0, 0, cast(o_orderkey % 1440 as int)))"
_AGENT = "case when o_orderkey % 10 <> 0 then o_custkey div 15 end"
_CATEGORY = "(p_partkey div 20) * 100 + cast(substring(p_brand, 7) as bigint)"


def _given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(GIVEN[name]).parquet(f"{sf_dir}/{name}.parquet")


def stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table as a stream of its Parquet files."""
    reader = spark.readStream.schema(GIVEN[name]).option("pathGlobFilter", f"{name}.parquet")
    return reader.parquet(sf_dir)


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _given(spark, sf_dir, "customer").selectExpr(
        "c_custkey as customer_id",
        "c_name as full_name",
        "concat('user', c_custkey, '@example.com') as email",
        "case when c_acctbal >= 0 then concat('+91 ', c_custkey div 2) end as phone",
        "timestamp_ntz'1994-01-01 00:00:00' + make_dt_interval(cast(c_custkey % 900 as int)) as created_at",
    )


def restaurants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _given(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey as restaurant_id",
        "s_name as name",
        "concat('CITY_', s_nationkey) as city",
        "cast(cast(s_suppkey % 401 + 100 as decimal(5,0)) / 100 as decimal(3,2)) as avg_rating",
        "cast((s_suppkey % 14) * 3600 as int) as opening_time",
        "cast((s_suppkey % 14 + 12) % 24 * 3600 as int) as closing_time",
        "cast(s_suppkey % 10 <> 0 as int) as is_active",
        "cast(12 + s_suppkey % 9 as decimal(5,2)) as commission_pct",
    )


def agents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _given(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey as agent_id",
        "concat('Agent ', s_suppkey) as full_name",
        "case s_suppkey % 3 when 0 then 'bike' when 1 then 'bicycle' else 'scooter' end as vehicle_type",
        "cast(cast(s_suppkey * 7 % 401 + 100 as decimal(5,0)) / 100 as decimal(3,2)) as avg_rating",
        "cast(s_suppkey % 4 <> 0 as int) as is_available",
        "cast(s_suppkey % 6 <> 0 as int) as is_active",
    )


def menu_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _given(spark, sf_dir, "part").selectExpr(
        "p_partkey as item_id",
        "p_partkey div 20 as restaurant_id",
        f"{_CATEGORY} as category_id",
        "p_name as item_name",
        "cast(p_retailprice as decimal(10,2)) as price",
        "cast(p_size % 2 as int) as is_veg",
    )


def menu_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    categories = _given(spark, sf_dir, "part").selectExpr(
        f"{_CATEGORY} as category_id", "p_partkey div 20 as restaurant_id", "p_brand as category_name"
    )
    return categories.distinct()


def orders_of(orders: DataFrame) -> DataFrame:
    """One model order per given order."""
    return orders.selectExpr(
        "o_orderkey as order_id",
        "o_custkey as customer_id",
        "o_orderkey div 150 as restaurant_id",
        f"{_AGENT} as agent_id",
        "o_custkey as delivery_address_id",
        f"{_STATUS} as order_status",
        f"{_amount(_SUBTOTAL)} as subtotal",
        "cast('30.00' as decimal(10,2)) as delivery_fee",
        f"{_amount(f'({_SUBTOTAL} + 3000 + {_TAX} - {_TOTAL})')} as discount_amount",
        f"{_amount(_TAX)} as tax_amount",
        "cast(o_totalprice as decimal(10,2)) as total_amount",
        f"case when o_orderkey % 13 <> 0 then {_PLACED} + interval 45 minutes end as estimated_delivery",
        f"{_PLACED} as placed_at",
        f"case when o_orderstatus = 'F' and o_orderkey % 97 <> 0 then {_PLACED} + make_dt_interval("
        "0, 0, cast(15 + o_custkey % 60 as int), cast(o_orderkey % 60 as decimal(8,6))) end as delivered_at",
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_of(_given(spark, sf_dir, "orders"))


def suborders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One model order row per order line, at the line's supplier; ``order_id`` repeats."""
    lines = _given(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey as order_id",
        "l_suppkey as restaurant_id",
        "cast(l_extendedprice as decimal(10,2)) as total_amount",
    )
    return lines.join(orders(spark, sf_dir).select("order_id", "order_status"), "order_id")


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    cents, quantity = "cast(round(l_extendedprice * 100) as bigint)", "cast(l_quantity as bigint)"
    unit = f"((2 * {cents} + {quantity}) div (2 * {quantity}))"
    return _given(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey * 10 + l_linenumber as order_item_id",
        "l_orderkey as order_id",
        "l_partkey as item_id",
        "cast(l_quantity as int) as quantity",
        f"{_amount(unit)} as unit_price",
        "cast(l_extendedprice as decimal(10,2)) as item_total",
    )


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A payment for every order."""
    amount = "cast(o_totalprice as decimal(10,2))"
    refunded = "o_orderstatus = 'P' and o_orderkey % 2 = 0"
    return _given(spark, sf_dir, "orders").selectExpr(
        "o_orderkey as payment_id",
        "o_orderkey as order_id",
        f"{_case('o_orderpriority', PAYMENT_METHOD)} as payment_method",
        "case when o_orderstatus = 'F' then 'success' when o_orderstatus = 'O' then 'pending' "
        f"when {refunded} then 'refunded' else 'failed' end as payment_status",
        "case when o_orderstatus = 'F' then concat('REF', o_orderkey) end as transaction_ref",
        f"{amount} as amount",
        "case when o_orderstatus = 'F' then o_orderdate end as paid_at",
        f"case when {refunded} then {amount} else cast(0 as decimal(10,2)) end as refund_amount",
    )


def payments_made(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments as reports meet them where some are missing: nobody pays cash for a failed delivery."""
    return payments(spark, sf_dir).where("payment_method <> 'cod' or payment_status <> 'failed'")


def collected_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments as the till has them: cash comes in whole units, halves up."""
    return payments(spark, sf_dir).selectExpr(
        "payment_id",
        "order_id",
        "cast(if(payment_method = 'cod', round(amount), amount) as decimal(10,2)) as amount",
    )


def billed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a till bills them that cuts the tax to whole cents instead of rounding it."""
    cut = "cast(floor(subtotal * 5) / 100 as decimal(10,2))"
    kept = orders(spark, sf_dir).selectExpr("*", f"{cut} as cut_tax").drop("tax_amount")
    return kept.withColumnRenamed("cut_tax", "tax_amount")


def invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An invoice per delivered order, its total printed to one place."""
    return _given(spark, sf_dir, "orders").where("o_orderstatus = 'F'").selectExpr(
        "o_orderkey as invoice_id",
        "o_orderkey as order_id",
        "concat('inv-', lower(o_orderpriority), '-', o_custkey) as invoice_number",
        f"cast({_TOTAL} div 10 / 10D as decimal(10,2)) as grand_total",
        "o_orderdate as issued_at",
    )


def customer_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One address per customer; the line is unknown where nothing was ever paid in."""
    return _given(spark, sf_dir, "customer").selectExpr(
        "c_custkey as address_id",
        "c_custkey + c_nationkey as customer_id",
        "case when c_acctbal >= 0 then concat('Street ', c_nationkey) end as address_line1",
    )


def cuisines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cuisine per nation; names repeat but for their case."""
    return _given(spark, sf_dir, "nation").selectExpr(
        "cast(n_nationkey as bigint) as cuisine_id",
        "if(n_nationkey % 2 = 0, upper(substring(n_name, 1, 6)), lower(substring(n_name, 1, 6))) as cuisine_name",
    )


def restaurant_cuisines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _given(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey as restaurant_id", "cast(s_nationkey + s_suppkey % 3 as bigint) as cuisine_id"
    )


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews as an app sends them, ratings unchecked: one per event."""
    return _given(spark, sf_dir, "events").selectExpr(
        "event_id as review_id",
        "user_id as order_id",
        "user_id as customer_id",
        "user_id div 15 as restaurant_id",
        "cast(null as bigint) as agent_id",
        "cast(value / 20 as int) as food_rating",
        "case when event_type <> 'error' then cast(event_id % 7 as int) end as delivery_rating",
        "case when event_type <> 'signup' then ts end as created_at",
    )


def reviews_of(orders: DataFrame) -> DataFrame:
    """A review for every delivered order; one in four gives no delivery rating."""
    return orders.where("o_orderstatus = 'F'").selectExpr(
        "o_orderkey as review_id",
        "o_orderkey as order_id",
        "o_custkey as customer_id",
        "o_orderkey div 150 as restaurant_id",
        f"{_AGENT} as agent_id",
        "cast(1 + o_custkey % 5 as int) as food_rating",
        "case when o_orderkey % 4 <> 0 then cast(1 + o_orderkey % 5 as int) end as delivery_rating",
    )


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reviews_of(_given(spark, sf_dir, "orders"))


def coupons(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = "n_nationkey"
    return _given(spark, sf_dir, "nation").selectExpr(
        f"cast({k} as bigint) as coupon_id",
        f"concat('SAVE', {k}) as code",
        f"if({k} % 2 = 0, 'flat', 'percentage') as discount_type",
        f"cast({k} + if({k} % 2 = 0, 50, 5) as decimal(10,2)) as discount_value",
        f"cast({k} * 10000 as decimal(10,2)) as min_order_value",
        f"cast(case when {k} % 3 <> 0 then {k} + 1000 end as decimal(10,2)) as max_discount",
        f"cast(case when {k} % 4 <> 0 then {k} + 20 end as bigint) as usage_limit",
        f"cast({k} % 3 as bigint) as used_count",
        f"date_add(date'1995-01-01', {k} * 30) as valid_from",
        f"date_add(date'2000-01-01', {k} * 20) as valid_until",
        f"cast({k} % 11 <> 0 as int) as is_active",
    )


def order_coupons_of(orders: DataFrame) -> DataFrame:
    """Every order used a coupon."""
    return orders.selectExpr(
        "o_orderkey as order_id",
        "o_custkey % 25 as coupon_id",
        f"{_amount('(o_orderkey % 5000)')} as discount_applied",
    )


def order_coupons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_coupons_of(_given(spark, sf_dir, "orders"))


def snapshots_of(events: DataFrame) -> DataFrame:
    """A change feed without old images: each event sets its user's order to a status."""
    amount = "cast(value as decimal(10,2))"
    return events.selectExpr(
        "event_id as seq",
        "user_id as order_id",
        f"{_case('event_type', EVENT_STATUS)} as new_status",
        "ts as changed_at",
        f"{amount} as subtotal",
        "cast('0.00' as decimal(10,2)) as tax_amount",
        "cast('30.00' as decimal(10,2)) as delivery_fee",
        "cast('0.00' as decimal(10,2)) as discount_amount",
        f"cast({amount} + 30 as decimal(10,2)) as total_amount",
    )


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots_of(_given(spark, sf_dir, "events"))


def imaged(feed: DataFrame) -> DataFrame:
    """The same feed with an old image on each row, for stateless use: derived from the row alone."""
    whens = " ".join(f"when {i} then '{s}'" for i, s in enumerate(EVENT_STATUS.values()))
    return feed.selectExpr("*", f"case seq % 5 {whens} end as old_status")


def status_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots(spark, sf_dir).selectExpr(
        "seq as log_id", "order_id", "new_status as status", "changed_at"
    )


def sla_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A limit per status seen in the log, longer for longer names."""
    seen = status_log(spark, sf_dir).select("status").distinct()
    return seen.selectExpr("status", "cast(length(status) * 60 as bigint) as limit_minutes")


def locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _given(spark, sf_dir, "events").selectExpr(
        "event_id as location_id",
        "user_id as agent_id",
        "cast(null as bigint) as order_id",
        "cast(17 + cast(event_id % 1000 as decimal(4,0)) / 1000 as decimal(10,8)) as latitude",
        "cast(78 + cast(event_id % 777 as decimal(4,0)) / 1000 as decimal(11,8)) as longitude",
        "ts as recorded_at",
    )


def order_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each given order asks to be placed; codes come in other case and with trailing blanks."""
    return _given(spark, sf_dir, "orders").selectExpr(
        "o_orderkey as seq",
        "o_custkey as customer_id",
        "o_orderkey div 140 as restaurant_id",
        "o_custkey as address_id",
        f"{_case('o_orderpriority', PAYMENT_METHOD)} as payment_method",
        "cast(null as string) as special_notes",
        "case o_orderkey % 3 when 0 then null when 1 then concat('save', o_custkey % 30) "
        "else concat('Save', o_custkey % 30, ' ') end as coupon_code",
        "o_orderdate + make_dt_interval(0, 0, cast(o_orderkey * 37 % 1440 as int)) as requested_at",
    )


def cart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_items(spark, sf_dir).selectExpr("order_id as seq", "item_id", "quantity", "unit_price")


def status_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three updates in a row per order, some for unknown orders, some with a note or an unknown status."""
    return _given(spark, sf_dir, "events").selectExpr(
        "event_id as seq",
        "(event_id div 3) * 5 as order_id",
        f"if(event_id % 50 = 7, 'lost', {_case('event_type', EVENT_STATUS)}) as new_status",
        "case event_id % 4 when 0 then concat('note ', event_id) when 1 then '' end as note",
        "ts as changed_at",
    )


def confirmations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _given(spark, sf_dir, "events").selectExpr(
        "event_id as seq",
        "(event_id div 2) * 4 as order_id",
        "concat('TX', event_id) as transaction_ref",
        "ts as confirmed_at",
    )


def assignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _given(spark, sf_dir, "events").selectExpr(
        "event_id as seq", "event_id div 2 as order_id", "user_id as agent_id"
    )
