"""``bindings`` in SQL: one CTE per model table, money in whole cents (``..._c``)."""

from __future__ import annotations

_TOTAL = "CAST(round(o_totalprice * 100) AS BIGINT)"
_SUBTOTAL = f"((({_TOTAL} + (o_custkey % 5) * 500 - 3000) * 20 + 10) // 21)"
_TAX = f"(({_SUBTOTAL} * 5 + 50) // 100)"
_PLACED = "(o_orderdate + to_minutes(CAST(o_orderkey % 1440 AS INTEGER)))"
_METHOD = (
    "CASE o_orderpriority WHEN '1-URGENT' THEN 'upi' WHEN '2-HIGH' THEN 'card' "
    "WHEN '3-MEDIUM' THEN 'netbanking' WHEN '4-NOT SPECIFIED' THEN 'cod' WHEN '5-LOW' THEN 'wallet' END"
)
_EVENT = (
    "CASE event_type WHEN 'signup' THEN 'placed' WHEN 'view' THEN 'confirmed' "
    "WHEN 'click' THEN 'preparing' WHEN 'purchase' THEN 'delivered' WHEN 'error' THEN 'cancelled' END"
)
_AGENT = "CASE WHEN o_orderkey % 10 <> 0 THEN o_custkey // 15 END"

TABLES: dict[str, str] = {
    "m_customers": """
        SELECT c_custkey AS customer_id, c_name AS full_name,
               'user' || c_custkey || '@example.com' AS email,
               CASE WHEN c_acctbal >= 0 THEN '+91 ' || (c_custkey // 2) END AS phone,
               TIMESTAMP '1994-01-01 00:00:00' + to_days(CAST(c_custkey % 900 AS INTEGER)) AS created_at
        FROM customer""",
    "m_restaurants": """
        SELECT s_suppkey AS restaurant_id, s_name AS name, 'CITY_' || s_nationkey AS city,
               s_suppkey % 401 + 100 AS avg_rating_c,
               (s_suppkey % 14) * 3600 AS opening_time, (s_suppkey % 14 + 12) % 24 * 3600 AS closing_time,
               CASE WHEN s_suppkey % 10 <> 0 THEN 1 ELSE 0 END AS is_active,
               12 + s_suppkey % 9 AS commission_pct
        FROM supplier""",
    "m_agents": """
        SELECT s_suppkey AS agent_id, 'Agent ' || s_suppkey AS full_name,
               CASE s_suppkey % 3 WHEN 0 THEN 'bike' WHEN 1 THEN 'bicycle' ELSE 'scooter' END AS vehicle_type,
               s_suppkey * 7 % 401 + 100 AS avg_rating_c,
               CASE WHEN s_suppkey % 4 <> 0 THEN 1 ELSE 0 END AS is_available,
               CASE WHEN s_suppkey % 6 <> 0 THEN 1 ELSE 0 END AS is_active
        FROM supplier""",
    "m_menu_items": """
        SELECT p_partkey AS item_id, p_partkey // 20 AS restaurant_id,
               (p_partkey // 20) * 100 + CAST(substr(p_brand, 7) AS BIGINT) AS category_id,
               p_name AS item_name, p_size % 2 AS is_veg
        FROM part""",
    "m_menu_categories": """
        SELECT DISTINCT (p_partkey // 20) * 100 + CAST(substr(p_brand, 7) AS BIGINT) AS category_id,
               p_brand AS category_name
        FROM part""",
    "m_orders": f"""
        SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderkey // 150 AS restaurant_id,
               {_AGENT} AS agent_id, o_custkey AS delivery_address_id,
               CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'P' THEN 'cancelled'
                    ELSE CASE o_orderkey % 5 WHEN 0 THEN 'placed' WHEN 1 THEN 'confirmed'
                         WHEN 2 THEN 'preparing' WHEN 3 THEN 'ready_for_pickup'
                         ELSE 'out_for_delivery' END END AS order_status,
               {_SUBTOTAL} AS subtotal_c, 3000 AS fee_c,
               {_SUBTOTAL} + 3000 + {_TAX} - {_TOTAL} AS discount_c, {_TAX} AS tax_c, {_TOTAL} AS total_c,
               CASE WHEN o_orderkey % 13 <> 0 THEN {_PLACED} + INTERVAL 45 MINUTE END AS estimated_delivery,
               {_PLACED} AS placed_at,
               CASE WHEN o_orderstatus = 'F' AND o_orderkey % 97 <> 0 THEN {_PLACED}
                    + to_minutes(CAST(15 + o_custkey % 60 AS INTEGER))
                    + to_seconds(CAST(o_orderkey % 60 AS INTEGER)) END AS delivered_at
        FROM orders""",
    "m_suborders": """
        SELECT l_orderkey AS order_id, l_suppkey AS restaurant_id,
               CAST(round(l_extendedprice * 100) AS BIGINT) AS total_c, order_status
        FROM lineitem JOIN m_orders ON l_orderkey = order_id""",
    "m_order_items": """
        SELECT l_orderkey * 10 + l_linenumber AS order_item_id, l_orderkey AS order_id, l_partkey AS item_id,
               CAST(l_quantity AS BIGINT) AS quantity,
               (2 * CAST(round(l_extendedprice * 100) AS BIGINT) + CAST(l_quantity AS BIGINT))
                   // (2 * CAST(l_quantity AS BIGINT)) AS unit_price_c,
               CAST(round(l_extendedprice * 100) AS BIGINT) AS item_total_c
        FROM lineitem""",
    "m_payments": f"""
        SELECT o_orderkey AS payment_id, o_orderkey AS order_id, {_METHOD} AS payment_method,
               CASE WHEN o_orderstatus = 'F' THEN 'success' WHEN o_orderstatus = 'O' THEN 'pending'
                    WHEN o_orderstatus = 'P' AND o_orderkey % 2 = 0 THEN 'refunded' ELSE 'failed' END
                   AS payment_status,
               CASE WHEN o_orderstatus = 'F' THEN 'REF' || o_orderkey END AS transaction_ref,
               {_TOTAL} AS amount_c,
               CASE WHEN o_orderstatus = 'F' THEN o_orderdate END AS paid_at,
               CASE WHEN o_orderstatus = 'P' AND o_orderkey % 2 = 0 THEN {_TOTAL} ELSE 0 END AS refund_c
        FROM orders""",
    "m_payments_made": """
        SELECT * FROM m_payments WHERE NOT (payment_method = 'cod' AND payment_status = 'failed')""",
    "m_invoices": f"""
        SELECT o_orderkey AS invoice_id, o_orderkey AS order_id,
               'inv-' || lower(o_orderpriority) || '-' || o_custkey AS invoice_number,
               {_TOTAL} // 10 * 10 AS grand_c, o_orderdate AS issued_at
        FROM orders WHERE o_orderstatus = 'F'""",
    "m_addresses": """
        SELECT c_custkey AS address_id, c_custkey + c_nationkey AS customer_id,
               CASE WHEN c_acctbal >= 0 THEN 'Street ' || c_nationkey END AS address_line1
        FROM customer""",
    "m_cuisines": """
        SELECT n_nationkey AS cuisine_id, lower(n_name)[1:6] AS cuisine_key FROM nation""",
    "m_served": "SELECT s_suppkey AS restaurant_id, s_nationkey + s_suppkey % 3 AS cuisine_id FROM supplier",
    "m_raw_reviews": """
        SELECT event_id AS review_id, user_id AS order_id, user_id // 15 AS restaurant_id,
               CAST(trunc(value / 20) AS INTEGER) AS food_rating,
               CASE WHEN event_type <> 'error' THEN event_id % 7 END AS delivery_rating,
               CASE WHEN event_type <> 'signup' THEN ts END AS created_at
        FROM events""",
    "m_reviews": f"""
        SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderkey // 150 AS restaurant_id,
               {_AGENT} AS agent_id, 1 + o_custkey % 5 AS food_rating,
               CASE WHEN o_orderkey % 4 <> 0 THEN 1 + o_orderkey % 5 END AS delivery_rating
        FROM orders WHERE o_orderstatus = 'F'""",
    "m_coupons": """
        SELECT CAST(n_nationkey AS BIGINT) AS coupon_id, 'SAVE' || n_nationkey AS code,
               CASE WHEN n_nationkey % 2 = 0 THEN 'flat' ELSE 'percentage' END AS discount_type,
               CASE WHEN n_nationkey % 2 = 0 THEN n_nationkey + 50 ELSE n_nationkey + 5 END AS discount_value,
               CASE WHEN n_nationkey % 3 <> 0 THEN n_nationkey + 1000 END AS max_discount,
               CASE WHEN n_nationkey % 4 <> 0 THEN n_nationkey + 20 END AS usage_limit,
               n_nationkey % 3 AS used_count,
               CAST(DATE '1995-01-01' + n_nationkey * 30 AS DATE) AS valid_from,
               CAST(DATE '2000-01-01' + n_nationkey * 20 AS DATE) AS valid_until,
               n_nationkey % 11 <> 0 AS is_active
        FROM nation""",
    "m_order_coupons": """
        SELECT o_orderkey AS order_id, o_custkey % 25 AS coupon_id, o_orderkey % 5000 AS discount_c
        FROM orders""",
    "m_snapshots": f"""
        SELECT event_id AS seq, user_id AS order_id, {_EVENT} AS new_status, ts AS changed_at,
               CAST(round(value * 100) AS BIGINT) AS subtotal_c
        FROM events""",
    "m_changes": """
        SELECT *, lag(new_status) OVER (PARTITION BY order_id ORDER BY seq) AS old_status
        FROM m_snapshots""",
    "m_imaged": """
        SELECT *, CASE seq % 5 WHEN 0 THEN 'placed' WHEN 1 THEN 'confirmed' WHEN 2 THEN 'preparing'
                  WHEN 3 THEN 'delivered' ELSE 'cancelled' END AS old_status
        FROM m_snapshots""",
    "m_log": "SELECT seq AS log_id, order_id, new_status AS status, changed_at FROM m_snapshots",
    "m_limits": "SELECT DISTINCT status, length(status) * 60 AS limit_minutes FROM m_log",
    "m_locations": """
        SELECT event_id AS location_id, user_id AS agent_id, (17000 + event_id % 1000) / 1000.0 AS latitude,
               (78000 + event_id % 777) / 1000.0 AS longitude, ts AS recorded_at
        FROM events""",
    "m_requests": f"""
        SELECT o_orderkey AS seq, o_custkey AS customer_id, o_orderkey // 140 AS restaurant_id,
               {_METHOD} AS payment_method,
               CASE o_orderkey % 3 WHEN 0 THEN NULL WHEN 1 THEN 'save' || (o_custkey % 30)
                    ELSE 'Save' || (o_custkey % 30) || ' ' END AS coupon_code,
               o_orderdate + to_minutes(CAST(o_orderkey * 37 % 1440 AS INTEGER)) AS requested_at
        FROM orders""",
    "m_updates": f"""
        SELECT event_id AS seq, (event_id // 3) * 5 AS order_id,
               CASE WHEN event_id % 50 = 7 THEN 'lost' ELSE {_EVENT} END AS new_status,
               CASE event_id % 4 WHEN 0 THEN 'note ' || event_id WHEN 1 THEN '' END AS note,
               ts AS changed_at
        FROM events""",
    "m_confirmations": """
        SELECT event_id AS seq, (event_id // 2) * 4 AS order_id, 'TX' || event_id AS transaction_ref,
               ts AS confirmed_at
        FROM events""",
    "m_assignments": "SELECT event_id AS seq, event_id // 2 AS order_id, user_id AS agent_id FROM events",
}

_NEEDS = {
    "m_suborders": ["m_orders"],
    "m_payments_made": ["m_payments"],
    "m_changes": ["m_snapshots"],
    "m_imaged": ["m_snapshots"],
    "m_log": ["m_snapshots"],
    "m_limits": ["m_log"],
}


def with_tables(sql: str) -> str:
    """``sql`` (which may start with its own CTEs as 'WITH name AS ...') on top of the model CTEs it names."""
    wanted: list[str] = []

    def add(name: str) -> None:
        for other in _NEEDS.get(name, []):
            add(other)
        if name not in wanted:
            wanted.append(name)

    for name in TABLES:
        if name in sql:
            add(name)
    ctes = ",\n".join(f"{name} AS ({TABLES[name]})" for name in wanted)
    body = sql.strip()
    if not wanted:
        return body
    if body.startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {ctes},\n{body[15:]}"
    if body.startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"


def ratio(num: str, den: str, places: int) -> str:
    """num / den rounded half up to ``places`` in whole numbers, as DOUBLE; NULL when den is 0."""
    n, d = f"CAST({num} AS HUGEINT)", f"CAST({den} AS HUGEINT)"
    scale = 10**places
    return (
        f"CASE WHEN {d} <> 0 THEN CAST(sign({n}) * ((2 * abs({n}) * {scale} + {d}) // (2 * {d})) AS DOUBLE)"
        f" / {scale}.0 END"
    )


def money(cents: str) -> str:
    return f"CAST({cents} AS DOUBLE) / 100.0"


def mean_money(cents: str, n: str) -> str:
    """Mean of an amount in cents, in units with two places."""
    c, d = f"CAST({cents} AS HUGEINT)", f"CAST({n} AS HUGEINT)"
    return f"CASE WHEN {d} <> 0 THEN CAST(sign({c}) * ((2 * abs({c}) + {d}) // (2 * {d})) AS DOUBLE) / 100.0 END"


def percent(part: str, whole: str, places: int = 2) -> str:
    return ratio(f"100 * CAST({part} AS HUGEINT)", whole, places)


def minutes(start: str, end: str) -> str:
    return f"date_sub('minute', {start}, {end})"
