"""The data model: columns, keys, references and value rules of the 17 tables.

Enforcement on write has no Spark counterpart; ``operators.audits``
turns each rule here into a job that finds the rows breaking it.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from .functions import lifecycle as life

# Fixed value: tax as a share of the subtotal.
SUBTOTAL_TAX = "0.05"


@dataclass(frozen=True)
class Parent:
    """A reference from ``column`` to the single-column key of ``table``."""

    column: str
    table: str
    cascade: bool = False


@dataclass(frozen=True)
class Table:
    """``columns`` is a Spark DDL string; ``optional`` lists the columns that may be NULL."""

    columns: str
    key: tuple[str, ...]
    optional: frozenset[str] = frozenset()
    unique: tuple[tuple[str, ...], ...] = ()
    parents: tuple[Parent, ...] = ()
    domains: dict[str, tuple[str, ...]] = field(default_factory=dict)
    ranges: dict[str, tuple[int, int]] = field(default_factory=dict)

    @property
    def names(self) -> list[str]:
        return [part.split()[0] for part in _split(self.columns)]

    @property
    def required(self) -> list[str]:
        return [name for name in self.names if name not in self.optional]


def _split(ddl: str) -> list[str]:
    """Column definitions of a DDL string; commas inside decimal(p,s) do not count."""
    parts, depth, current = [], 0, ""
    for ch in ddl:
        depth += (ch == "(") - (ch == ")")
        if ch == "," and depth == 0:
            parts.append(current.strip())
            current = ""
        else:
            current += ch
    return [*parts, current.strip()]


def _optional(names: str) -> frozenset[str]:
    return frozenset(names.split())


# The data model. Unsigned 32-bit keys need bigint; TIME is seconds of the day;
# DATETIME has no zone.
TABLES: dict[str, Table] = {
    "customers": Table(
        "customer_id bigint, full_name string, email string, phone string, is_active int, "
        "created_at timestamp_ntz, updated_at timestamp_ntz",
        key=("customer_id",),
        unique=(("email",), ("phone",)),
    ),
    "customer_addresses": Table(
        "address_id bigint, customer_id bigint, label string, address_line1 string, "
        "address_line2 string, city string, state string, pincode string, "
        "latitude decimal(10,8), longitude decimal(11,8), is_default int, created_at timestamp_ntz",
        key=("address_id",),
        optional=_optional("address_line2 latitude longitude"),
        parents=(Parent("customer_id", "customers", cascade=True),),
    ),
    "cuisines": Table(
        "cuisine_id bigint, cuisine_name string",
        key=("cuisine_id",),
        unique=(("cuisine_name",),),
    ),
    "restaurants": Table(
        "restaurant_id bigint, name string, owner_name string, email string, phone string, "
        "address_line1 string, city string, state string, pincode string, "
        "latitude decimal(10,8), longitude decimal(11,8), avg_rating decimal(3,2), "
        "total_ratings bigint, opening_time int, closing_time int, is_active int, "
        "commission_pct decimal(5,2), created_at timestamp_ntz, updated_at timestamp_ntz",
        key=("restaurant_id",),
        optional=_optional("latitude longitude"),
        unique=(("email",),),
    ),
    "restaurant_cuisines": Table(
        "restaurant_id bigint, cuisine_id bigint",
        key=("restaurant_id", "cuisine_id"),
        parents=(Parent("restaurant_id", "restaurants", cascade=True), Parent("cuisine_id", "cuisines")),
    ),
    "menu_categories": Table(
        "category_id bigint, restaurant_id bigint, category_name string, display_order int, is_active int",
        key=("category_id",),
        parents=(Parent("restaurant_id", "restaurants", cascade=True),),
    ),
    "menu_items": Table(
        "item_id bigint, restaurant_id bigint, category_id bigint, item_name string, "
        "description string, price decimal(10,2), is_veg int, is_available int, "
        "prep_time_min int, image_url string, created_at timestamp_ntz, updated_at timestamp_ntz",
        key=("item_id",),
        optional=_optional("description image_url"),
        parents=(
            Parent("restaurant_id", "restaurants", cascade=True),
            Parent("category_id", "menu_categories"),
        ),
    ),
    "delivery_agents": Table(
        "agent_id bigint, full_name string, phone string, vehicle_type string, "
        "vehicle_number string, avg_rating decimal(3,2), is_available int, is_active int, "
        "created_at timestamp_ntz",
        key=("agent_id",),
        optional=_optional("vehicle_number"),
        unique=(("phone",),),
        domains={"vehicle_type": life.VEHICLE_TYPES},
    ),
    "orders": Table(
        "order_id bigint, customer_id bigint, restaurant_id bigint, agent_id bigint, "
        "delivery_address_id bigint, order_status string, subtotal decimal(10,2), "
        "delivery_fee decimal(10,2), discount_amount decimal(10,2), tax_amount decimal(10,2), "
        "total_amount decimal(10,2), special_instructions string, "
        "estimated_delivery timestamp_ntz, placed_at timestamp_ntz, delivered_at timestamp_ntz",
        key=("order_id",),
        optional=_optional("agent_id special_instructions estimated_delivery delivered_at"),
        parents=(
            Parent("customer_id", "customers"),
            Parent("restaurant_id", "restaurants"),
            Parent("agent_id", "delivery_agents"),
            Parent("delivery_address_id", "customer_addresses"),
        ),
        domains={"order_status": life.ORDER_STATUSES},
    ),
    "order_items": Table(
        "order_item_id bigint, order_id bigint, item_id bigint, quantity int, "
        "unit_price decimal(10,2), item_total decimal(10,2)",
        key=("order_item_id",),
        parents=(Parent("order_id", "orders", cascade=True), Parent("item_id", "menu_items")),
    ),
    "coupons": Table(
        "coupon_id bigint, code string, discount_type string, discount_value decimal(10,2), "
        "min_order_value decimal(10,2), max_discount decimal(10,2), usage_limit bigint, "
        "used_count bigint, valid_from date, valid_until date, is_active int",
        key=("coupon_id",),
        optional=_optional("max_discount usage_limit"),
        unique=(("code",),),
        domains={"discount_type": life.DISCOUNT_TYPES},
    ),
    "order_coupons": Table(
        "order_id bigint, coupon_id bigint, discount_applied decimal(10,2)",
        key=("order_id", "coupon_id"),
        parents=(Parent("order_id", "orders"), Parent("coupon_id", "coupons")),
    ),
    "order_status_log": Table(
        "log_id bigint, order_id bigint, status string, changed_at timestamp_ntz, note string",
        key=("log_id",),
        optional=_optional("note"),
        parents=(Parent("order_id", "orders", cascade=True),),
        domains={"status": life.ORDER_STATUSES},
    ),
    "agent_locations": Table(
        "location_id bigint, agent_id bigint, order_id bigint, latitude decimal(10,8), "
        "longitude decimal(11,8), recorded_at timestamp_ntz",
        key=("location_id",),
        optional=_optional("order_id"),
        parents=(Parent("agent_id", "delivery_agents"), Parent("order_id", "orders")),
    ),
    "payments": Table(
        "payment_id bigint, order_id bigint, payment_method string, payment_status string, "
        "transaction_ref string, amount decimal(10,2), paid_at timestamp_ntz, "
        "refund_amount decimal(10,2), refunded_at timestamp_ntz",
        key=("payment_id",),
        optional=_optional("transaction_ref paid_at refunded_at"),
        unique=(("order_id",), ("transaction_ref",)),
        parents=(Parent("order_id", "orders"),),
        domains={"payment_method": life.PAYMENT_METHODS, "payment_status": life.PAYMENT_STATUSES},
    ),
    "invoices": Table(
        "invoice_id bigint, order_id bigint, invoice_number string, subtotal decimal(10,2), "
        "tax_amount decimal(10,2), delivery_fee decimal(10,2), discount_amount decimal(10,2), "
        "grand_total decimal(10,2), issued_at timestamp_ntz",
        key=("invoice_id",),
        unique=(("order_id",), ("invoice_number",)),
        parents=(Parent("order_id", "orders"),),
    ),
    "reviews": Table(
        "review_id bigint, order_id bigint, customer_id bigint, restaurant_id bigint, "
        "agent_id bigint, food_rating int, delivery_rating int, review_text string, "
        "created_at timestamp_ntz",
        key=("review_id",),
        optional=_optional("agent_id delivery_rating review_text"),
        unique=(("order_id",),),
        parents=(
            Parent("order_id", "orders"),
            Parent("customer_id", "customers"),
            Parent("restaurant_id", "restaurants"),
            Parent("agent_id", "delivery_agents"),
        ),
        ranges={"food_rating": (1, 5), "delivery_rating": (1, 5)},
    ),
}

# The texts matched whatever their case, accents and trailing blanks when keys are audited.
COLLATED_KEYS = frozenset({"email", "phone", "code", "cuisine_name", "transaction_ref", "invoice_number"})
