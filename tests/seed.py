"""A small day-to-day data set: ten orders at five restaurants, and how to make frames of it."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import types as T

from tiffinlens.schemas import TABLES

# Sample rows, one line each, columns named in the first line.
ROWS = {
    "customers": """
        customer_id full_name email created_at
        1 Arjun_Mehta arjun.mehta@email.com 2024-02-01T00:00:00
        2 Priya_Sharma priya.sharma@email.com 2024-02-01T00:00:00
        3 Rahul_Nair rahul.nair@email.com 2024-02-01T00:00:00
        4 Sneha_Reddy sneha.reddy@email.com 2024-02-01T00:00:00
        5 Vikram_Patel vikram.patel@email.com 2024-02-01T00:00:00""",
    "restaurants": """
        restaurant_id name city avg_rating total_ratings opening_time closing_time is_active commission_pct
        1 Spice_Garden Hyderabad 5.00 2 32400 82800 1 15.00
        2 Dragon_Palace Hyderabad 3.50 2 39600 84600 1 18.00
        3 Pizza_Hub Hyderabad 5.00 1 36000 82800 1 20.00
        4 Biryani_Express Hyderabad 4.50 2 39600 79200 1 15.00
        5 Green_Bowl Hyderabad 4.00 2 28800 79200 1 12.00""",
    "delivery_agents": """
        agent_id full_name vehicle_type avg_rating is_available is_active
        1 Karthik_Reddy bike 4.00 1 1
        2 Suresh_Kumar scooter 5.00 1 1
        3 Mohan_Das bike 4.00 1 1
        4 Raju_Singh bicycle 3.00 1 1
        5 Ganesh_Babu bike 4.50 1 1""",
    "menu_items": """
        item_id restaurant_id category_id item_name price is_veg
        1 1 1 Paneer_Tikka 220.00 1
        2 1 1 Chicken_65 280.00 0
        3 1 2 Butter_Chicken 320.00 0
        4 1 2 Dal_Makhani 240.00 1
        5 1 3 Hyderabadi_Biryani 380.00 0
        6 1 3 Veg_Biryani 280.00 1
        7 2 5 Hot_&_Sour_Soup 160.00 1
        8 2 6 Hakka_Noodles 200.00 1
        9 2 6 Fried_Rice 190.00 0
        10 2 7 Veg_Manchurian 220.00 1
        11 3 8 Margherita_Pizza 350.00 1
        12 3 8 Chicken_Pepperoni 450.00 0
        13 3 9 Arrabbiata_Pasta 280.00 1
        14 3 10 Garlic_Bread 120.00 1
        15 4 11 Mutton_Biryani 420.00 0
        16 4 11 Chicken_Biryani 350.00 0
        17 4 12 Seekh_Kebab 300.00 0
        18 4 13 Butter_Naan 60.00 1
        19 5 14 Quinoa_Power_Bowl 340.00 1
        20 5 15 Greek_Salad 260.00 1
        21 5 16 Fresh_Lime_Soda 80.00 1""",
    "orders": """
        order_id customer_id restaurant_id agent_id delivery_address_id order_status subtotal delivery_fee discount_amount tax_amount total_amount placed_at delivered_at
        1 1 1 1 1 delivered 600.00 30.00 50.00 30.00 610.00 2024-03-01T12:30:00 2024-03-01T13:15:00
        2 2 2 2 2 delivered 390.00 30.00 0.00 19.50 439.50 2024-03-02T13:00:00 2024-03-02T13:50:00
        3 3 3 3 3 delivered 800.00 30.00 80.00 40.00 790.00 2024-03-03T19:15:00 2024-03-03T20:05:00
        4 4 4 4 4 delivered 770.00 30.00 0.00 38.50 838.50 2024-03-04T20:00:00 2024-03-04T20:55:00
        5 5 5 5 5 delivered 600.00 30.00 50.00 30.00 610.00 2024-03-05T09:30:00 2024-03-05T10:10:00
        6 1 4 1 1 delivered 770.00 30.00 77.00 38.50 761.50 2024-03-10T13:00:00 2024-03-10T14:00:00
        7 2 1 2 2 delivered 560.00 30.00 0.00 28.00 618.00 2024-03-12T19:30:00 2024-03-12T20:20:00
        8 3 5 3 3 delivered 420.00 30.00 0.00 21.00 471.00 2024-03-15T10:00:00 2024-03-15T10:45:00
        9 4 3 4 4 cancelled 450.00 30.00 0.00 22.50 502.50 2024-03-18T18:00:00 -
        10 5 2 5 5 delivered 380.00 30.00 0.00 19.00 429.00 2024-03-20T14:30:00 2024-03-20T15:20:00""",
    "order_items": """
        order_id item_id quantity unit_price item_total
        1 1 1 220.00 220.00
        1 3 1 320.00 320.00
        1 6 1 60.00 60.00
        2 8 1 200.00 200.00
        2 9 1 190.00 190.00
        3 11 1 350.00 350.00
        3 12 1 450.00 450.00
        4 15 1 420.00 420.00
        4 17 1 300.00 300.00
        4 18 2 60.00 120.00
        5 19 1 340.00 340.00
        5 20 1 260.00 260.00
        6 15 1 420.00 420.00
        6 16 1 350.00 350.00
        7 5 1 380.00 380.00
        7 4 1 240.00 240.00
        8 19 1 340.00 340.00
        8 21 1 80.00 80.00
        9 11 1 350.00 350.00
        9 14 1 120.00 120.00
        10 7 1 160.00 160.00
        10 8 1 200.00 200.00""",
    "payments": """
        order_id payment_method payment_status amount refund_amount
        1 upi success 610.00 0.00
        2 card success 439.50 0.00
        3 upi success 790.00 0.00
        4 cod success 838.50 0.00
        5 wallet success 610.00 0.00
        6 upi success 761.50 0.00
        7 netbanking success 618.00 0.00
        8 card success 471.00 0.00
        9 upi refunded 502.50 0.00
        10 cod success 429.00 0.00""",
    "reviews": """
        order_id customer_id restaurant_id agent_id food_rating delivery_rating
        1 1 1 1 5 4
        2 2 2 2 4 5
        3 3 3 3 5 4
        4 4 4 4 5 3
        5 5 5 5 4 5
        6 1 4 1 4 4
        7 2 1 2 5 5
        8 3 5 3 4 4
        10 5 2 5 3 4""",
    "coupons": """
        coupon_id code discount_type discount_value min_order_value max_discount usage_limit used_count valid_from valid_until is_active
        1 WELCOME50 flat 50.00 200.00 - 1000 0 2024-01-01 2024-12-31 1
        2 SAVE20 percentage 20.00 300.00 100.00 500 0 2024-01-01 2024-12-31 1
        3 FREEDEL flat 30.00 150.00 - 2000 0 2024-01-01 2024-06-30 1
        4 BIRYANI10 percentage 10.00 350.00 50.00 200 0 2024-01-01 2024-12-31 1""",
    "order_coupons": "order_id coupon_id discount_applied",
}


# Blanks of these columns are written as underscores above.
SPACED = ("full_name", "name", "item_name")


def _value(column: str, text: str, kind: T.DataType):
    if text == "-":
        return None
    if isinstance(kind, T.DecimalType):
        return Decimal(text)
    if isinstance(kind, (T.LongType, T.IntegerType)):
        return int(text)
    if isinstance(kind, T.TimestampNTZType):
        return dt.datetime.fromisoformat(text)
    if isinstance(kind, T.DateType):
        return dt.date.fromisoformat(text)
    return text.replace("_", " ") if column in SPACED else text


def frame(spark, table: str, text: str):
    """A DataFrame of a model table from lines of blank-separated values; '-' is NULL."""
    header, *lines = [line.split() for line in text.strip().splitlines()]
    kinds = {f.name: f.dataType for f in T.StructType.fromDDL(TABLES[table].columns).fields}
    schema = T.StructType([T.StructField(c, kinds[c]) for c in header])
    rows = [tuple(_value(c, v, kinds[c]) for c, v in zip(header, line, strict=True)) for line in lines]
    return spark.createDataFrame(rows, schema)


def seed(spark) -> dict:
    return {name: frame(spark, name, text) for name, text in ROWS.items()}
