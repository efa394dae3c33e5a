"""Menu and product analytics: best sellers, veg split, categories, items bought together."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import money
from ..functions.lifecycle import DELIVERED

# Items of one basket that a unit of work pairs with as many others.
BASKET_BLOCK = 1000
# Lines or pairs that a task of the pairing takes, about; the number of its tasks ends at MOST_TASKS.
TASK_PAIRS = 1 << 20
MOST_TASKS = 10_000


def _delivered_ids(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("order_status") == DELIVERED).select("order_id")


def item_sales(order_items: DataFrame, orders: DataFrame) -> DataFrame:
    """Delivered quantity, revenue and line count per item.

    One shuffle joins lines to delivered orders; the item aggregate then combines
    before its own shuffle, so neither a hot order nor a hot item lands in one task.
    """
    return (
        order_items.select("order_id", "item_id", "quantity", "unit_price", "item_total")
        .join(_delivered_ids(orders), "order_id")
        .groupBy("item_id")
        .agg(
            F.sum("quantity").alias("qty"),
            F.sum("item_total").alias("revenue"),
            F.sum("unit_price").alias("prices"),
            F.count("unit_price").alias("prices_n"),
        )
    )


def top_items(
    order_items: DataFrame,
    menu_items: DataFrame,
    restaurants: DataFrame,
    orders: DataFrame,
    n: int = 10,
) -> DataFrame:
    """The n items with the highest delivered revenue; ties go to the lower id.

    The average unit price is per order line. Lines shrink to one row per item
    before names are joined, and the cut comes last: items or restaurants that are
    missing take no place in the list.
    """
    names = restaurants.select("restaurant_id", F.col("name").alias("restaurant"))
    return (
        menu_items.select("item_id", "item_name", "restaurant_id", "is_veg")
        .join(item_sales(order_items, orders), "item_id")
        .join(names, "restaurant_id")
        .orderBy(F.desc("revenue"), "item_id")
        .limit(n)
        .select(
            "item_id",
            "item_name",
            "restaurant",
            F.col("qty").alias("total_qty_sold"),
            F.round("revenue", 2).alias("total_revenue"),
            money.mean(F.col("prices"), F.col("prices_n")).alias("avg_unit_price"),
            F.when(F.col("is_veg") == 1, F.lit("Veg")).otherwise(F.lit("Non-Veg")).alias("type"),
        )
    )


def basket_veg_split(
    order_items: DataFrame, menu_items: DataFrame, orders: DataFrame
) -> DataFrame:
    """Delivered orders by basket: all veg, all non-veg, or mixed.

    Lines shrink to one row per order before orders are joined, so that join is
    one to one.
    """
    baskets = (
        order_items.select("order_id", "item_id")
        .join(menu_items.select("item_id", "is_veg"), "item_id")
        .groupBy("order_id")
        .agg(F.sum("is_veg").alias("veg"), F.count("*").alias("lines"))
    )
    kind = (
        F.when(F.col("veg") == F.col("lines"), F.lit("Full Veg"))
        .when(F.col("veg") == 0, F.lit("Full Non-Veg"))
        .otherwise(F.lit("Mixed"))
    )
    counts = (
        baskets.join(_delivered_ids(orders), "order_id")
        .groupBy(kind.alias("order_type"))
        .agg(F.count("*").alias("orders"))
    )
    # Three rows: the share window is bounded.
    everything = F.sum("orders").over(Window.partitionBy())
    return counts.select(
        "order_type",
        "orders",
        money.percent_of_count(F.col("orders"), everything).alias("pct"),
    ).orderBy(F.desc("orders"), "order_type")


def category_performance(
    order_items: DataFrame,
    menu_items: DataFrame,
    menu_categories: DataFrame,
    orders: DataFrame,
) -> DataFrame:
    """Delivered items sold, quantity, revenue and revenue share per menu category name."""
    by_category = (
        item_sales(order_items, orders)
        .join(menu_items.select("item_id", "category_id"), "item_id")
        .groupBy("category_id")
        .agg(
            F.count("*").alias("items"),
            F.sum("qty").alias("qty"),
            F.sum("revenue").alias("revenue"),
        )
    )
    names = (
        by_category.join(menu_categories.select("category_id", "category_name"), "category_id")
        .groupBy("category_name")
        .agg(
            F.sum("items").alias("items_sold"),
            F.sum("qty").alias("total_qty_sold"),
            F.sum("revenue").alias("total_revenue"),
        )
    )
    everything = names.select(F.sum("total_revenue")).scalar()
    return names.select(
        "category_name",
        "items_sold",
        "total_qty_sold",
        F.round("total_revenue", 2).alias("total_revenue"),
        money.percent(F.col("total_revenue"), everything).alias("revenue_share_pct"),
    ).orderBy(F.desc("total_revenue"), "category_name")


def _tasks(rows: float, order_items: DataFrame) -> int:
    """Tasks of about TASK_PAIRS rows each, so many that every core has one."""
    return max(order_items.sparkSession.sparkContext.defaultParallelism, min(math.ceil(rows / TASK_PAIRS), MOST_TASKS))


def pairing_size(lines: DataFrame) -> tuple[float, int]:
    """(lines or pairs, whichever are more; items of the largest basket) of distinct ``lines``."""
    n = F.col("items").cast("double")
    baskets = lines.filter(F.col("order_id").isNotNull()).groupBy("order_id").agg(F.count("*").alias("items"))
    found = baskets.agg(F.sum(F.greatest(n, n * (n - 1) / 2)), F.max("items")).first()
    return found[0] or 0, found[1] or 0


def basket_units(lines: DataFrame, block: int) -> tuple[DataFrame, DataFrame]:
    """Both sides of the units (order_id, first, second) that pair all blocks of a basket.

    ``lines`` are order_id, item_id, item_orders, unique by the first two. Items are
    dealt into blocks by their hash, so a block has about ``block`` of them.
    """
    large = (
        lines.groupBy("order_id")
        .agg(F.count("*").alias("items"))
        .filter(F.col("items") > block)
        .select("order_id", F.ceil(F.col("items") / block).cast("int").alias("blocks"))
    )
    dealt = (
        lines.join(large, "order_id", "left")
        .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        .withColumn("own", F.pmod(F.xxhash64("item_id"), F.col("blocks")).cast("int"))
    )
    # Of a unit's two blocks this side has the first, the other side the second.
    firsts = dealt.select(
        "order_id",
        "item_id",
        "item_orders",
        F.col("own").alias("first"),
        F.explode(F.sequence("own", F.col("blocks") - 1)).alias("second"),
    )
    seconds = dealt.select(
        "order_id",
        F.col("item_id").alias("other_id"),
        F.col("item_orders").alias("other_orders"),
        F.explode(F.sequence(F.lit(0), "own")).alias("first"),
        F.col("own").alias("second"),
    )
    return firsts, seconds


def bought_together(order_items: DataFrame, min_orders: int = 2, block: int = BASKET_BLOCK) -> DataFrame:
    """Every pair of items that ``min_orders`` orders or more hold, with the share of the first's orders.

    An item in fewer orders is in no such pair, so its lines go before baskets are
    paired: no qualifying pair is lost. A basket of more than ``block`` items is
    dealt into blocks of about that many, and every two blocks are a unit that
    some task pairs: n items are never one task's n * n. The number of tasks
    follows the pairs to be made, so what one of them holds stays the same however
    large the tables are. A pair that many orders may hold is counted in parts.
    """
    lines = order_items.select("order_id", "item_id")
    lines = lines.repartition(_tasks(order_items.count(), order_items), "order_id", "item_id").distinct()
    size, longest = pairing_size(lines)
    tasks = _tasks(size, order_items)
    frequent = lines.groupBy("item_id").agg(F.count("*").alias("item_orders")).filter(
        F.col("item_orders") >= min_orders
    )
    # Hashing the items keeps fewer rows than sorting the lines would.
    kept = lines.filter(F.col("order_id").isNotNull()).join(frequent.hint("shuffle_hash"), "item_id")
    lower = F.col("item_id") < F.col("other_id")
    if longest > block:
        unit = ["order_id", "first", "second"]
        firsts, seconds = basket_units(kept, block)
        paired = lower | ((F.col("first") < F.col("second")) & (F.col("item_id") != F.col("other_id")))
    else:
        unit, paired = ["order_id"], lower
        firsts, seconds = kept, kept.withColumnsRenamed({"item_id": "other_id", "item_orders": "other_orders"})
    # No more orders hold a pair than hold either item.
    parts = F.ceil(F.least("item_orders", "other_orders") / TASK_PAIRS).cast("int")
    pairs = (
        firsts.repartition(tasks, *unit)
        .join(seconds.repartition(tasks, *unit), unit)
        .filter(paired)
        .select(
            F.least("item_id", "other_id").alias("item_id"),
            F.when(lower, F.col("item_orders")).otherwise(F.col("other_orders")).alias("item_orders"),
            F.greatest("item_id", "other_id").alias("other_id"),
            parts.alias("parts"),
            F.pmod(F.xxhash64("order_id"), parts).cast("int").alias("part"),
        )
    )
    together = F.col("orders_together") >= min_orders
    return (
        pairs.repartition(tasks, "item_id", "other_id", "part")
        .groupBy("item_id", "item_orders", "other_id", "parts", "part")
        .agg(F.count("*").alias("orders_together"))
        # A pair of one part is whole; the sums below are of few.
        .filter(together | (F.col("parts") > 1))
        .groupBy("item_id", "item_orders", "other_id")
        .agg(F.sum("orders_together").alias("orders_together"))
        .filter(together)
        .select(
            "item_id",
            "other_id",
            "orders_together",
            money.percent_of_count(F.col("orders_together"), F.col("item_orders")).alias("pct_of_item_orders"),
        )
    )
