"""Integrity rules as data-quality jobs: each returns the rows, keys or counts that break one.

A NULL passes a reference, a unique rule and a value rule, as it does in SQL.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import money
from ..plans import bitmaps
from ..schemas import COLLATED_KEYS, SUBTOTAL_TAX, TABLES

ANY_CASE = "UNICODE_CI_AI_RTRIM"
# Bytes of key bitmaps that a reference audit may broadcast.
BITMAP_BYTES = 64 << 20


def orphan_rows(child: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows whose reference points nowhere."""
    keys = parent.select(F.col(parent_key).alias(column))
    return child.filter(F.col(column).isNotNull()).join(keys, column, "left_anti")


def orphan_keys(child: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Missing parent keys and the child rows naming each; rows combine per key before the join."""
    uses = (
        child.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("child_rows"))
    )
    keys = parent.select(F.col(parent_key).alias(column))
    return uses.join(keys, column, "left_anti")


def reference_report(tables: Mapping[str, DataFrame], bitmap_bytes: int = BITMAP_BYTES) -> DataFrame:
    """One row per reference among the given tables: referring rows, missing keys, orphan rows.

    Each table is read once as a child, for all its references together. Parents whose
    keys fit ``bitmap_bytes`` as bitmaps, taken from the smallest on, travel to the
    child's rows as such: rows with a known key are counted where they are read and
    only orphans are shuffled. What bitmaps take is bounded by a count and the lowest and
    highest key before any is made. Uses of other parents (very many or widely
    spread keys) are counted per key before the one join.
    """
    rules: list[tuple[str, str]] = []
    uses = []
    numbers = {name: i for i, name in enumerate(tables)}
    for name, child in tables.items():
        refs = [ref for ref in TABLES[name].parents if ref.table in tables and ref.column in child.columns]
        found = []
        for ref in refs:
            found.append(
                F.struct(
                    F.lit(len(rules)).alias("rule"),
                    F.lit(numbers[ref.table]).alias("parent"),
                    F.col(ref.column).cast("bigint").alias("ref_key"),
                )
            )
            rules.append((f"{name}.{ref.column} -> {ref.table}", ref.table))
        if found:
            uses.append(
                child.select(F.explode(F.array(*found)).alias("use"))
                .select("use.*")
                .filter(F.col("ref_key").isNotNull())
            )
    keys = {
        name: tables[name].select(
            F.lit(numbers[name]).alias("parent"), F.col(TABLES[name].key[0]).cast("bigint").alias("ref_key")
        )
        for name in dict.fromkeys(parent for _, parent in rules)
    }
    mapped = _mapped(keys, numbers, bitmap_bytes)
    used = reduce(DataFrame.unionByName, uses).withColumn("known", F.lit(None).cast("boolean"))
    if mapped:
        held = bitmaps.bitmaps(reduce(DataFrame.unionByName, [keys[n] for n in mapped]), "ref_key", "parent")
        held = bitmaps.sliced(held, "parent")
        bit = bitmaps.has_bit(F.col("bits"), bitmaps.place_in_slice(F.col("ref_key")))
        known = F.when(F.col("parent").isin([numbers[n] for n in mapped]), bit)
        used = (
            used.withColumn("slice", bitmaps.slice_of(F.col("ref_key")))
            .join(F.broadcast(held), ["parent", "slice"], "left")
            .withColumn("known", known)
        )
    # All rows of a rule whose key is known count together, under no key.
    counted = (
        used.select("rule", "parent", "known", F.when(F.col("known"), F.lit(None)).otherwise(F.col("ref_key")).alias("ref_key"))
        .groupBy("rule", "parent", "known", "ref_key")
        .agg(F.count("*").alias("n"))
    )
    others = [frame.withColumn("present", F.lit(True)) for name, frame in keys.items() if name not in mapped]
    if others:
        counted = counted.join(reduce(DataFrame.unionByName, others), ["parent", "ref_key"], "left").withColumn(
            "known", F.coalesce("known", "present")
        )
    lost = ~F.coalesce("known", F.lit(False))
    report = counted.groupBy("rule").agg(
        F.sum("n").alias("referring_rows"),
        F.count(F.when(lost, F.lit(1))).alias("missing_keys"),
        F.coalesce(F.sum(F.when(lost, F.col("n"))), F.lit(0)).alias("orphan_rows"),
    )
    listed = F.array(*[F.struct(F.lit(i).alias("number"), F.lit(rule).alias("name")) for i, (rule, _) in enumerate(rules)])
    listed = report.sparkSession.range(1).select(F.explode(listed).alias("listed")).select(
        F.col("listed.number").alias("rule"), F.col("listed.name").alias("name")
    )
    return (
        listed.join(report, "rule", "left")
        .select(F.col("name").alias("rule"), "referring_rows", "missing_keys", "orphan_rows")
        .na.fill(0)
    )


def _mapped(keys: Mapping[str, DataFrame], numbers: Mapping[str, int], limit: int) -> list[str]:
    """The parents whose bitmaps take ``limit`` bytes at most together, from the smallest on."""
    if limit <= 0 or not keys:
        return []
    sizes = reduce(DataFrame.unionByName, keys.values()).groupBy("parent").agg(
        F.count("ref_key").alias("keys"), F.min("ref_key").alias("low"), F.max("ref_key").alias("high")
    )
    bounds = {r.parent: bitmaps.most_bytes(r["keys"], r.low, r.high) for r in sizes.collect()}
    found, taken = [], 0
    for name in sorted(keys, key=lambda n: bounds.get(numbers[n], 0)):
        taken += bounds.get(numbers[name], 0)
        if taken > limit:
            break
        found.append(name)
    return found


def duplicate_keys(table: DataFrame, columns: list[str]) -> DataFrame:
    """Key values held by more than one row. Texts in COLLATED_KEYS match in any case."""
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    keys = [
        F.collate(F.col(c), ANY_CASE).alias(c) if c in COLLATED_KEYS else F.col(c) for c in columns
    ]
    return (
        table.filter(known)
        .select(*keys)
        .groupBy(*columns)
        .agg(F.count("*").alias("copies"))
        .filter(F.col("copies") > 1)
    )


def duplicate_report(name: str, table: DataFrame) -> DataFrame:
    """One row per key rule of the table: values held more than once and the rows beyond the first."""
    spec = TABLES[name]
    reports = [
        duplicate_keys(table, list(rule)).agg(
            F.lit(f"{name}({', '.join(rule)})").alias("rule"),
            F.count("*").alias("repeated_keys"),
            F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("surplus_rows"),
        )
        for rule in (spec.key, *spec.unique)
        if set(rule) <= set(table.columns)
    ]
    return reduce(DataFrame.unionByName, reports)


def missing_values(name: str, table: DataFrame) -> DataFrame:
    """NULLs per required column, counted in one pass."""
    columns = [c for c in TABLES[name].required if c in table.columns]
    counts = table.agg(*[F.count(F.when(F.col(c).isNull(), F.lit(1))).alias(c) for c in columns])
    return counts.unpivot([], columns, "column_name", "null_rows")


def value_problems(name: str, table: DataFrame) -> DataFrame:
    """Rows with a value outside its domain or range, with the names of the columns at fault."""
    spec = TABLES[name]
    checks: list[Column] = []
    for column, allowed in spec.domains.items():
        if column in table.columns:
            checks.append(F.when(~F.col(column).isin(*allowed), F.lit(column)))
    for column, (low, high) in spec.ranges.items():
        if column in table.columns:
            checks.append(F.when(~F.col(column).between(low, high), F.lit(column)))
    problems = F.array_compact(F.array(*checks))
    return table.withColumn("problems", problems).filter(F.size("problems") > 0)


def line_total_problems(order_items: DataFrame) -> DataFrame:
    """Lines whose total is not quantity times unit price."""
    return order_items.filter(F.col("item_total") != F.col("quantity") * F.col("unit_price"))


def order_total_problems(orders: DataFrame, tax_rate: str = SUBTOTAL_TAX) -> DataFrame:
    """Orders whose total or tax does not follow from the other amounts."""
    expected = (
        F.col("subtotal") + F.col("delivery_fee") + F.col("tax_amount") - F.col("discount_amount")
    )
    tax = F.round(F.col("subtotal") * F.lit(tax_rate).cast("decimal(3,2)"), 2)
    bad_total = F.col("total_amount") != expected
    bad_tax = F.col("tax_amount") != tax
    return orders.select(
        "order_id", bad_total.alias("bad_total"), bad_tax.alias("bad_tax")
    ).filter(F.col("bad_total") | F.col("bad_tax"))


def subtotal_problems(orders: DataFrame, order_items: DataFrame) -> DataFrame:
    """Orders whose lines do not add up to the subtotal; an order without lines adds up to 0."""
    sums = order_items.groupBy("order_id").agg(F.sum("item_total").alias("items_total"))
    return (
        orders.select("order_id", "subtotal")
        .join(sums, "order_id", "left")
        .withColumn("items_total", F.coalesce("items_total", F.lit(0).cast(money.MONEY)))
        .filter(F.col("items_total") != F.col("subtotal"))
    )


def amount_problems(
    orders: DataFrame, other: DataFrame, amount: str
) -> DataFrame:
    """Payments (``amount``) or invoices (``grand_total``) that differ from their order's total."""
    return (
        other.select("order_id", F.col(amount).alias("amount"))
        .join(orders.select("order_id", "total_amount"), "order_id")
        .filter(F.col("amount") != F.col("total_amount"))
    )


def purge(
    tables: Mapping[str, DataFrame], root: str, erase: DataFrame
) -> tuple[dict[str, DataFrame], DataFrame]:
    """What is left of every table after erasing ``erase`` (keys of ``root``), and the refusals.

    Children that cascade go with their parent. A row is kept, together with everything
    above it, when a row that does not cascade still refers to it or to a row that
    would go with it. Refusals list the root keys held back so. What would go is
    worked out once, for all that was asked, and cut down to what is granted.
    """
    key = TABLES[root].key[0]
    asked = erase.select(F.col(key).alias("root_key")).distinct()
    doomed = _doomed(tables, root, tables[root], asked, key)
    held = []
    for name, rows in doomed.items():
        for child, ref in _references(tables, name):
            if ref.cascade:
                continue
            own = rows.select(F.col(TABLES[name].key[0]).alias("_key"), "root_key")
            users = tables[child].filter(F.col(ref.column).isNotNull())
            used = F.col(ref.column).alias("_key")
            if child in doomed:
                # A user that goes with the same root does not hold it.
                child_key = {c: F.col(c).alias(f"_{c}") for c in TABLES[child].key}
                going = doomed[child].select(*child_key.values(), "root_key")
                use = own.join(users.select(used, *child_key.values()), "_key").join(
                    going, [*[f"_{c}" for c in child_key], "root_key"], "left_anti"
                )
            else:
                use = own.join(users.select(used).distinct(), "_key", "left_semi")
            held.append(use.select("root_key", F.lit(child).alias("held_by")))
    refused = reduce(DataFrame.unionByName, held).distinct() if held else None
    if refused is None:
        refused = asked.select("root_key", F.lit(None).cast("string").alias("held_by")).limit(0)
    granted = asked.join(refused.select("root_key"), "root_key", "left_anti")
    gone = {name: rows.join(granted, "root_key", "left_semi") for name, rows in doomed.items()}
    left = {}
    for name, table in tables.items():
        if name not in gone:
            left[name] = table
            continue
        keys = list(TABLES[name].key)
        left[name] = table.join(gone[name].select(*keys), keys, "left_anti")
    return left, refused


def _references(tables: Mapping[str, DataFrame], parent: str):
    for child in tables:
        for ref in TABLES[child].parents:
            if ref.table == parent and ref.column in tables[child].columns:
                yield child, ref


def _doomed(tables, root, rows, asked, key) -> dict[str, DataFrame]:
    """Rows that go with the asked root keys, per table, each with its ``root_key``."""
    first = rows.select(*TABLES[root].key, F.col(key).alias("root_key")).join(
        asked, "root_key", "left_semi"
    )
    found = {root: first}
    queue = [root]
    while queue:
        parent = queue.pop()
        for child, ref in _references(tables, parent):
            if not ref.cascade:
                continue
            above = found[parent].select(
                F.col(TABLES[parent].key[0]).alias(ref.column), "root_key"
            )
            below = tables[child].select(*{*TABLES[child].key, ref.column}).join(above, ref.column)
            below = below.select(*TABLES[child].key, "root_key")
            found[child] = found[child].unionByName(below) if child in found else below
            queue.append(child)
    return found
