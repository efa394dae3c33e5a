"""Running values over an ordered key without a single-task window.

``sum().over(orderBy)`` with no partition puts every row in one task, and
``lag().over(partitionBy(key))`` puts a hot key in one task. Here the ordering
key, a 64-bit whole number unique within ``keys``, is read digit by digit. Rows
that share all but the last 16 bits are a slice, slices that share all but
their last 16 bits are a slice of the next level, and so on to the top. Every
window runs inside one slice, so over 2**16 rows at most, and so does the last
one over the top level: dense, sparse and time-based ids alike. Above the rows,
only one summary per slice moves.

Rows are shuffled by key and slice explicitly. Left to itself, Spark would keep a
partitioning by key alone, from a join before, and so keep a hot key in one task.

``rows`` is read twice (once for the rows, once pruned to the summary columns):
settle an expensive input first. The summaries are settled, so each is computed
once; where they show that no key can have more than 2**16 of them, one window
over them does, and no further level is built.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .lineage import settle

SLICE_BITS = 16
LEVEL_BITS = 16
POSITION_BITS = 64
# Slices that one window may run over.
WINDOW = 1 << LEVEL_BITS


def levels(bits: int = SLICE_BITS) -> list[int]:
    """How far a position is shifted to name its slice, from the rows' slices up to the top level."""
    return list(range(bits, POSITION_BITS, LEVEL_BITS))


def slice_of(position: Column, bits: int = SLICE_BITS) -> Column:
    return F.shiftright(position, bits)


def _earlier(keys: Sequence[str], order: str):
    return Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def _carried(
    slices: DataFrame,
    keys: list[str],
    bits: int,
    gather: Callable[[str], Column],
    running: Callable[[str], Column],
    joined: Callable[[Column, Column], Column],
    total: str | None = None,
) -> DataFrame:
    """keys, _slice, _carry: what all earlier slices of the keys come to; ``total`` names a sum over all of them.

    ``slices`` has one row (_slice, _part) per slice of the rows. ``gather``
    makes a slice's part from those of its slices, which have their place in
    _slice; ``running`` runs over parts before a row, ``joined`` adds what comes
    from above to it.
    """
    slices = settle(slices)
    span = slices.agg(F.max("_slice") - F.min("_slice")).first()[0] or 0
    stages = [slices]
    for _ in levels(bits)[1:] if span >= WINDOW else []:
        up = stages[-1].withColumn("_up", slice_of(F.col("_slice"), LEVEL_BITS))
        stages.append(up.groupBy(*keys, "_up").agg(gather("_slice").alias("_part")).withColumnRenamed("_up", "_slice"))
    top = stages.pop()
    sums = [F.sum("_part").over(Window.partitionBy(*keys)).alias(total)] if total else []
    more = [total] if total else []
    carry = top.select(*keys, "_slice", running("_part").over(_earlier(keys, "_slice")).alias("_carry"), *sums)
    while stages:
        above = carry.withColumnRenamed("_slice", "_up").withColumnRenamed("_carry", "_above")
        inside = running("_part").over(_earlier([*keys, "_up"], "_slice"))
        carry = (
            stages.pop()
            .withColumn("_up", slice_of(F.col("_slice"), LEVEL_BITS))
            .withColumn("_inside", inside)
            .join(above, [*keys, "_up"])
            .select(*keys, "_slice", joined(F.col("_inside"), F.col("_above")).alias("_carry"), *more)
        )
    # As new attributes: in a micro-batch of a stream, Spark does not tell a checkpoint's from those of the rows joined to it.
    return carry.select(*[F.col(c).alias(c) for c in carry.columns])


def running_sum_before(
    rows: DataFrame,
    position: str,
    amount: Column,
    out: str,
    keys: Sequence[str] = (),
    bits: int = SLICE_BITS,
    total: str | None = None,
) -> DataFrame:
    """Adds ``out``: the sum of ``amount`` over rows earlier by ``position``; 0 for the first.

    ``total`` names a further column with the sum over all rows of the keys.
    """
    keys = list(keys)
    zero = F.lit(0)
    sliced = rows.withColumns({"_slice": slice_of(F.col(position), bits), "_amount": amount})
    slices = sliced.groupBy(*keys, "_slice").agg(F.sum("_amount").alias("_part"))
    carry = _carried(
        slices,
        keys,
        bits,
        lambda place: F.sum("_part"),
        F.sum,
        lambda inside, above: F.coalesce(inside, zero) + F.coalesce(above, zero),
        total,
    )
    inside = F.sum("_amount").over(_earlier([*keys, "_slice"], position))
    return (
        sliced.repartition(*keys, "_slice")
        .withColumn("_inside", inside)
        .join(carry, [*keys, "_slice"])
        .withColumn(out, F.coalesce("_inside", zero) + F.coalesce("_carry", zero))
        .drop("_slice", "_amount", "_inside", "_carry")
    )


def last_before(
    rows: DataFrame,
    position: str,
    value: Column,
    out: str,
    keys: Sequence[str] = (),
    bits: int = SLICE_BITS,
) -> DataFrame:
    """Adds ``out``: the last non-NULL ``value`` among rows of the keys earlier by ``position``."""
    keys = list(keys)
    sliced = rows.withColumns({"_slice": slice_of(F.col(position), bits), "_value": value})

    def newest(what: str, place: str) -> Column:
        return F.max_by(what, F.when(F.col(what).isNotNull(), F.col(place)))

    def last(what: str) -> Column:
        return F.last(what, ignorenulls=True)

    slices = sliced.groupBy(*keys, "_slice").agg(newest("_value", position).alias("_part"))
    carry = _carried(slices, keys, bits, lambda place: newest("_part", place), last, F.coalesce)
    inside = last("_value").over(_earlier([*keys, "_slice"], position))
    return (
        sliced.repartition(*keys, "_slice")
        .withColumn("_inside", inside)
        .join(carry, [*keys, "_slice"])
        .withColumn(out, F.coalesce("_inside", "_carry"))
        .drop("_slice", "_value", "_inside", "_carry")
    )


def first_after(
    rows: DataFrame,
    position: str,
    value: Column,
    out: str,
    keys: Sequence[str] = (),
    bits: int = SLICE_BITS,
) -> DataFrame:
    """Adds ``out``: the first non-NULL ``value`` among rows of the keys later by ``position``."""
    mirrored = rows.withColumn("_mirror", -F.col(position))
    return last_before(mirrored, "_mirror", value, out, keys, bits).drop("_mirror")
