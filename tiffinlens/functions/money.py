"""Exact decimal arithmetic. Money never passes through a double.

A zero denominator gives NULL, and rounding is half-up on the exact quotient.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(10,2)"
COUNT = "decimal(20,0)"


def mean(total: Column, n: Column, places: int = 2) -> Column:
    """total / n rounded once; cheaper than ``avg`` next to a ``sum`` of the same column."""
    return F.round(F.try_divide(total, n.cast(COUNT)), places)


def percent(part: Column, whole: Column, places: int = 2) -> Column:
    """100 * part / whole for decimals."""
    return F.round(F.try_divide(part * F.lit(100), whole), places)


def percent_of_count(part: Column, whole: Column, places: int = 2) -> Column:
    """100 * part / whole for row counts."""
    return percent(part.cast(COUNT), whole.cast(COUNT), places)


def cents(amount: Column) -> Column:
    """A two-place decimal as a whole number of cents."""
    return (amount * F.lit(100)).cast("bigint")
