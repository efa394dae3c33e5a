"""Time on zone-free timestamps (``timestamp_ntz``); no session time zone is involved."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def minutes_between(start: Column, end: Column) -> Column:
    """Whole minutes from start to end, cut towards zero."""
    gap = end - start
    days, hours, minutes = (F.extract(F.lit(unit), gap) for unit in ("DAY", "HOUR", "MINUTE"))
    return (days * 1440 + hours * 60 + minutes).cast("bigint")


def seconds_of_day(moment: Column) -> Column:
    return F.hour(moment) * 3600 + F.minute(moment) * 60 + F.second(moment).cast("int")


def month_number(moment: Column) -> Column:
    """Months since year 0; a cheap integer grouping key."""
    return F.year(moment) * 12 + F.month(moment) - 1


def month_label(number: Column) -> Column:
    """'yyyy-MM' of a ``month_number``."""
    return F.format_string(
        "%04d-%02d", F.floor(number / F.lit(12)).cast("int"), (number % 12 + 1).cast("int")
    )


def event_time(moment: Column) -> Column:
    """The moment read as UTC, to the second: watermarks accept no zone-free type."""
    days = F.datediff(F.to_date(moment), F.to_date(F.lit("1970-01-01")))
    return F.timestamp_seconds(days.cast("bigint") * 86400 + seconds_of_day(moment))
