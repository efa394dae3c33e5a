"""Row-level lookups that stay even when keys are not.

A broadcast hint is given only to results whose row count is known to be small
(``few``). Otherwise Catalyst broadcasts a side only when its size,
estimated or measured by adaptive execution, is under
``spark.sql.autoBroadcastJoinThreshold``, and falls back to a sort-merge join
whose hot partitions adaptive execution splits. NULL keys can never match, yet
an outer join would send them all to one task; they are spread instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FEW_ROWS = 100_000


def few(frame: DataFrame, rows: int) -> DataFrame:
    """``frame``, known to hold at most ``rows`` rows, marked for broadcast if that is few."""
    return F.broadcast(frame) if rows <= FEW_ROWS else frame


def left_lookup(rows: DataFrame, other: DataFrame, key: str, spread_by: str) -> DataFrame:
    """``rows`` left join ``other`` on ``key`` (0 or more in both), NULL keys spread by ``spread_by``.

    ``other`` must be unique on ``key``; its key column is not repeated.
    """
    never_matches = -1 - F.pmod(F.xxhash64(spread_by), F.lit(1 << 20))
    left = rows.withColumn("_lookup", F.coalesce(F.col(key), never_matches))
    right = other.withColumnRenamed(key, "_lookup")
    return left.join(right, "_lookup", "left").drop("_lookup")


def hot_lookup(rows: DataFrame, other: DataFrame, key: str, how: str = "left") -> DataFrame:
    """``rows`` joined to ``other``, which is unique on ``key`` and itself made by joins or groups on it.

    Adaptive execution splits a hot partition only between two fresh shuffles. A
    side that already lies partitioned by ``key`` would be joined in place, and a
    plain repartition by the same key is optimized away. Joining on the key and its
    hash asks for a partitioning neither side has, at the price of one more
    shuffle of the unique side.
    """
    mark = F.xxhash64(key)
    return (
        rows.withColumn("_mark", mark)
        .join(other.withColumn("_mark", mark), [key, "_mark"], how)
        .drop("_mark")
    )
