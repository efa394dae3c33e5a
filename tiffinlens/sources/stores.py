"""Stored tables that batches change: only the folders that a batch touches are read and written.

Folders are months, days or ranges of keys, so what a batch costs follows from the
batch. Rows that replace others are settled first (``lineage.settle``): if a
replacement fails half way, they are still there, and running it again gives the
same folders.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import time
from ..operators.changefeed import upsert
from ..operators.history import latest_agent_position
from ..operators.views import daily_kpi, order_summary
from ..plans.bitmaps import bitmaps, bucket_of, has_bit, place_of
from ..plans.lineage import settle
from .tables import first_of_each

NO_DAY = "0000-00-00"


def day_label(moment: Column) -> Column:
    """The folder of a moment's day; rows without a moment have one of their own."""
    return F.coalesce(F.date_format(moment, "yyyy-MM-dd"), F.lit(NO_DAY))


def month_label(moment: Column) -> Column:
    return time.month_label(time.month_number(moment))


def _replace(rows: DataFrame, path: str, folder: str) -> None:
    """Writes ``rows`` in place of the folders that they are of; all other folders stay as they are."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(folder).parquet(path)


def _folders(rows: DataFrame, folder: str) -> list[str]:
    """The folders of some rows: months or days, so as few as a table has of these."""
    return sorted(row[0] for row in rows.select(folder).distinct().collect())


def update_stored(
    spark: SparkSession, path: str, fresh: DataFrame, key: str, columns: list[str], folder: str = "order_month"
) -> list[str]:
    """Sets ``columns`` of a stored table where ``fresh`` has the key, and returns the folders written anew.

    ``fresh`` is unique by key and as large as its batch. Finding its folders
    reads the stored keys alone; of the other folders nothing else is read and
    nothing is written. ``folder`` must not follow from what is set.
    """
    stored = spark.read.option("partitionOverwriteMode", "dynamic").parquet(path)
    stored = stored.withColumn(folder, F.col(folder).cast("string"))
    touched = _folders(stored.select(key, folder).join(fresh.select(key), key, "left_semi"), folder)
    if touched:
        _replace(settle(upsert(stored.filter(F.col(folder).isin(touched)), fresh, key, columns)), path, folder)
    return touched


def refresh_daily_view(orders: DataFrame, touched: DataFrame, path: str) -> list[str]:
    """Computes the daily view anew for the days of ``touched`` orders (order_id), stored by ``order_day``.

    ``orders`` is the table after the batch. An order keeps its day, so a day's
    rows change only with orders of that day.
    """
    dated = orders.withColumn("order_day", day_label(F.col("placed_at")))
    days = _folders(dated.join(touched.select("order_id"), "order_id", "left_semi"), "order_day")
    if days:
        fresh = daily_kpi(dated.filter(F.col("order_day").isin(days)).drop("order_day"))
        _replace(settle(fresh.withColumn("order_day", day_label(F.col("order_date").cast("timestamp_ntz")))), path, "order_day")
    return days


def refresh_order_view(tables: dict[str, DataFrame], touched: DataFrame, path: str) -> list[str]:
    """Computes the order view anew for the months of ``touched`` orders (order_id), stored by ``order_month``."""
    dated = tables["orders"].withColumn("stored_month", month_label(F.col("placed_at")))
    months = _folders(dated.join(touched.select("order_id"), "order_id", "left_semi"), "stored_month")
    if months:
        some = dated.filter(F.col("stored_month").isin(months)).drop("stored_month")
        others = [tables[name] for name in ("customers", "restaurants", "delivery_agents", "payments", "reviews")]
        _replace(settle(order_summary(some, *others)), path, "order_month")
    return months


# Stored keys lie in folders by ranges of this many.
KEY_RANGE = 1 << 20


def _key_range(key: str) -> Column:
    return F.col(key) - F.pmod(F.col(key), F.lit(KEY_RANGE))


def insert_absent_stored(
    spark: SparkSession, path: str, fresh: DataFrame, key: str, order: str, version: int
) -> DataFrame:
    """Appends the rows of ``fresh`` whose key the stored table has not, and returns them.

    The keys are kept beside the rows as bitmaps, exact for any whole number: a bit
    for a key, so that what tells new keys from old ones is a fraction of the table,
    and the table itself is never read. Of the bitmaps only the ranges of the
    fresh keys are. Of equal keys the lowest by ``order`` is taken; NULL is no
    key. ``version`` numbers the batches: one that failed is run again with its
    number and replaces what it left.
    """
    first = settle(first_of_each(fresh.filter(F.col(key).isNotNull()), key, order))
    ranged = first.select("*", _key_range(key).alias("keys_from"))
    absent = ranged
    if version > 0:
        kept = spark.read.schema("bucket long, bits binary, version int, keys_from long").parquet(f"{path}/keys")
        kept = kept.filter(F.col("version") < version)
        kept = kept.join(ranged.select("keys_from").distinct(), "keys_from", "left_semi")
        known = kept.groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
        absent = (
            ranged.withColumn("bucket", bucket_of(F.col(key)))
            .join(known, "bucket", "left")
            .filter(~has_bit(F.col("bits"), place_of(F.col(key))))
            .drop("bucket", "bits")
        )
    absent = settle(absent)
    bits = bitmaps(absent, key, "keys_from")
    absent.write.mode("overwrite").partitionBy("keys_from").parquet(f"{path}/rows/version={version}")
    bits.write.mode("overwrite").partitionBy("keys_from").parquet(f"{path}/keys/version={version}")
    return absent.select(*fresh.columns)


def write_by_day(rows: DataFrame, path: str, moment: str, mode: str = "overwrite") -> None:
    """Parquet in one folder per day of ``moment``."""
    rows.withColumn("day", day_label(F.col(moment))).write.mode(mode).partitionBy("day").parquet(path)


def latest_positions_stored(spark: SparkSession, path: str, agents: DataFrame) -> DataFrame:
    """Each agent's newest position from positions stored by day, read from the newest day back.

    Ends at the day by which every one of ``agents`` is found; days are taken one,
    two, four at a time, so an agent who sent nothing for long costs few rounds.
    """
    stored = spark.read.parquet(path).withColumn("day", F.col("day").cast("string"))
    days, at, step = _folders(stored, "day")[::-1], 0, 1
    missing, found = settle(agents.select("agent_id").distinct()), None
    while at < len(days) and not missing.isEmpty():
        some = stored.filter(F.col("day").isin(days[at : at + step])).drop("day")
        newest = settle(latest_agent_position(some.join(missing, "agent_id", "left_semi")))
        found = newest if found is None else found.unionByName(newest)
        missing = settle(missing.join(newest, "agent_id", "left_anti"))
        at, step = at + step, step * 2
    return found if found is not None else latest_agent_position(stored.drop("day").limit(0))
