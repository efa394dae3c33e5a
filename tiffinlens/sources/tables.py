"""Tables on storage: fixed schemas in, partitioned or bucketed Parquet out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import time
from ..operators.views import daily_kpi, order_summary
from ..schemas import TABLES

FORMATS = ("parquet", "orc", "json", "csv")


def read_table(spark: SparkSession, name: str, path: str, file_format: str = "parquet") -> DataFrame:
    """A model table with its declared schema; nothing is inferred."""
    if file_format not in FORMATS:
        raise ValueError(f"unknown format {file_format!r}; one of {', '.join(FORMATS)}")
    reader = spark.read.format(file_format).schema(TABLES[name].columns)
    if file_format == "csv":
        reader = reader.option("header", True).option("mode", "FAILFAST")
    return reader.load(path)


def read_stream(spark: SparkSession, name: str, path: str) -> DataFrame:
    """New Parquet files of a model table as a stream."""
    return spark.readStream.schema(TABLES[name].columns).parquet(path)


def write_by_month(rows: DataFrame, path: str, moment: str = "placed_at", mode: str = "overwrite") -> None:
    """Parquet in one folder per month of ``moment``, so filters on ``order_month`` skip folders.

    Rows are not gathered by month first: a busy month keeps all its writers.
    """
    label = time.month_label(time.month_number(F.col(moment)))
    rows.withColumn("order_month", label).write.mode(mode).partitionBy("order_month").parquet(path)


def write_bucketed(rows: DataFrame, table: str, key: str, buckets: int, mode: str = "overwrite") -> None:
    """A catalog table bucketed and sorted by ``key``: joins of such tables on it need no shuffle."""
    rows.write.mode(mode).bucketBy(buckets, key).sortBy(key).format("parquet").saveAsTable(table)


def first_of_each(rows: DataFrame, key: str, order: str) -> DataFrame:
    """Of rows with equal keys the lowest by ``order``."""
    rest = [c for c in rows.columns if c != key]
    first = rows.groupBy(key).agg(F.min_by(F.struct(*rest), order).alias("first"))
    return first.select(key, "first.*").select(*rows.columns)


def insert_absent(current: DataFrame, fresh: DataFrame, key: str, order: str) -> DataFrame:
    """Rows of ``fresh`` whose key is not in ``current`` yet, ready to append: of equal keys the lowest by ``order``."""
    return first_of_each(fresh, key, order).join(current.select(key), key, "left_anti").select(*fresh.columns)


def register_views(tables: dict[str, DataFrame]) -> None:
    """The two reporting views as temporary views for SQL and BI use."""
    order_summary(
        tables["orders"],
        tables["customers"],
        tables["restaurants"],
        tables["delivery_agents"],
        tables["payments"],
        tables["reviews"],
    ).createOrReplaceTempView("vw_order_summary")
    daily_kpi(tables["orders"]).createOrReplaceTempView("vw_daily_kpi")
