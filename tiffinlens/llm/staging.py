"""Frames written once and read again, in the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tiffinlens.plans.lineage import scratch_path


def staged(frame: DataFrame, name: str) -> DataFrame:
    """Writes ``frame`` as Parquet under ``spark.checkpoint.dir`` and reads it again.

    It is computed once however often it is used, survives lost executors, and
    Spark knows its size afterwards: joins broadcast it only below the session's
    threshold and shuffle beyond.
    """
    path = scratch_path(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
