"""Session settings the operators count on when keys are skewed."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Runtime settings only; memory, cores and the checkpoint folder belong to the cluster.
SETTINGS = {
    # Re-plan from measured sizes: join strategy, partition number, hot partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast by checked size only: estimated from files (compressed, so taken three times),
    # or measured once a side has been shuffled. Beyond it the join stays sort-merge.
    "spark.sql.sources.fileCompressionFactor": "3.0",
    "spark.sql.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "128MB",
    # Split a hot join partition even where the next step then needs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Applies those of SETTINGS that the caller has not set, and returns the session."""
    for name, value in SETTINGS.items():
        if spark.conf.get(name, None) is None:
            spark.conf.set(name, value)
    return spark
