"""Cutting lineage where several results are drawn from one expensive frame."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

# Temporary folders made for local sessions, by application.
_LOCAL: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``.

    Only a local master may do without the setting: a temporary folder of this
    machine is then made, and removed when the process ends.
    """
    folder = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError(f"{CHECKPOINT_CONF} must name a folder that all executors share")
    application = spark.sparkContext.applicationId
    if application not in _LOCAL:
        _LOCAL[application] = tempfile.mkdtemp(prefix="tiffinlens-")
        atexit.register(shutil.rmtree, _LOCAL[application], ignore_errors=True)
    return _LOCAL[application]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for one run's files under ``shared_folder``."""
    return os.path.join(shared_folder(spark), f"{name}-{os.urandom(6).hex()}")


def settle(frame: DataFrame) -> DataFrame:
    """A reliable checkpoint: computed once, kept in the shared folder, safe if executors are lost."""
    context = frame.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_folder(frame.sparkSession))
    return frame.checkpoint(eager=True)
