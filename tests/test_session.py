"""What the library sets, and where it writes, on whose session."""

from types import SimpleNamespace

import pytest

from tiffinlens.plans.lineage import scratch_path, shared_folder
from tiffinlens.session import SETTINGS, tune


def test_tune_leaves_what_the_caller_has_set(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(name, "1MB")
    try:
        tune(spark)
        assert spark.conf.get(name) == "1MB"
    finally:
        spark.conf.unset(name)
    tune(spark)
    assert spark.conf.get(name) == SETTINGS[name]


def session(master, folder=None):
    context = SimpleNamespace(master=master, applicationId=master, getCheckpointDir=lambda: None)
    return SimpleNamespace(conf=SimpleNamespace(get=lambda name, other: folder or other), sparkContext=context)


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local-cluster[3,2,1024]", "k8s://https://host"])
def test_no_machine_local_folder_on_a_cluster(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(session(master))
    assert scratch_path(session(master, "hdfs://store/shared"), "x").startswith("hdfs://store/shared/x-")


def test_a_local_session_keeps_one_folder():
    assert shared_folder(session("local[2]")) == shared_folder(session("local[2]"))
