"""Settings and scratch folder."""

import os

import pytest

import __spark_entry__ as entry
from tidemark import session
from tidemark.session import (
    RUNTIME_SETTINGS,
    configure,
    input_bytes,
    new_scratch_path,
    scratch_root,
)

INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def test_shuffles_are_sized_by_the_files(spark, monkeypatch):
    orders = spark.read.parquet("/root/testdata/sf0.01/orders.parquet")
    size = os.path.getsize("/root/testdata/sf0.01/orders.parquet")
    assert input_bytes(orders, orders) == 2 * size
    try:
        for size, partitions in ((1, 8), (10 * 1024**3, 80), (10**15, 7_450_581), (1, 8)):
            monkeypatch.setattr(session, "input_bytes", lambda *frames, n=size: n)
            configure(spark, orders)
            assert spark.conf.get(INITIAL) == str(partitions)
    finally:
        spark.conf.unset(INITIAL)
    assert {k: spark.conf.get(k) for k in RUNTIME_SETTINGS} == RUNTIME_SETTINGS


def test_a_query_sizes_its_shuffles(spark):
    spark.conf.unset(INITIAL)
    entry.queries()["job_hoppers"](spark, "/root/testdata/sf0.01")
    assert spark.conf.get(INITIAL) == "8"


class Cluster:
    """A session as far as the scratch folder needs it."""

    def __init__(self, **settings):
        self.settings = settings
        self.conf = self

    def get(self, name, default=None):
        return self.settings.get(name.removeprefix("spark.").replace(".", "_"), default)


def test_scratch_is_the_shared_folder():
    cluster = Cluster(master="yarn", checkpoint_dir="hdfs:///shared/")
    assert scratch_root(cluster) == "hdfs:///shared"
    a, b = (new_scratch_path(cluster, "x") for _ in range(2))
    assert a != b and a.startswith("hdfs:///shared/tidemark/application/x-")


def test_no_local_scratch_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_root(Cluster(master="yarn"))
    assert scratch_root(Cluster(master="local[8]"))
