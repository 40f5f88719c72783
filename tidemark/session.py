"""Session settings the operators count on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

# Runtime settings only, so they can be put on a session that already runs.
# Forcing the skew split lets adaptive execution break up a hot join key even
# where the step above the join would have reused the join's partitioning.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


# A shuffle partition of this size sorts in the memory of one task.
PARTITION_BYTES = 128 * 1024**2
# Catalyst takes a frame of unknown size for larger than this.
UNKNOWN_BYTES = 1 << 62


def input_bytes(*frames: DataFrame) -> int:
    """The total size of the files of the frames, as Catalyst knows it.

    A frame whose size it does not know, such as one of a database, counts nothing.
    """
    plans = (df._jdf.queryExecution().analyzed() for df in frames)
    sizes = (int(str(plan.stats().sizeInBytes())) for plan in plans)
    return sum(size for size in sizes if size < UNKNOWN_BYTES)


def configure(spark: SparkSession, *shuffled: DataFrame) -> SparkSession:
    """Put the runtime settings on ``spark`` and hand it back.

    ``shuffled`` are the tables read. Shuffles then start with a partition for
    each ``PARTITION_BYTES`` of their files, however many these are, and with
    no fewer than ``spark.sql.shuffle.partitions``; adaptive execution merges
    those that turn out small.
    """
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    if shuffled:
        least = int(spark.conf.get("spark.sql.shuffle.partitions"))
        wanted = -(-input_bytes(*shuffled) // PARTITION_BYTES)
        spark.conf.set(
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(max(least, wanted))
        )
    return spark


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="tidemark-")


def scratch_root(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder of the machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    return _local_folder()


_folders: set[str] = set()


def new_scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the application's scratch folder that nothing else uses.

    The folder is removed when the application ends.
    """
    application = spark.conf.get("spark.app.id", "application")
    folder = f"{scratch_root(spark)}/tidemark/{application}"
    if folder not in _folders and isinstance(spark, SparkSession):
        _folders.add(folder)
        context = spark.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(folder)
        files = path.getFileSystem(context._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
    return f"{folder}/{name}-{uuid.uuid4().hex}"
