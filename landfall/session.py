"""Session settings and the shared folder for tables written between steps."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import SparkSession

SETTINGS = {
    # Code lists up to this size meet the extract without a shuffle; Spark compares it with their size.
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    # A longer list of up to the second size is made a Bloom filter for rows of which more than the first are read.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1g",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1g",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Rows of one key compress well, so a partition of them is split from a modest size on.
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64m",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Larger pieces of a scan make fewer, larger output files where no shuffle lies between.
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}


# What one shuffle partition should hold, so that it fits a task's share of executor memory.
SHUFFLE_PARTITION_BYTES = 128 * 1024 * 1024


def shuffle_partitions(shuffled_bytes: int) -> int:
    """Enough partitions for a shuffle of that size; adaptive execution joins those that turn out small."""
    return max(200, -(-shuffled_bytes // SHUFFLE_PARTITION_BYTES))


def build_session(
    app: str = "landfall", master: str | None = None, shuffled_bytes: int | None = None, **extra: str
) -> SparkSession:
    """A session with the settings the library is tested under.

    ``shuffled_bytes`` is the largest shuffle to expect, for instance the size of the
    admission columns of all extracts.
    """
    builder = SparkSession.builder.appName(app)
    if shuffled_bytes:
        extra.setdefault("spark.sql.shuffle.partitions", str(shuffle_partitions(shuffled_bytes)))
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@lru_cache(maxsize=1)
def _local_folder() -> str:
    base = tempfile.mkdtemp(prefix="landfall-")
    atexit.register(shutil.rmtree, base, ignore_errors=True)
    return base


def workspace(spark: SparkSession) -> str:
    """A new, empty directory name in the folder shared by driver and executors.

    The folder is the session's ``spark.checkpoint.dir``.  Only a local master, where
    executors are threads of the driver, may go without: it gets a temporary
    directory, one for the whole run of the program, deleted at its end.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        base = _local_folder()
    return f"{base.rstrip('/')}/landfall/{uuid.uuid4().hex}"
