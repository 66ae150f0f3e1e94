"""Session settings the library is designed for, and the shared scratch folder."""

from __future__ import annotations

import contextlib
import functools
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

# Adaptive execution merges shuffle partitions but cannot add any: ``sized_shuffles`` sets their number from the input. Stateful
# streams take theirs as an argument, because the number is fixed for the life of a checkpoint.
BATCH_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Also the size of the files a rebalanced write aims at.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Scans read two or three of the columns, so a split can be larger than the default; small inputs still use every core.
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even when that costs one more shuffle: a task holding a third of the rows costs more.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

STREAM_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # State of all products x open windows lives on local disk, not on the executor heap; changelogs make the
    # checkpoint upload per batch proportional to the changes, not to the state.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # A user's events of a batch become sessions before the shuffle: a user with a third of all events sends a few rows per task.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def build_session(app_name: str, conf: dict[str, str] | None = None) -> SparkSession:
    """A session with the settings above; anything set at submit time or in ``conf`` wins."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**BATCH_CONF, **STREAM_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


# What a shuffle carries (a few narrow columns, or counts) is about as large as the columnar input: a partition of 2 GiB sorts on
# an executor with 4 GB per core, spilling little. 100 TB make some 50,000 partitions; many more would cost the driver more in
# bookkeeping (partitions x scan tasks) than they save, above all for counts with few keys.
INPUT_BYTES_PER_SHUFFLE_PARTITION = 2 << 30


@contextlib.contextmanager
def sized_shuffles(spark: SparkSession, input_bytes: int) -> Iterator[int]:
    """For the jobs run inside: shuffle partitions raised, never lowered, to what an input of this size needs.

    The caller's number is back afterwards.
    """
    key = "spark.sql.shuffle.partitions"
    current = spark.conf.get(key)
    wanted = max(int(current), -(-input_bytes // INPUT_BYTES_PER_SHUFFLE_PARTITION))
    spark.conf.set(key, str(wanted))
    try:
        yield wanted
    finally:
        spark.conf.set(key, current)


def stream_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """A sibling session for stateful streams, so that their settings do not leak into the caller's batch work."""
    # A Connect client has no newSession, but can clone.
    sibling = spark.newSession() if hasattr(spark, "newSession") else spark.cloneSession()
    for key, value in STREAM_CONF.items():
        sibling.conf.set(key, value)
    if state_partitions is not None:
        sibling.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    return sibling


@functools.cache
def _local_scratch() -> str:
    return tempfile.mkdtemp(prefix="clicklake-")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder path under the shared folder named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster the executors could not see it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = _local_scratch()
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
