"""Where streams keep their state.

Spark's default store holds all state in the executors' heaps, twice (two versions).
``state_on_disk`` starts a stream with its state in RocksDB, which lies on the executors' disks; what it
keeps in memory is bounded for each executor, however many partitions have state there.
A micro-batch uploads the rows it changed (a change log), not files of the whole store, and the four
tables of a join share one store a partition.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import SparkSession

# Spark's setting for the state store of streams, and two of its classes.
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
DEFAULT_STORE = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
DISK_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

ROCKSDB = "spark.sql.streaming.stateStore.rocksdb"
#: Settings of a stream whose state lies in RocksDB; one that the session has itself stays.
ON_DISK = {
    STATE_STORE: DISK_STORE,
    f"{ROCKSDB}.boundedMemoryUsage": "true",
    f"{ROCKSDB}.changelogCheckpointing.enabled": "true",
    # the count of all rows costs a lookup a write; only a metric shows it
    f"{ROCKSDB}.trackTotalNumberOfRows": "false",
    "spark.sql.streaming.join.stateFormatVersion": "3",
}


@contextmanager
def state_on_disk(spark: SparkSession):
    """The session keeps the state of streams in RocksDB, unless it names a store of its own.

    A stream takes these settings over when it starts; the store and the format of a checkpoint
    that is there already are the checkpoint's."""
    if spark.conf.get(STATE_STORE, DEFAULT_STORE) != DEFAULT_STORE:
        yield
        return
    own = spark.conf.getAll
    ours = {k: v for k, v in ON_DISK.items() if k == STATE_STORE or k not in own}
    for k, v in ours.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k in ours:
            if k in own:
                spark.conf.set(k, own[k])
            else:
                spark.conf.unset(k)
