"""Session settings shared by every job, and the shared folder for files that cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Runtime settings every query relies on. Skew splitting and runtime broadcast
# decisions (made on measured sizes) are left to adaptive execution.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The JVM never compiles a method above 8,000 bytes; a stage that would need
    # one runs faster as separate operators with compiled expressions.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Recording a Python call site per expression costs more than planning a query.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

# Keyed state lives off the JVM heap, so it may outgrow executor memory; each
# batch uploads its changes only, and a join keeps one store per partition.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.join.stateFormatVersion": "3",
}


MIB = 1 << 20


def sizing(data_bytes, cores):
    """Partition settings for a batch over so many bytes on so many cores.

    Splits grow from 128 MiB to 1 GiB, so a large scan stays at a few waves of
    tasks. Shuffles start from one partition per 256 MiB of input, whatever that
    comes to; adaptive execution then merges what turned out small.
    """
    split = min(max(data_bytes // (cores * 8), 128 * MIB), 1024 * MIB)
    partitions = max(data_bytes // (256 * MIB), cores)
    return {
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * MIB),
    }


def tune(spark, path):
    """Apply ``sizing`` for the files under a path; returns their bytes."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    held = at.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(at).getLength()
    for key, value in sizing(held, spark.sparkContext.defaultParallelism).items():
        spark.conf.set(key, value)
    return held


def build_session(app_name="obsflow", master=None, shuffle_partitions=None, conf=None):
    """A session with the settings the jobs expect; ``master`` only for local runs.

    ``shuffle_partitions`` also fixes the number of state partitions of a
    stream for the life of its checkpoint.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {**RUNTIME_CONF, **STATE_CONF}
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark):
    """Give a session somebody else built the zone results depend on, and the other settings."""
    for key, value in {**RUNTIME_CONF, **STATE_CONF}.items():
        if spark.conf.get(key, None) != value and spark.conf.isModifiable(key):
            spark.conf.set(key, value)
    return spark


@contextmanager
def fixed_plans(spark):
    """Jobs run inside are planned once, without adaptive steps: for many small jobs over the same cached rows."""
    key = "spark.sql.adaptive.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def shared_folder(spark, name):
    """A fresh folder that every executor can reach.

    The cluster names the parent in ``spark.checkpoint.dir``. Only a local
    session without that setting falls back to a temporary folder.
    """
    parent = spark.conf.get("spark.checkpoint.dir", None)
    if not parent:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        parent = tempfile.mkdtemp(prefix="obsflow-")
        spark.conf.set("spark.checkpoint.dir", parent)
    return os.path.join(parent, f"{name}-{uuid.uuid4().hex}")


_intermediate = []


@contextmanager
def tidy(spark):
    """Delete the tables that ``materialise`` and ``write_shared`` wrote inside, once the block is left.

    For jobs that have written their results by then; a table read from such a folder is gone.
    """
    first = len(_intermediate)
    try:
        yield
    finally:
        hadoop = spark._jvm.org.apache.hadoop.fs
        for folder in _intermediate[first:]:
            at = hadoop.Path(folder)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
        del _intermediate[first:]


def write_shared(df, name="table"):
    """Write a table to a fresh shared folder and return the folder."""
    folder = shared_folder(df.sparkSession, name)
    _intermediate.append(folder)
    df.write.parquet(folder)
    return folder


def materialise(df, name="table"):
    """Write an intermediate result to the shared folder and go on from the files.

    For results several jobs read: they survive lost executors and are computed
    once. Joins with them are planned on the size the files really have.
    """
    return df.sparkSession.read.parquet(write_shared(df, name))
