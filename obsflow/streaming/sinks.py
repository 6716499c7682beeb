"""Starting queries: console, memory, files, snapshots and callbacks."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql.streaming import StreamingQueryListener

from obsflow.streaming.store import BatchStore, KeyedTable


@contextmanager
def state_partitions(spark, count=None):
    """Queries started inside keep their state in so many partitions, by default two per core at most.

    A stream opens every state partition in every batch, so it wants as many as
    the cores can serve, where a batch query lets adaptive execution merge. A
    query takes a copy of the settings when it starts; afterwards they are as before.
    """
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(count or min(int(before), 2 * spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def trigger_options(seconds=None):
    """Every so many seconds, or, without a number, all there is and then stop."""
    return {"processingTime": f"{seconds} seconds"} if seconds else {"availableNow": True}


def start(df, sink, mode="append", seconds=None, checkpoint=None, name=None, options=None):
    """Start a query on one of Spark's sinks."""
    writer = df.writeStream.format(sink).outputMode(mode).trigger(**trigger_options(seconds))
    writer = writer.options(**(options or {}))
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    return writer.start()


class LateRows(StreamingQueryListener):
    """Adds up the rows that came behind the watermark, over every batch of every query while it listens."""

    def __init__(self):
        self.rows = 0

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        self.rows += sum(s.numRowsDroppedByWatermark for s in event.progress.stateOperators)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass


@contextmanager
def late_counter(spark):
    """Count late rows of the queries that run inside; the count is whole once the block is left.

    Spark remembers the progress of the last hundred batches only, and a listener hears of all.
    Events come on a queue of their own, which is emptied before the listener goes.
    """
    late = LateRows()
    spark.streams.addListener(late)
    try:
        yield late
    finally:
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        spark.streams.removeListener(late)


def to_console(df, mode="append", seconds=5, checkpoint=None):
    """Print every batch with whole values."""
    return start(df, "console", mode, seconds, checkpoint, options={"truncate": "false"})


def to_memory(df, name, mode="update", seconds=None, checkpoint=None):
    """Keep a result as a named table on the driver; for looking at small results only."""
    return start(df, "memory", mode, seconds, checkpoint, name)


def to_files(df, path, checkpoint, seconds=None, format="parquet"):
    """Append to files, exactly once."""
    return start(df, format, "append", seconds, checkpoint, options={"path": path})


def for_each_batch(df, handle, checkpoint, mode="append", seconds=None, name=None):
    """Call ``handle(batch, batch_id)`` on the driver for each micro-batch."""
    writer = df.writeStream.outputMode(mode).trigger(**trigger_options(seconds))
    writer = writer.foreachBatch(handle).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    return writer.start()


def to_snapshots(df, path, checkpoint, mode="complete", seconds=None, keep=2):
    """Write the whole result of an aggregate anew in each batch, to be read as a static table.

    The last snapshots stay, so a reader of one is not disturbed by the next.
    """

    def handle(batch, batch_id):
        store = BatchStore(batch.sparkSession, path)
        store.write(batch, batch_id)
        store.forget(keep)

    return for_each_batch(df, handle, checkpoint, mode, seconds)


def read_snapshot(spark, path):
    """The latest whole snapshot."""
    store = BatchStore(spark, path)
    return store.read(store.latest())


def to_batches(df, path, checkpoint, mode="append", seconds=None, format="parquet"):
    """Append each batch as a folder of its own; a repeated batch replaces itself."""

    def handle(batch, batch_id):
        BatchStore(batch.sparkSession, path, format).write(batch, batch_id)

    return for_each_batch(df, handle, checkpoint, mode, seconds)


def to_keyed_table(df, path, checkpoint, keys, partition, seconds=None):
    """Keep an aggregate as a table by key: each batch replaces the rows it changed and the partitions they are in."""

    def handle(batch, batch_id):
        KeyedTable(batch.sparkSession, path, keys, partition).update(batch, batch_id)

    return for_each_batch(df, handle, checkpoint, "update", seconds)
