"""Playing a table back as a stream in time order."""

from __future__ import annotations

import time

from pyspark.sql import Window
from pyspark.sql import functions as F

from obsflow.session import materialise, shared_folder
from obsflow.streaming.sinks import state_partitions, to_files


def time_slices(df, ts, slices):
    """Bounds of equally long slices of the table's time span, one row on the driver."""
    first, last = df.agg(F.min(F.unix_micros(ts)), F.max(F.unix_micros(ts))).first()
    if first is None:
        return []
    width = (last - first) // slices + 1
    return [(first + i * width, first + (i + 1) * width) for i in range(slices)]


def replay(df, ts, run, slices=4):
    """Feed a table to a streaming query slice by slice.

    Each slice is written as files in the shared folder, then ``run(stream)``
    starts the query from its checkpoint, takes all of the slice as one batch
    and ends. Batches are thus in time order however many files a slice has,
    and the query is restarted from its checkpoint between any two. Rows without
    a time come with the first slice.
    """
    spark = df.sparkSession
    folder = shared_folder(spark, "replay")
    at = F.unix_micros(ts)
    for i, (low, high) in enumerate(time_slices(df, ts, slices)):
        own = (at >= low) & (at < high)
        df.where(own if i else own | at.isNull()).write.mode("append").parquet(folder)
        with state_partitions(spark):
            query = run(spark.readStream.schema(df.schema).parquet(folder))
        query.awaitTermination()


def replayed(df, ts, build, slices=4):
    """The appended result of ``build(stream)`` over a replayed table, read back as a batch."""
    spark = df.sparkSession
    out, checkpoint = shared_folder(spark, "result"), shared_folder(spark, "checkpoint")
    schema = []

    def run(stream):
        result = build(stream)
        schema[:] = [result.schema]
        return to_files(result, out, checkpoint)

    replay(df, ts, run, slices)
    return spark.read.schema(schema[0]).parquet(out)


def numbered(df, column="number"):
    """The table with its rows numbered from 0 without gaps, written to the shared folder.

    Rows are numbered inside their part of the table, which one task reads, and each part's
    first number is the sum of the parts before: a table of one row per part.
    """
    parts = df.select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_at"))
    placed = materialise(parts, "numbered")
    counts = placed.groupBy("_part").agg(F.count("*").alias("held"), F.min("_at").alias("_first"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_before", F.coalesce(F.sum("held").over(before), F.lit(0))).drop("held")
    number = F.col("_before") + F.col("_at") - F.col("_first")
    return placed.join(counts, "_part").select(number.alias(column), *[F.col(f"`{c}`") for c in df.columns])


def paced(df, rows_per_batch):
    """A table as a stream of so many rows in each batch, in the table's order, however its files are cut.

    With a trigger of one second that is the pace a second. Spark's own counter makes the pace and
    meets the numbered table; after the last row batches are empty.
    """
    spark = df.sparkSession
    own = materialise(numbered(df), "rows")
    ticks = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", rows_per_batch).load()
    return ticks.join(own, F.col("value") == F.col("number")).select(*[F.col(f"`{c}`") for c in df.columns])


def await_rows(query, rows, patience=300):
    """Let a paced stream run until its counter has passed so many rows and the batch is done, then stop it."""
    seen, last, until = 0, -1, time.monotonic() + patience
    while seen < rows and query.isActive and time.monotonic() < until:
        for p in query.recentProgress:
            if p["batchId"] > last:
                seen, last = seen + p["numInputRows"], p["batchId"]
        time.sleep(0.1)
    query.stop()
    if query.exception():
        raise query.exception()
    if seen < rows:
        raise TimeoutError(f"{seen} of {rows} rows in {patience} seconds")
