"""Observations as CSV files, tables and JSON messages on disk."""

from __future__ import annotations

from obsflow.schema import RAW_SCHEMA


def read_csv(spark, path, header=True, schema=RAW_SCHEMA):
    """Observations by column position, every field as text; no inference pass."""
    return spark.read.schema(schema).option("header", header).option("enforceSchema", True).csv(path)


def stream_csv(spark, path, header=True, schema=RAW_SCHEMA, files_per_trigger=None):
    """The same files as a stream, all there are in each batch.

    ``files_per_trigger`` sets a pace. Files are then taken by age, so rows of a
    later batch may be behind the watermark, where windows drop them.
    """
    reader = spark.readStream.schema(schema).option("header", header)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.csv(path)


def write_csv(df, path, header=True):
    """Observations as CSV, one file per task."""
    df.write.option("header", header).csv(path)


def stream_parquet(spark, path, schema, files_per_trigger=None):
    """A folder of parquet files as a stream."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def read_messages(spark, path):
    """JSON messages, one a line, in a column ``value``."""
    return spark.read.text(path)


def stream_messages(spark, path, files_per_trigger=None):
    """The same messages as a stream."""
    reader = spark.readStream
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.text(path)
