"""Rows that carry many values as packed columns, dealt to blocks by a hash.

One row per value costs Spark far more than the value. A task therefore packs
all values it sends to a block into one row: arrays as binary columns, laid out
so that shuffle compression finds their regularities. A block is a share of the
hash space, ``spark.sql.shuffle.partitions`` times ``PER_PARTITION`` of them, so
that setting bounds the size of a block as it does for any other shuffle.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import functions as F

from obsflow.session import write_shared

PER_PARTITION = 2
#: Bytes of the batches that Python workers are given: Spark's own 64 MB are held several times over in a worker and its executor.
BATCH = "4m"
#: Stands for a null document id where ids are compared; sorts before every id.
NO_ID = -(1 << 63)

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def shipped(spark):
    """Let Python workers on this machine import the package; a cluster installs it or uses --py-files.

    Also lets Spark remove the shuffle files of a query when the query ends: the
    operators go on from written tables, and those files would only fill disks.
    """
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, paths)])
    return spark


def in_small_batches(spark):
    """``shipped``, and tasks get their rows in batches of ``BATCH`` bytes, or one row if it is longer."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH)
    return shipped(spark)


def n_blocks(spark):
    """How many blocks the session's shuffles are to have."""
    return int(spark.conf.get("spark.sql.shuffle.partitions")) * PER_PARTITION


def block_of(hashes, n):
    """The block of each hash, from its high bits."""
    return (((hashes >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)).astype(np.int64)


def pack(values):
    """An array as bytes."""
    return np.ascontiguousarray(values).tobytes()


def unpack(value, dtype):
    """Bytes as an array."""
    return np.frombuffer(value, dtype=dtype)


def deal(blocks):
    """An order that groups values by block, and each block with its slice of that order."""
    if blocks.max(initial=0) < 1 << 16:
        blocks = blocks.astype(np.uint16)  # sorts by counting
    order = np.argsort(blocks, kind="stable")
    dealt = blocks[order]
    begin = np.flatnonzero(changes(dealt))
    found, ends = dealt[begin], np.append(begin[1:], len(order))
    return [(int(b), order[i:j]) for b, i, j in zip(found, begin, ends)]


def ranges(sizes):
    """Which item each element belongs to, for items of the given sizes laid end to end."""
    return np.repeat(np.arange(len(sizes)), sizes)


def changes(*columns):
    """True where a row differs from the one before, in any column."""
    out = np.ones(len(columns[0]), dtype=bool)
    if len(out):
        out[1:] = False
        for c in columns:
            out[1:] |= c[1:] != c[:-1]
    return out


def batch(schema, rows):
    """Rows, as tuples, in one record batch of an Arrow schema."""
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.record_batch([pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema)


def with_keys(docs):
    """``text`` of ``docs`` with ``_k``, the id or ``NO_ID``, ``_t``, a hash of the text, and the other columns in ``_row``.

    The pair of keys names a document: rows alike in both are one document
    repeated, and rows that share only the id are ordered by the hash. In one
    struct, the other columns clash with no name that an operator uses.
    """
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("_k"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("_t"),
        "text",
        F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != "text")).alias("_row"),
    )


def without_keys(df, docs, *added):
    """The columns of ``docs`` from a frame with ``text`` and ``_row``, then ``added``."""
    columns = [F.col("text") if c == "text" else F.col(f"_row.`{c}`").alias(c) for c in docs.columns]
    return df.select(*columns, *added)


def but(docs, *names):
    """``docs`` without columns of these names."""
    return docs.select(*(F.col(f"`{c}`") for c in docs.columns if c not in names))


def squeeze(df):
    """``df`` with ``text`` compressed, for joins that move whole texts; ``loosen`` undoes it in a task."""

    def run(batches):
        packer = zstandard.ZstdCompressor(level=1)  # half the time of level 3 for a hundredth more bytes
        for b in batches:
            at = b.schema.get_field_index("text")
            small = [None if x is None else packer.compress(x) for x in b.column(at).cast(pa.binary()).to_pylist()]
            yield b.set_column(at, "text", pa.array(small, type=pa.binary()))

    kinds = [f"`{f.name}` {'binary' if f.name == 'text' else f.dataType.simpleString()}" for f in df.schema]
    return df.mapInArrow(run, ", ".join(kinds))


def written(df, name):
    """``df`` written to the shared folder and read again, and the bytes of its files."""
    folder = write_shared(df, name)
    hadoop = df.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
    files = hadoop.getFileSystem(df.sparkSession._jsc.hadoopConfiguration())
    return df.sparkSession.read.parquet(folder), files.getContentSummary(hadoop).getLength()


def loosen(batches, rows=2000):
    """Batches of a squeezed frame, a few thousand rows at a time, with ``text`` as it was."""
    opener = zstandard.ZstdDecompressor()
    for whole in batches:
        for lo in range(0, whole.num_rows, rows):
            b = whole.slice(lo, rows)
            at = b.schema.get_field_index("text")
            large = [None if x is None else opener.decompress(x) for x in b.column(at).to_pylist()]
            yield b.set_column(at, "text", pa.array(large, type=pa.binary()).cast(pa.string()))



def added_up(tables, keys, limit=400_000):
    """Record batches of ``tables`` with every other column summed by ``keys``, over about ``limit`` rows at a time."""

    def together(some):
        both = pa.concat_tables(some)
        sums = [c for c in both.schema.names if c not in keys]
        found = both.group_by(list(keys), use_threads=False).aggregate([(c, "sum") for c in sums])
        return found.rename_columns({f"{c}_sum": c for c in sums}).select(both.schema.names)

    pending, size = [], 0
    for table in tables:
        pending.append(table)
        size += len(table)
        if size > limit:
            pending = [together(pending)]
            size = len(pending[0])
            if size > limit // 2:
                yield from pending[0].to_batches()
                pending, size = [], 0
    if pending:
        yield from together(pending).to_batches()
