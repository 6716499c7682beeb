"""Packing of token sequences into windows by non-negative least squares.

A document is cut into full windows and one rest. The rests are counted by
length, a histogram no longer than the window. Every way to fill a window with at
most three lengths is a column over the lengths, the repeat counts of the ways
are fitted to the histogram by non-negative least squares, rounded down
and kept within what there is, and topped up greedily. The n-th rest of a length then
knows its window from n alone. What no way takes is laid end to end, longest
first, in groups, and cut at every window; the end of a group is cut at powers of two,
which need no padding.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import Window
from pyspark.sql import functions as F

from obsflow.llm.blocks import in_small_batches, pack, unpack
from obsflow.llm.bpe import SPLIT, texts_of, vocabulary
from obsflow.session import materialise

WINDOW = 2048
END = 1
#: Third lengths of the ways to fill a window are multiples of this share of it.
GRID = 32
SWEEPS = 60
_FULL, _LEFT = 1 << 61, 1 << 62
_encoders = {}


def ways(window=WINDOW, grid=GRID):
    """All pairs of lengths that fill a window, and triples of which two are on a grid: rows of three, padded with 0."""
    pairs = [(a, window - a, 0) for a in range(window // 2, 0, -1)]
    step = max(window // grid, 1)
    triples = [
        (a, b, window - a - b)
        for a in range(step, window // 2, step)
        for b in range(a, (window - a) // 2 + 1, 1 if a == step * 4 else step)
        if window - a - b >= b
    ]
    return np.array(pairs + triples, dtype=np.int64)


def fit(histogram, columns, sweeps=SWEEPS):
    """Repeat counts x >= 0 of the columns, close to the least of |sum of columns - histogram|^2.

    Cyclic coordinate descent: each count in turn takes its best value given the others.
    """
    rest = histogram.astype(np.float64).copy()
    rest[0] = 0.0
    x = np.zeros(len(columns))
    parts = [np.unique(c[c > 0], return_counts=True) for c in columns]
    norm = [float((m * m).sum()) for _, m in parts]
    for _ in range(sweeps):
        moved = 0.0
        for j, (at, m) in enumerate(parts):
            step = float((rest[at] * m).sum()) / norm[j]
            step = max(step, -x[j])
            if step:
                x[j] += step
                rest[at] -= m * step
                moved = max(moved, abs(step))
        if moved < 0.25:
            break
    return x


def plan(histogram, window=WINDOW, grid=GRID):
    """Where rests go: (length, first, end, base, offset) for the first to end-th rest of a length,
    into windows from ``base`` on at ``offset``; the number of windows; rests covered for each length."""
    columns = ways(window, grid)
    left = histogram.astype(np.int64).copy()
    counts = np.floor(fit(histogram, columns)).astype(np.int64)
    taken = np.zeros(len(columns), dtype=np.int64)
    # Rounded counts within what there is, then as many more as there are.
    for wanted in (counts, np.full(len(columns), np.iinfo(np.int64).max)):
        for j in np.argsort(-counts, kind="stable"):
            at, m = np.unique(columns[j][columns[j] > 0], return_counts=True)
            more = min(int(wanted[j]), int((left[at] // m).min()))
            left[at] -= more * m
            taken[j] += more
    rows, used, base = [], np.zeros(len(histogram), dtype=np.int64), 0
    for j in np.flatnonzero(taken):
        offset = 0
        for length in columns[j][columns[j] > 0]:
            first = int(used[length])
            rows.append((int(length), first, first + int(taken[j]), base, offset))
            used[length] += taken[j]
            offset += int(length)
        base += int(taken[j])
    return rows, base, used


def powers_of_two(n):
    """``n`` as falling powers of two."""
    return [1 << i for i in range(n.bit_length() - 1, -1, -1) if n >> i & 1]


def _encoder(path):
    """Ids of a text by a vocabulary file, as an array, and the size of the vocabulary.

    tiktoken gives the ids of the tokenizers library for byte-level vocabularies
    whose ids follow the order of merges, in a third of its time. It takes whole texts: to look
    up words that were met before costs more than to merge them again.
    """
    if path not in _encoders:
        known = vocabulary(path)
        ranks = {token: i for i, token in enumerate(known.text) if i not in known.special.values()}
        encoding = tiktoken.Encoding("pieces", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=known.special)
        _encoders[path] = partial(encoding.encode_to_numpy, allowed_special="all"), len(known.text)
    return _encoders[path]


def _encode(path, window, end):
    """Task side: ids of each document, packed small, and running numbers that need no shuffle."""

    def run(batches):
        encode, size = _encoder(path)
        small = "<u2" if size <= 1 << 16 else "<u4"
        full, part = 0, TaskContext.get().partitionId()
        seen = np.zeros(window, dtype=np.int64)
        row = part << 36
        for b in batches:
            names = iter(b.column("doc_id").to_pylist())
            for texts in texts_of(b.column("text")):
                out = {c: [] for c in ("row", "doc_id", "n", "full", "nth", "ids")}
                for text in texts:
                    ids = np.append(encode(text), np.uint32(end))
                    rest = len(ids) % window
                    for c, v in zip(out, (row, next(names), len(ids), full, int(seen[rest]), ids.astype(small).tobytes())):
                        out[c].append(v)
                    row += 1
                    full += len(ids) // window
                    seen[rest] += 1
                n = len(out["row"])
                kinds = [pa.int64()] * 5 + [pa.binary()]
                columns = [pa.array(v, type=kind) for v, kind in zip(out.values(), kinds)]
                width = pa.array([int(small[2])] * n, type=pa.int32())
                yield pa.record_batch([*columns, width, pa.array([part] * n, type=pa.int32())], names=[*out, "width", "part"])

    return run


def _lay(window):
    """Group side: rests laid end to end, longest first, and cut at every window."""

    def run(key, table):
        group = key[0].as_py()
        length, row = (table.column(c).to_numpy() for c in ("length", "row"))
        order = np.lexsort((row, -length))
        length, row = length[order], row[order]
        end = np.cumsum(length)
        total = int(end[-1]) if len(end) else 0
        edges = np.arange(0, total - total % window + 1, window)
        edges = np.append(edges, edges[-1] + np.cumsum(powers_of_two(total % window), dtype=np.int64))
        begin = end - length
        # Pieces: between each two neighbours among the starts of rests and the edges.
        cut = np.unique(np.concatenate([begin, edges]))
        at, size = cut[:-1], np.diff(cut)
        owner = np.searchsorted(begin, at, side="right") - 1
        where = np.searchsorted(edges, at, side="right") - 1
        return pa.table(
            {
                "row": pa.array(row[owner], type=pa.int64()),
                "begin": pa.array(at - begin[owner], type=pa.int64()),
                "length": pa.array(size, type=pa.int64()),
                "sequence_id": pa.array(_LEFT + (group << 40) + where, type=pa.int64()),
                "offset": pa.array(at - edges[where], type=pa.int64()),
            }
        )

    return run


_PIECE = pa.schema(
    [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary())]
    + [("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())]
)
_PIECE_DDL = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def _pieces(window):
    """Task side: the pieces of each document with their ids."""

    def run(batches):
        for b in batches:
            out = {f.name: [] for f in _PIECE}
            for r in b.to_pylist():
                ids = unpack(r["ids"], f"<u{r['width']}").astype("<u4")
                whole = len(ids) // window
                places = [(i * window, window, _FULL + (r["part"] << 40) + r["full"] + i, 0) for i in range(whole)]
                places += [(whole * window + p["begin"], p["length"], p["sequence_id"], p["offset"]) for p in r["places"] or ()]
                for start, length, sequence, offset in places:
                    values = (r["doc_id"], start, length, pack(ids[start : start + length]), len(ids), sequence, offset)
                    for c, v in zip(out, values):
                        out[c].append(v)
            yield pa.record_batch([pa.array(v, type=f.type) for v, f in zip(out.values(), _PIECE)], schema=_PIECE)

    return run


def pack_sequences(docs, path, window=WINDOW, end=END, grid=GRID):
    """One row per piece: ``doc_id``, ``start``, ``length``, ``ids``, ``doc_tokens``, ``sequence_id``, ``offset``.

    A document is the ids of ``text`` by the vocabulary file ``path`` (a null text is
    empty) and then ``end``; each id lies in exactly one piece. The pieces of a
    sequence follow each other from offset 0 without gaps, a sequence has at most
    ``window`` ids, and either ``window`` or a power of two: nothing is padded.
    ``ids`` are little-endian unsigned 32-bit integers, ``doc_tokens`` counts the ids
    of the document. Rows that repeat an id or a text are documents each; a null
    ``doc_id`` stays null. Columns other than ``doc_id`` and ``text`` are not read.
    """
    spark = in_small_batches(docs.sparkSession)
    groups = int(spark.conf.get("spark.sql.shuffle.partitions"))
    fields = "row long, doc_id long, n long, full long, nth long, ids binary, width int, part int"
    encoded = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_encode(path, window, end), fields)
    encoded = materialise(encoded, "ids")
    rests = encoded.select("row", "part", "nth", (F.col("n") % window).alias("length")).where("length > 0")
    counted = rests.groupBy("length", "part").agg(F.count("*").alias("n"))
    histogram = np.zeros(window, dtype=np.int64)
    for r in counted.groupBy("length").agg(F.sum("n").alias("n")).collect():  # fewer than window rows
        histogram[r["length"]] = r["n"]
    rows, _, covered = plan(histogram, window, grid)
    # The number of a rest among all of its length: of earlier partitions, then within its own.
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    ranked = rests.join(counted.withColumn("before", F.coalesce(before, F.lit(0))).drop("n"), ["length", "part"])
    ranked = ranked.select("row", "length", (F.col("before") + F.col("nth")).alias("rank"))
    # At most three rows for each way: bounded by the window, whatever the data.
    table = spark.createDataFrame(rows or [(0, 0, 0, 0, 0)], "length long, first long, end long, base long, at long")
    near = (ranked["length"] == table["length"]) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("end"))
    placed = ranked.join(F.broadcast(table), near).select(
        "row",
        F.lit(0).cast("long").alias("begin"),
        ranked["length"],
        (F.col("base") + F.col("rank") - F.col("first")).alias("sequence_id"),
        F.col("at").alias("offset"),
    )
    limits = spark.createDataFrame([(i, int(c)) for i, c in enumerate(covered)], "length long, covered long")
    left = ranked.join(F.broadcast(limits), "length").where("rank >= covered")
    left = left.select("row", "length", F.pmod(F.xxhash64("row"), F.lit(groups)).alias("bucket"))
    laid = left.groupBy("bucket").applyInArrow(
        _lay(window), "row long, begin long, length long, sequence_id long, offset long"
    )
    places = placed.union(laid).groupBy("row").agg(
        F.collect_list(F.struct("begin", "length", "sequence_id", "offset")).alias("places")
    )
    whole = encoded.select("row", "doc_id", "n", "full", "ids", "width", "part")
    return whole.join(places.hint("merge"), "row", "left").mapInArrow(_pieces(window), _PIECE_DDL)
