"""Near duplicates among embeddings by randomised-rotation binary codes.

A vector of unit length, padded with zeros to the length of the code and rotated at
random, is stored as the signs of its coordinates together with a correction
factor: the inner product of the rotated vector and its own sign vector. For
another vector, its product with the sign vector divided by that factor is an
unbiased estimate of the inner product of the two, with an error that is normal and
known from the factor. A pair whose estimate lies further below the
threshold than the confidence bound is left; every other pair is computed
exactly, in double precision, and only an exact cosine makes a link.

Which pairs are estimated: pieces of the code are bands, and two vectors meet in the
first band they agree on. Bands are as long as the number of vectors
with one label asks for, so a bucket stays at about ``BUCKET`` of them, and there are so
many that a pair at the threshold agrees on none with a probability of at most
``MISS``; below ``BUCKET`` vectors a label has one band of no bits, that is every
pair. Buckets are cut into blocks of ``BLOCK`` and a task compares two blocks. It sends
link counts and a spanning forest, never pairs, so a group of copies costs as many
rows as it has members.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from obsflow.llm.links import components
from obsflow.session import materialise

THRESHOLD = 0.93
#: Standard deviations of the estimate's error that the confidence bound allows.
CONFIDENCE = 5.0
BITS = 256
BUCKET = 8192
BLOCK = 1024
MISS = 1e-4
SEED = 20
_CHUNK = 256


@functools.lru_cache(maxsize=16)
def rotation(bits, dimension):
    """The first ``dimension`` columns of a random orthogonal matrix of ``bits`` rows."""
    return np.linalg.qr(np.random.default_rng(SEED).standard_normal((bits, dimension)))[0]


def unit(vectors):
    """Rows scaled to length one, blind to overflow and underflow of squares."""
    x = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def encode(units, bits):
    """Signs (rows of 0 and 1) and correction factors of unit vectors."""
    turned = units @ rotation(bits, units.shape[1]).T
    return (turned >= 0).astype(np.uint8), np.abs(turned).sum(axis=1) / math.sqrt(bits)


def estimates(units, signs, factors):
    """Estimated inner products of vectors with coded ones, and the deviation of each code's error."""
    bits = signs.shape[1]
    turned = (units @ rotation(bits, units.shape[1]).T).astype(np.float32)
    plain = (signs.astype(np.float32) * 2 - 1) / np.float32(math.sqrt(bits))
    spread = np.sqrt(np.maximum(1 - factors * factors, 0)) / factors / math.sqrt(bits - 1)
    return turned @ plain.T / factors, spread


def band_keys(signs, bands, width):
    """The number each band of each code spells."""
    if not width:
        return np.zeros((len(signs), bands), dtype=np.int64)
    pieces = signs[:, : bands * width].reshape(len(signs), bands, width).astype(np.int64)
    return pieces @ (1 << np.arange(width, dtype=np.int64))


def _matrix(column, dimension):
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), dimension)


def _code(batches):
    """Rows with the code and factor of their vector and the keys of their bands."""
    for b in batches:
        if not b.num_rows:
            continue
        shape = np.stack([b.column(c).to_numpy() for c in ("dimension", "bits", "bands", "width")], axis=1)
        for own in np.unique(shape, axis=0):
            some = b.filter(pa.array((shape == own).all(axis=1)))
            dimension, bits, bands, width = (int(x) for x in own)
            signs, factors = encode(unit(_matrix(some.column("embedding"), dimension)), bits)
            keys = band_keys(signs, bands, width)
            ends = np.arange(len(signs) + 1, dtype=np.int32) * bands
            packed = [r.tobytes() for r in np.packbits(signs, axis=1)]
            added = [pa.array(packed, pa.binary()), pa.array(factors), pa.ListArray.from_arrays(ends, keys.ravel())]
            names = [*some.schema.names, "code", "factor", "keys"]
            yield pa.record_batch([*some.columns, *added], names)


def _join(root, x, y):
    """``root`` after the links between ``x`` and ``y``: the smallest place reachable so far."""
    while True:
        a, b = root[x], root[y]
        apart = a != b
        if not apart.any():
            return root
        x, y, a, b = x[apart], y[apart], a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(root, root[root]):
            root = root[root]


def linked_pairs(left, right, signs, factors, threshold, beyond):
    """Pairs (row of ``left``, row of ``right``) with an exact cosine of at least ``threshold``.

    ``signs`` and ``factors`` are the codes of ``right``; ``beyond`` holds, for each row
    of ``left``, the first row of ``right`` to look at.
    """
    guess, spread = estimates(left, signs, factors)
    maybe = guess + CONFIDENCE * spread >= threshold
    maybe &= np.arange(len(right)) >= beyond[:, None]
    x, y = np.nonzero(maybe)
    if len(x) * 8 > maybe.size:
        exact = (left @ right.T)[x, y]
    else:
        exact = np.concatenate([np.einsum("ij,ij->i", left[x[k : k + 65536]], right[y[k : k + 65536]]) for k in range(0, len(x), 65536)] or [np.zeros(0)])
    return x[exact >= threshold], y[exact >= threshold]


def _compare(threshold):
    """A task: one pair of blocks of one bucket, to link counts and a forest."""

    def run(key, table):
        band, i, j = (key[k].as_py() for k in (2, 4, 5))
        dimension, bits, bands, width = (table.column(c)[0].as_py() for c in ("dimension", "bits", "bands", "width"))
        node, size, block, factor = (table.column(c).to_numpy() for c in ("node", "size", "block", "factor"))
        units = unit(_matrix(table.column("embedding"), dimension))
        packed = np.frombuffer(b"".join(table.column("code").to_pylist()), dtype=np.uint8).reshape(len(node), -1)
        signs = np.unpackbits(packed, axis=1)[:, :bits]
        keys = band_keys(signs, bands, width)[:, :band]
        one, two = np.flatnonzero(block == i), np.flatnonzero(block == j)
        count, root = np.zeros(len(node), dtype=np.int64), np.arange(len(node))
        for lo in range(0, len(one), _CHUNK):
            own = one[lo : lo + _CHUNK]
            beyond = np.arange(lo, lo + len(own)) + 1 if i == j else np.zeros(len(own), dtype=np.int64)
            x, y = linked_pairs(units[own], units[two], signs[two], factor[two], threshold, beyond)
            x, y = own[x], two[y]
            for k in range(band):
                first = keys[x, k] != keys[y, k]
                x, y = x[first], y[first]
            np.add.at(count, x, size[y])
            np.add.at(count, y, size[x])
            root = _join(root, x, y)
        some, below = np.flatnonzero(count), np.flatnonzero(root != np.arange(len(node)))
        return pa.table(
            [
                pa.array(np.concatenate([node[some], node[below]])),
                pa.array([*([None] * len(some)), *node[root[below]].tolist()], pa.int64()),
                pa.array(np.concatenate([count[some], np.zeros(len(below), dtype=np.int64)])),
            ],
            ["a", "b", "n"],
        )

    return run


def _coded(classes, threshold):
    """Classes with their codes, in bands that suit the number of classes of their label."""
    agree = 1 - math.acos(threshold) / math.pi
    width = F.greatest(F.ceil(F.log2(F.col("n") / BUCKET)), F.lit(0)).cast("int")
    bands = F.ceil(math.log(MISS) / F.log(1 - F.pow(F.lit(agree), F.col("width")))).cast("int")
    shape = classes.groupBy("label", "dimension").agg(F.count("*").alias("n")).withColumn("width", width)
    shape = shape.withColumn("bands", F.when(F.col("width") == 0, F.lit(1)).otherwise(bands))
    needed = F.greatest(F.lit(BITS), F.col("dimension"), F.col("bands") * F.col("width"))
    shape = materialise(shape.withColumn("bits", (F.ceil(needed / 64) * 64).cast("int")).drop("n"), "shape")
    rows = classes.join(shape, ["label", "dimension"])
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(_code, f"{kinds}, code binary, factor double, keys array<long>")


def near_vectors(vectors, threshold=THRESHOLD):
    """Links and components of vectors with one label and a cosine of at least ``threshold``.

    Returns ``vec_id``, ``n_links`` (other rows linked directly), ``component_id`` (the
    smallest id of the component) and ``kept``, a row per row of ``vectors``.

    A vector that is null, empty, zero or has a null or non-finite component, or
    whose label is null, links with nothing and is its own component. Vectors of
    different length never link. Rows that repeat an id are rows of their
    own; a null id counts as a row and is a ``component_id`` only where
    no row of the component has an id. Other columns are not looked at.
    """
    rows = vectors.select("vec_id", "embedding", "label")
    odd = "exists(embedding, x -> x IS NULL OR isnan(x) OR abs(x) = double('infinity'))"
    takes_part = F.expr(f"label IS NOT NULL AND embedding IS NOT NULL AND NOT {odd} AND exists(embedding, x -> x <> 0)")
    rows = rows.withColumn("part", F.coalesce(takes_part, F.lit(False)))
    # 128 bits name a label and vector.
    names = [F.when(F.col("part"), F.xxhash64(F.lit(s), "label", "embedding")).alias(c) for s, c in ((1, "h1"), (2, "h2"))]
    rows = rows.select("vec_id", "embedding", "label", *names)
    classes = rows.where("h1 IS NOT NULL").groupBy("h1", "h2").agg(
        F.first("label").alias("label"), F.first("embedding").alias("embedding"),
        F.min("vec_id").alias("least"), F.count("*").alias("size"),
    )
    classes = classes.withColumn("dimension", F.size("embedding")).withColumn("node", F.monotonically_increasing_id())
    classes = materialise(classes, "classes")
    coded = materialise(_coded(classes.drop("h1", "h2", "least"), threshold), "codes")

    where = ["label", "dimension", "band", "key"]
    crowded = coded.select("label", "dimension", F.posexplode("keys").alias("band", "key")).groupBy(where).count()
    crowded = crowded.where(F.col("count") > BLOCK).withColumn("blocks", F.ceil(F.col("count") / BLOCK)).drop("count")
    crowded = materialise(crowded, "crowded")
    dealt = coded.select("*", F.posexplode("keys").alias("band", "key")).drop("keys").join(crowded, where, "left")
    dealt = dealt.withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    dealt = dealt.withColumn("other", other).withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})
    found = dealt.groupBy(*where, "i", "j").applyInArrow(_compare(threshold), "a long, b long, n long")
    found = materialise(found, "found")

    links = found.where("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    groups = components(found.where("b IS NOT NULL").select("a", "b"))
    placed = classes.select("h1", "h2", "node", "least", "size").join(links, "node", "left").join(groups, "node", "left")
    placed = materialise(placed.withColumn("component", F.coalesce("component", "node")), "placed")
    least = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    placed = placed.join(least, "component").select(
        "h1", "h2", (F.col("size") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), "component_id"
    )
    out = rows.select("vec_id", "h1", "h2").join(placed, ["h1", "h2"], "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
    )
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
