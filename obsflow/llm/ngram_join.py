"""N-gram Jaccard join by parity sketches.

A document is the set of its word shingles. Every shingle hashes to one bit of a
sketch, and the bits are combined by exclusive or, so two sketches differ in at
most as many bits as their sets have elements that are not common: Hamming
distance is a lower bound of the symmetric difference. At a similarity of t two
sets of S elements together differ in at most S (1 - t) / (1 + t) bits, and in no
more pieces of a sketch. Sizes are cut into bands; a band fixes the number of
pieces, and a set near the upper end of its band is sketched for the next one as
well. A piece is 2^64 bits wide, so that few set bits already tell sets apart,
and is named by the exclusive or of the numbers of its set bits. Documents that
agree on a piece are verified on their sets.

A piece without a set bit says nothing and is never a key. A piece of one
shingle is shared by all that use a common phrase, and pairs of those grow with
the square of the corpus; so where the similarity allows it, a piece is a key
only if it holds two shingles. By the pigeonhole principle two linked sets agree
on such a piece if one of them has more of them than the two may differ in.
Bands have pieces enough for nearly every set. A set that falls short is
sketched again with another hash, pieces of one shingle and, each time, more
pieces, until it does not: of two linked sets either one suffices, or both go on
to the same next sketch, so no link is lost.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F

from obsflow.llm.blocks import (
    batch,
    block_of,
    changes,
    deal,
    in_small_batches,
    loosen,
    n_blocks,
    pack,
    ranges,
    squeeze,
    unpack,
    with_keys,
    without_keys,
)
from obsflow.llm.links import components
from obsflow.llm.words import mix, slices
from obsflow.session import materialise

SHINGLE = 3
PERCENT = 90
#: Bits of the sketch that candidates are compared on before their sets are; large sets get a power of two times as many.
BITS = 1024
#: Earlier partners that a member of a group is paired with in the first round; each round takes 16 times as many.
EARLIEST = 16
#: Members of a group that one task compares with as many others; larger groups are cut into pairs of such parts.
PART = 2048
_GROWTH = 1.4
#: By how many standard deviations the pieces of two shingles are to exceed what linked sets differ in.
_SURE = 1
_LARGEST = 1 << 40


@functools.cache
def band_edges(percent):
    """Lower ends of the size bands: partners of a set lie in its own band, the next or the one before."""
    edges, growth = [1], max(_GROWTH, 100 / percent)
    while edges[-1] < _LARGEST:
        edges.append(max(edges[-1] + 1, int(np.ceil(edges[-1] * growth))))
    return np.array(edges, dtype=np.int64)


def _differing(m, n, percent):
    """In how many elements linked sets of these sizes differ at most."""
    return (m + n) * (100 - percent) // (100 + percent)


def sets_of(part, k):
    """Distinct shingles of a slice: hashes sorted within documents, and where each document begins.

    A document of fewer than ``k`` words is one shingle of all its words.
    """
    words = part.word_hashes()
    at = part.inside(k)
    hashes, doc = part.run_hashes(words, k)[at] if len(at) else np.zeros(0, np.uint64), part.doc[at]
    short = np.flatnonzero((part.n_words > 0) & (part.n_words < k))
    if len(short):
        sizes = part.n_words[short]
        whole = np.zeros(len(short), np.uint64)
        for i in range(int(sizes.max())):
            more = sizes > i
            whole[more] = mix(whole[more] ^ words[part.first[short[more]] + i], i + 1)
        hashes, doc = np.concatenate([hashes, mix(whole, 11)]), np.concatenate([doc, short])
    order = np.argsort(hashes)
    kind = np.uint16 if part.n_docs < 1 << 16 else np.int64
    order = order[np.argsort(doc[order].astype(kind), kind="stable")]
    hashes, doc = hashes[order], doc[order]
    new = changes(doc, hashes)
    hashes, doc = hashes[new], doc[new]
    return hashes, np.searchsorted(doc, np.arange(part.n_docs + 1))


def set_keys(hashes, first):
    """128 bits that name each set, from sums that do not depend on order; empty sets have zeros."""
    out = np.zeros((len(first) - 1, 2), dtype=np.uint64)
    for i in (0, 1):
        total = np.zeros(len(hashes) + 1, dtype=np.uint64)
        np.cumsum(mix(hashes, 21 + i), out=total[1:])
        out[:, i] = total[first[1:]] - total[first[:-1]]
    return mix(out, 5)


@functools.cache
def _pairing(band, percent):
    """The least number of pieces of which nearly every set of a band has enough that hold two shingles; 0 if there is none."""
    edges = band_edges(percent)
    largest = int(edges[band + 1]) - 1
    n = np.unique(np.linspace(-(-percent * int(edges[band]) // 100), largest, 33).astype(np.int64))
    differing = _differing(n, np.minimum(largest, 100 * n // percent), percent)
    least = _differing(largest, largest, percent) + 1
    count = np.unique(np.ceil(np.geomspace(least, max(least, largest), 200)).astype(np.int64))[:, None]
    each = n / count
    hold = 1 - np.exp(-each) * (1 + each)
    spread = np.sqrt(np.maximum(count * (hold * (1 - hold) - each**3 * np.exp(-2 * each)), 0))
    enough = (count * hold >= differing + 0.5 + _SURE * spread).all(axis=1)
    return int(count[enough.argmax(), 0]) if enough.any() else 0


def _pieces(hashes, sizes, band, percent, attempt):
    """Keys of the sketch pieces of sets laid end to end, the set of each, and which sets have too few for their links."""
    largest = band_edges(percent)[band + 1] - 1
    least = _differing(largest, largest, percent) + 1
    # Room for twice the empty pieces that the largest sets of the band are to have.
    spare = np.ceil(2 * least * np.exp(-largest / least)).astype(np.int64)
    bands, at = np.unique(band, return_inverse=True)
    paired = np.array([_pairing(int(b), percent) for b in bands], dtype=np.int64)[at]
    # Where pieces of two shingles come first, those of one begin with the second sketch.
    count = (least + spare) * (attempt + (paired == 0))
    count = (np.where(paired > 0, paired, count) if attempt == 0 else count).astype(np.uint64)
    hold = np.where((paired > 0) & (attempt == 0), 2, 1)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    if attempt:
        hashes = mix(hashes, 100 + attempt)
        order = np.lexsort((hashes, owner))
        hashes = hashes[order]
    piece = ((hashes >> np.uint64(32)) * count[owner]) >> np.uint64(32)
    begin = np.flatnonzero(changes(owner, piece))
    bits = mix(hashes, 31)
    parity = np.bitwise_xor.reduceat(bits, begin) if len(begin) else bits
    held = np.diff(begin, append=len(owner))
    owner, piece = owner[begin], piece[begin]
    full = (parity != 0) & (held >= hold[owner])
    owner, piece, parity = owner[full], piece[full], parity[full]
    partner = np.minimum(largest, 100 * sizes // percent)
    weak = np.bincount(owner, minlength=len(sizes)) <= _differing(sizes, partner, percent)
    name = (band[owner].astype(np.uint64) << np.uint64(40)) ^ piece
    return mix(mix(parity, 41 + attempt) ^ mix(name, 51)), owner, weak


def sketch_keys(hashes, first, percent=PERCENT):
    """Keys of all pieces of all sets, and the set of each key.

    At 50 percent or less a set may differ from a partner in as many elements as
    it has, so no number of pieces suffices.
    """
    if percent <= 50:
        raise ValueError("percent must be above 50")
    sizes, edges = np.diff(first), band_edges(percent)
    band = np.searchsorted(edges, sizes, side="right") - 1
    keys, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for up in (0, 1):
        # The next band holds partners of sets that reach percent of its lower end.
        those = np.flatnonzero((sizes > 0) & ((100 * sizes >= percent * edges[band + 1]) if up else True))
        attempt = 0
        while len(those):
            part = np.concatenate([hashes[first[i] : first[i + 1]] for i in those])
            key, owner, weak = _pieces(part, sizes[those], band[those] + up, percent, attempt)
            keys.append(key)
            owners.append(those[owner])
            those = those[weak]
            attempt += 1
    return np.concatenate(keys), np.concatenate(owners)


def _widths(sizes, percent):
    """Bits of the sketch of each set: six times what linked sets differ in, so that sets that have little in common differ in far more bits."""
    times = 6 * _differing(sizes, sizes, percent) / BITS
    return BITS << np.ceil(np.log2(np.maximum(times, 1))).astype(np.int64)


def wide_sketches(hashes, first, percent=PERCENT):
    """Parity sketches of the sets, as rows of bytes; those of large sets are wider."""
    sizes = np.diff(first)
    widths, bits, out = _widths(sizes, percent), mix(hashes, 97), [b""] * len(sizes)
    for width in np.unique(widths):
        chosen, step = np.flatnonzero(widths == width), max(1, 2048 * BITS // int(width))
        for lo in range(0, len(chosen), step):
            some = chosen[lo : lo + step]
            own = ranges(sizes[some])
            at = np.concatenate([bits[first[i] : first[i + 1]] for i in some]) & np.uint64(width - 1)
            count = np.bincount(own * width + at.astype(np.int64), minlength=len(some) * width)
            rows = np.packbits((count & 1).astype(np.uint8).reshape(len(some), -1), axis=1)
            for i, row in zip(some, rows):
                out[i] = row.tobytes()
    return out


def _folded(sketches, words):
    """Sketches as rows of 64-bit words, folded to so many words: what a narrower sketch of the same set would be."""
    return np.bitwise_xor.reduce(sketches.reshape(*sketches.shape[:-1], sketches.shape[-1] // words, words), axis=-2)


_MARKS = pa.schema(
    [
        ("block", pa.int32()),
        ("row", pa.int64()),
        ("doc_id", pa.int64()),
        ("_k", pa.int64()),
        ("_t", pa.int64()),
        ("n", pa.int64()),
        ("name", pa.binary()),
        ("sketch", pa.binary()),
        ("owner", pa.binary()),
        ("key", pa.binary()),
    ]
)
_MARKS_DDL = (
    "block int, row long, doc_id long, _k long, _t long, n long, name binary, sketch binary, owner binary, key binary"
)


def _mark(shingle, percent, blocks):
    """Task side: a row per document with the name of its set, and its sketch pieces packed by block."""

    def run(batches):
        row = TaskContext.get().partitionId() << 40
        for b in batches:
            doc_ids = b.column("doc_id").to_pylist()
            ids, texts = (b.column(c).to_numpy(zero_copy_only=False) for c in ("_k", "_t"))
            for part in slices(b.column("text"), lower=True):
                hashes, first = sets_of(part, shingle)
                names, sizes, wide = set_keys(hashes, first), np.diff(first), wide_sketches(hashes, first, percent)
                rows = [
                    (None, row + d, doc_ids[part.lo + d], int(ids[part.lo + d]), int(texts[part.lo + d]), int(sizes[d]), names[d].tobytes() if sizes[d] else None, wide[d], None, None)
                    for d in range(part.n_docs)
                ]
                # Of equal sets in a slice the first sends its pieces for all.
                _, one = np.unique(names, axis=0, return_index=True)
                one = np.sort(one[sizes[one] > 0])
                if len(one):
                    own = np.concatenate([hashes[first[i] : first[i + 1]] for i in one])
                    keys, owner = sketch_keys(own, np.concatenate([[0], np.cumsum(sizes[one])]), percent)
                    for block, chosen in deal(block_of(keys, blocks)):
                        chosen = chosen[np.argsort(owner[chosen], kind="stable")]
                        steps = np.diff(one[owner[chosen]], prepend=0).astype(np.int32)
                        rows.append((block, row, None, None, None, None, None, None, pack(steps), pack(keys[chosen])))
                row += part.n_docs
                yield batch(_MARKS, rows)

    return run


def _shared_keys(key, table):
    """Block side: the pieces that two rows or more hold, with those rows, packed and in order."""
    keys, rows = [], []
    for r in table.select(["row", "owner", "key"]).to_pylist():
        keys.append(unpack(r["key"], np.uint64))
        rows.append(r["row"] + np.cumsum(unpack(r["owner"], np.int32).astype(np.int64)))
    keys, rows = np.concatenate(keys), np.concatenate(rows)
    order = np.lexsort((rows, keys))
    group = np.cumsum(changes(keys[order])) - 1
    order = order[np.bincount(group)[group] > 1]
    return pa.table({"key": pa.array([pack(keys[order])], type=pa.binary()), "row": pa.array([pack(rows[order])], type=pa.binary())})


def _stars(with_key):
    """Task side: every row of a piece with the first row of it, distinct within a block or with the piece."""

    def run(batches):
        for b in batches:
            for keys, rows in zip(b.column("key").to_pylist(), b.column("row").to_pylist()):
                keys, rows = unpack(keys, np.int64), unpack(rows, np.int64)
                new = changes(keys)
                first = rows[np.maximum.accumulate(np.where(new, np.arange(len(keys)), 0))]
                if with_key:
                    yield pa.record_batch([pa.array(keys), pa.array(first), pa.array(rows)], names=["key", "a", "b"])
                    continue
                later = rows != first
                pairs = np.unique(np.stack([first[later], rows[later]], axis=1), axis=0)
                yield pa.record_batch([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], names=["a", "b"])

    return run


def _set_blobs(shingle):
    """Task side: the set of each document as packed sorted hashes."""

    def run(batches):
        for b in loosen(batches):
            row = b.column("row")
            for part in slices(b.column("text"), lower=True):
                hashes, first = sets_of(part, shingle)
                blobs = [pack(hashes[i:j]) for i, j in zip(first[:-1], first[1:])]
                yield pa.record_batch([row.slice(part.lo, part.n_docs), pa.array(blobs, type=pa.binary())], names=["row", "elements"])

    return run


def _may_link(m, n, x, y, percent):
    """Whether sizes and sketches of sets allow the similarity."""
    words = min(x.shape[-1], y.shape[-1])
    x, y = _folded(x, words), _folded(y, words)
    apart = np.bitwise_count(x ^ y).sum(axis=-1, dtype=np.int64)
    return (100 * np.minimum(m, n) >= percent * np.maximum(m, n)) & (apart <= _differing(m, n, percent))


def _near(percent):
    """Task side: whether sizes and sketches of two sets allow the similarity."""

    def run(batches):
        for b in batches:
            m, n = (b.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("m", "n"))
            sketches = [np.array(b.column(c).to_pylist(), dtype=object) for c in ("x", "y")]
            lengths = np.array([[len(v) for v in c] for c in sketches], dtype=np.int64).reshape(2, -1)
            near = np.zeros(b.num_rows, dtype=bool)
            for widths in np.unique(lengths, axis=1).T:
                some = np.flatnonzero((lengths == widths[:, None]).all(axis=0))
                x, y = (np.frombuffer(b"".join(c[some]), dtype=np.uint64).reshape(len(some), -1) for c in sketches)
                near[some] = _may_link(m[some], n[some], x, y, percent)
            yield pa.record_batch([b.column("a"), b.column("b"), pa.array(near)], names=["a", "b", "near"])

    return run


def _verify(percent):
    """Task side: whether two sets reach the similarity, exactly."""

    def run(batches):
        for b in batches:
            linked = np.zeros(b.num_rows, dtype=bool)
            for i, (x, y) in enumerate(zip(b.column("x").to_pylist(), b.column("y").to_pylist())):
                x, y = unpack(x, np.uint64), unpack(y, np.uint64)
                if 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)):
                    both = np.concatenate([x, y])
                    both.sort()
                    common = int((both[1:] == both[:-1]).sum())
                    linked[i] = 100 * common >= percent * (len(x) + len(y) - common)
            yield pa.record_batch([b.column("a"), b.column("b"), pa.array(linked)], names=["a", "b", "linked"])

    return run


def _cross_pairs(limit, percent):
    """Group side: near pairs of members of two parts of a piece from different components, the earliest ``limit`` for each member.

    A part that meets itself gives its own pairs. A row of nulls says that a
    member reached the limit and has earlier rows left.
    """

    def run(key, table):
        row, comp, size, part = (table.column(c).to_numpy() for c in ("row", "component", "n", "part"))
        two = key[1].as_py() != key[2].as_py()
        order = np.argsort(row)
        bits = [unpack(v, np.uint64) for v in table.column("sketch").to_pylist()]
        words = min(map(len, bits))
        bits = np.stack([_folded(v, words) for v in bits])[order]
        row, comp, size, part = row[order], comp[order], size[order], part[order]
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        taken = np.zeros(len(row), dtype=np.int64)
        active = np.arange(len(row))
        capped = False
        for i in range(len(row)):
            active = active[active > i]
            full = taken[active] >= limit
            capped |= bool(full.any())
            active = active[~full]
            if not len(active):
                break
            met = active[comp[active] != comp[i]]
            if two:
                met = met[part[met] != part[i]]
            met = met[_may_link(size[i], size[met], bits[i], bits[met], percent)]
            taken[met] += 1
            a.append(np.full(len(met), row[i]))
            b.append(row[met])
        a, b = pa.array(np.concatenate(a)), pa.array(np.concatenate(b))
        more = pa.nulls(int(capped), pa.int64())
        return pa.table({"a": pa.concat_arrays([a, more]), "b": pa.concat_arrays([b, more])})

    return run


def _labelled(docs, shingle, percent):
    """Every document (``row``, keys, id, size of its set) with its class and its component, null for empty sets."""
    if percent <= 50:
        raise ValueError("percent must be above 50")
    spark = in_small_batches(docs.sparkSession)
    keyed = with_keys(docs.select("doc_id", "text")).select("_k", "_t", "text", F.col("_row.doc_id").cast("long").alias("doc_id"))
    marks = materialise(keyed.mapInArrow(_mark(shingle, percent, n_blocks(spark)), _MARKS_DDL), "marks")
    members = marks.where("block is null").select("row", "doc_id", "_k", "_t", "n", "name", "sketch")
    classes = members.where("n > 0").groupBy("name").agg(
        F.min("row").alias("rep"), F.min("doc_id").alias("class_id"), F.min(F.struct("row", "_k", "_t")).alias("place")
    )
    reps = members.where("n > 0").select("row", "name").join(classes.select("name", "rep"), "name").select("row", "rep")
    shared = marks.where("block is not null").select("block", "row", "owner", "key")
    shared = materialise(shared.groupBy("block").applyInArrow(_shared_keys, "key binary, row binary"), "shared")

    def by_rep(pairs):
        """Rows of pairs replaced by the first row with an equal set."""
        for c in ("a", "b"):
            pairs = pairs.join(reps.select(F.col("row").alias(c), F.col("rep").alias(f"{c}_rep")), c)
        return pairs.drop("a", "b").withColumnsRenamed({"a_rep": "a", "b_rep": "b"})

    stars = by_rep(shared.mapInArrow(_stars(False), "a long, b long").distinct()).where("a <> b")
    stars = materialise(stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "stars")

    sketches = members.select("row", "n", "sketch")
    texts = keyed.select("_k", "_t", "text")

    def verified(pairs):
        """Pairs with whether they link: compared on their sketches, and those that are near on their sets."""
        x = sketches.select(F.col("row").alias("a"), F.col("n").alias("m"), F.col("sketch").alias("x"))
        y = sketches.select(F.col("row").alias("b"), "n", F.col("sketch").alias("y"))
        both = pairs.join(x, "a").join(y, "b").select("a", "b", "m", "n", "x", "y")
        compared = materialise(both.mapInArrow(_near(percent), "a long, b long, near boolean"), "compared")
        near = compared.where("near").select("a", "b")
        far = compared.where("not near").select("a", "b", F.lit(False).alias("linked"))
        if near.isEmpty():
            return far
        # The sets of what is left, from the texts.
        met = near.select("a").union(near.select("b")).distinct().withColumnRenamed("a", "row")
        places = classes.select("place.*").join(met, "row", "left_semi")
        held = squeeze(texts).join(places.hint("merge"), ["_k", "_t"]).select("row", "text")
        sets = materialise(held.mapInArrow(_set_blobs(shingle), "row long, elements binary"), "sets")
        # Dealt by row once: both joins read the same exchange.
        dealt = sets.repartition("row")
        x = dealt.select(F.col("row").alias("a"), F.col("elements").alias("x"))
        y = dealt.select(F.col("row").alias("b"), F.col("elements").alias("y"))
        both = near.join(x, "a").join(y, "b").select("a", "b", "x", "y")
        linked = both.mapInArrow(_verify(percent), "a long, b long, linked boolean")
        # A document repeated row by row gives its pairs more than once.
        return materialise(linked.union(far).distinct(), "checked")

    def labels():
        return materialise(components(checked.where("linked").select("a", "b")), "components")

    def label(rows, found, column):
        """``rows`` with the component of ``column``: itself where it has no link."""
        named = found.select(F.col("node").alias(column), F.col("component").alias("found"))
        of = F.coalesce("found", column).alias(f"{column}_component")
        return rows.join(named, column, "left").select(*rows.columns, of)

    # First everybody against the first of each piece. A piece of which every row is
    # then in the component of its first is settled; the others are opened.
    checked = verified(stars)
    found = labels()
    apart = label(label(stars, found, "a"), found, "b").where("a_component <> b_component").select("a", "b")
    first_row, row = reps.select(F.col("row").alias("a"), F.col("rep").alias("a_rep")), reps.select(F.col("row").alias("b"), F.col("rep").alias("b_rep"))
    flat = shared.mapInArrow(_stars(True), "key long, a long, b long").join(first_row, "a").join(row, "b")
    flat = flat.select("key", F.col("a_rep").alias("first"), F.col("b_rep").alias("row"))
    ends = apart.select(F.col("a").alias("x"), F.col("b").alias("y"))
    touched = flat.select("key", F.least("first", "row").alias("x"), F.greatest("first", "row").alias("y"))
    touched = touched.join(ends, ["x", "y"], "left_semi").select("key").distinct()
    groups = flat.select("key", "row").join(touched, "key", "left_semi").distinct()
    large = groups.groupBy("key").agg(F.count("*").alias("m")).where("m > 2").select("key")
    groups = materialise(groups.join(large, "key", "left_semi"), "groups")
    limit = EARLIEST
    while True:
        split = label(groups, found, "row").withColumnRenamed("row_component", "component")
        several = split.groupBy("key").agg(F.min("component").alias("u"), F.max("component").alias("v"), F.count("*").alias("m"))
        parts = several.where("u <> v").select("key", F.ceil(F.col("m") / PART).alias("parts"))
        split = split.join(parts, "key").withColumn("part", F.expr("pmod(xxhash64(row), parts)"))
        split = split.withColumn("other", F.explode(F.expr("sequence(0L, parts - 1)"))).join(sketches, "row")
        lower, upper = F.least("part", "other").alias("lower"), F.greatest("part", "other").alias("upper")
        split = split.select("key", lower, upper, "part", "row", "component", "n", "sketch")
        pairs = split.groupBy("key", "lower", "upper").applyInArrow(_cross_pairs(limit, percent), "a long, b long").distinct()
        pairs = materialise(pairs.join(checked.select("a", "b"), ["a", "b"], "left_anti"), "pairs")
        fresh = pairs.where("a is not null")
        if not fresh.isEmpty():
            checked = materialise(checked.union(verified(fresh)), "checked")
            found = labels()
        elif pairs.isEmpty():  # nothing new, and no member with rows left that it was not compared with
            break
        limit *= 16
    found = found.select(F.col("node").alias("rep"), "component")
    labelled = classes.select("name", "rep", "class_id").join(found, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    smallest = labelled.groupBy("component").agg(F.min("class_id").alias("component_id"))
    labelled = labelled.join(smallest, "component").select("name", "class_id", "component", "component_id")
    return members.drop("sketch").join(labelled, "name", "left")


def jaccard_components(docs, shingle=SHINGLE, percent=PERCENT):
    """One row per document: ``doc_id``, ``n_shingles``, ``class_id``, ``component_id``.

    Two documents link when 100 times the shingles they share are at least
    ``percent`` times, above 50, the shingles either has. ``component_id`` is the smallest
    ``doc_id`` reachable by links, ``class_id`` the smallest with an equal set.
    Words are compared with A-Z in lower case.

    Documents without words, and null texts, have no shingles and link with
    nothing. Rows that repeat an id or a text link like others. A null id is no
    candidate for the smallest: it gets the component of its links, or null.
    Columns other than ``doc_id`` and ``text`` are not read.
    Shingles are compared by 64-bit hashes.
    """
    return _labelled(docs, shingle, percent).select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
    )


def one_of_each(docs, shingle=SHINGLE, percent=PERCENT):
    """``docs`` with one document of each component: that of the smallest id, nulls last.

    Documents without words stay. Rows alike in id and text are one document,
    which comes once. Columns stay.
    """
    known = _labelled(docs, shingle, percent)
    place = F.struct(F.col("doc_id").isNull(), "doc_id", "_t", "_k")
    kept = known.where("component is not null").groupBy("component").agg(F.min(place).alias("place"))
    kept = kept.select("place._k", "place._t").union(known.where("component is null").select("_k", "_t")).distinct()
    keyed = squeeze(with_keys(docs))
    row = keyed.schema["_row"].dataType.simpleString()
    chosen = keyed.join(kept.hint("merge"), ["_k", "_t"], "left_semi").dropDuplicates(["_k", "_t"])
    return without_keys(chosen.select("_row", "text").mapInArrow(loosen, f"_row {row}, text string"), docs)
