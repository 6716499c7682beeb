"""Document fingerprints from prefix polynomial hashes.

Texts are code points. Two prefix arrays, modulo two primes, give the hash of
any span in constant time, whether and where another span stands, so equality
of spans is one comparison and the longest common extension of two places is
found by binary search over its length. The fingerprint of a text is the hash
of the whole and the smallest of the hashes of its spans of ``SPAN`` code points;
the likeness of two fingerprints estimates the Jaccard similarity of the span
sets from them.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Window
from pyspark.sql import functions as F

from obsflow.llm.blocks import changes, loosen, shipped, squeeze
from obsflow.llm.bpe import texts_of
from obsflow.llm.words import mix
from obsflow.session import materialise

SPAN = 16
KEPT = 64
_PRIMES = ((1 << 31) - 1, (1 << 31) - 19)
_BASES = (1_000_003, 1_618_033_989 % ((1 << 31) - 19))
_powers = {}


def _power(i, inverse, n):
    """The first ``n`` powers of base ``i`` or its inverse, modulo its prime."""
    have = _powers.get((i, inverse))
    if have is None or len(have) < n:
        prime = _PRIMES[i]
        base = pow(_BASES[i], -1, prime) if inverse else _BASES[i]
        have = np.ones(1, dtype=np.uint64)
        while len(have) < n:
            step = np.uint64(pow(base, len(have), prime))
            have = np.concatenate([have, have * step % np.uint64(prime)])
        _powers[i, inverse] = have
    return have[:n]


class Prefixes:
    """Prefix hashes of code points laid end to end."""

    def __init__(self, points):
        points = points.astype(np.uint64) + np.uint64(1)
        self.n = len(points)
        self._sums = []
        for i, prime in enumerate(_PRIMES):
            out = np.zeros(self.n + 1, dtype=np.uint64)
            # Sums of values below 2**31: no overflow before 2**33 code points.
            np.cumsum(points * _power(i, False, self.n) % np.uint64(prime), out=out[1:])
            self._sums.append(out % np.uint64(prime))

    def spans(self, start, end):
        """Hashes (62 bits) of spans; equal spans have equal hashes wherever they stand."""
        out = np.zeros(len(start), dtype=np.uint64)
        for i, prime in enumerate(_PRIMES):
            p, s = np.uint64(prime), self._sums[i]
            one = (s[end] + p - s[start]) % p * _power(i, True, self.n + 1)[start] % p
            out = (out << np.uint64(31)) | one
        return out

    def extension(self, a, b, limit):
        """For each pair of places, how many code points from there on are equal, at most ``limit``."""
        low, high = np.zeros(len(a), dtype=np.int64), np.asarray(limit, dtype=np.int64).copy()
        while (low < high).any():
            middle = (low + high + 1) // 2
            same = self.spans(a, a + middle) == self.spans(b, b + middle)
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low


def _points(texts):
    """Code points of texts laid end to end, and where each text begins."""
    at = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) for t in texts], out=at[1:])
    return np.frombuffer("".join(texts).encode("utf-32-le"), dtype="<u4"), at


def _smallest(hashes, owner, chosen, texts, out):
    """Put the smallest distinct of the chosen hashes of each text into ``out``; texts that have too few."""
    h, o = hashes[chosen], owner[chosen]
    order = np.lexsort((h, o))
    h, o = h[order], o[order]
    new = changes(o, h)
    h, o = h[new], o[new]
    begin, end = np.searchsorted(o, texts), np.searchsorted(o, texts, side="right")
    for d, i, j in zip(texts, begin, end):
        out[d] = h[i : min(j, i + KEPT)]
    return [d for d, i, j in zip(texts, begin, end) if j - i < KEPT]


def sketches(prefixes, at):
    """For each text its whole hash and the ``KEPT`` smallest distinct hashes of its spans, ascending."""
    sizes = np.diff(at)
    whole = mix(prefixes.spans(at[:-1], at[1:]) ^ mix(sizes.astype(np.uint64), 91), 92)
    out = [None] * len(sizes)
    # A text shorter than a span is one span.
    for d in np.flatnonzero(sizes < SPAN):
        out[d] = whole[d : d + 1] if sizes[d] else whole[:0]
    start = np.arange(max(at[-1] - SPAN + 1, 0))
    owner = np.repeat(np.arange(len(sizes)), sizes)[: len(start)]
    inside = at[owner + 1] - start >= SPAN
    start, owner = start[inside], owner[inside]
    hashes = mix(prefixes.spans(start, start + SPAN), 93)
    # Sort only what can be among the smallest; a text with too few distinct ones is sorted whole.
    share = np.minimum(1.0, 4.0 * KEPT / np.maximum(sizes, 1))
    bound = (share * (2.0**64 - 2048)).astype(np.uint64)
    long = np.flatnonzero(sizes >= SPAN)
    short = _smallest(hashes, owner, np.flatnonzero(hashes <= bound[owner]), long, out)
    again = [d for d in short if share[d] < 1.0]
    if again:
        begin, end = np.searchsorted(owner, again), np.searchsorted(owner, again, side="right")
        _smallest(hashes, owner, np.concatenate([np.arange(i, j) for i, j in zip(begin, end)]), again, out)
    return whole, out


def likeness(whole_a, a, whole_b, b):
    """Estimated share of common spans, 0 to 1; 1 for equal texts."""
    if whole_a == whole_b:
        return 1.0
    if not len(a) or not len(b):
        return 0.0
    both = np.concatenate([a, b])
    both.sort()
    twice = both[1:] == both[:-1]
    union = both[np.concatenate([[True], ~twice])]
    size = min(len(union), KEPT)
    return float((both[1:][twice] <= union[size - 1]).sum()) / size


def _name(whole, sketch):
    return f"{int(whole):016x}:" + (sketch >> np.uint64(32)).astype(">u4").tobytes().hex()


def edited(text, following):
    """``text`` with its last half replaced by as many code points from the start of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_RESULT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_chars", pa.int64()),
        ("edited_sha256", pa.string()),
        ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()),
        ("near_next", pa.float64()),
        ("unchanged", pa.int64()),
    ]
)
_DDL = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, unchanged long"
)
_PART = pa.schema([*_RESULT, ("role", pa.int32()), ("part", pa.int32()), ("text", pa.string())])
_DONE, _HEAD, _TAIL = 0, 1, 2


def fingerprint_rows(ids, texts, following):
    """Result columns of documents and the texts that follow them."""
    changed = [edited(t, f) for t, f in zip(texts, following)]
    points, at = _points([*texts, *following, *changed])
    prefixes = Prefixes(points)
    whole, sketch = sketches(prefixes, at)
    n = len(texts)
    sizes = np.diff(at)
    kept = prefixes.extension(at[:n], at[2 * n : 3 * n], np.minimum(sizes[:n], sizes[2 * n :]))
    return {
        "doc_id": ids,
        "n_chars": [len(t) for t in texts],
        "edited_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in changed],
        "fingerprint": [_name(whole[i], sketch[i]) for i in range(n)],
        "edited_fingerprint": [_name(whole[i], sketch[i]) for i in range(2 * n, 3 * n)],
        "near_edited": [likeness(whole[i], sketch[i], whole[2 * n + i], sketch[2 * n + i]) for i in range(n)],
        "near_next": [likeness(whole[i], sketch[i], whole[n + i], sketch[n + i]) for i in range(n)],
        "unchanged": kept.tolist(),
    }


def _table(schema, columns):
    n = len(next(iter(columns.values())))
    return pa.record_batch([pa.array(columns.get(f.name, [None] * n), type=f.type) for f in schema], schema=schema)


def _neighbours(batches):
    """Task side: documents of a sorted partition against the next; the first and the last leave their texts."""
    part = TaskContext.get().partitionId()
    last = None
    for b in loosen(batches):
        ids = iter(b.column("doc_id").to_pylist())
        for texts in texts_of(b.column("text")):
            own = [next(ids) for _ in texts]
            if last is None:
                yield _table(_PART, {"role": [_HEAD], "part": [part], "text": texts[:1]})
            else:
                own, texts = [last[0], *own], [last[1], *texts]
            last = own[-1], texts[-1]
            if len(texts) > 1:
                rows = fingerprint_rows(own[:-1], texts[:-1], texts[1:])
                yield _table(_PART, rows | {"role": [_DONE] * (len(texts) - 1)})
    if last is not None:
        yield _table(_PART, {"role": [_TAIL], "part": [part], "doc_id": [last[0]], "text": [last[1]]})


def _last_rows(batches):
    for b in batches:
        if b.num_rows:
            columns = (b.column(c).to_pylist() for c in ("doc_id", "text", "following"))
            yield _table(_RESULT, fingerprint_rows(*columns))


def fingerprints(docs):
    """One row per document, with the fingerprints of its text and of an edited one.

    ``docs`` are taken by descending ``doc_id``, null ids last, rows with one id by
    a hash of their texts; the document after the last is the first. The edited
    text has its last floor(n / 2) of n code points replaced by as many from the
    start of the next document (or all it has). ``near_edited`` and ``near_next``: likeness of the
    fingerprint to those of the edited text and of the next document.
    ``unchanged``: code points before the first that the edit changed. Null texts are
    empty; empty texts are like empty texts only. Rows alike in id and text are
    neighbours. Columns other than ``doc_id`` and ``text`` are not read.
    """
    spark = shipped(docs.sparkSession)
    order = [F.desc_nulls_last("doc_id"), F.asc("_t")]
    keyed = docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("_t"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = squeeze(keyed).repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("_t")
    rows = materialise(dealt.mapInArrow(_neighbours, f"{_DDL}, role int, part int, text string"), "fingerprints")
    heads = rows.where(f"role = {_HEAD}").select("part", F.col("text").alias("following"))
    tails = rows.where(f"role = {_TAIL}").select("part", "doc_id", "text")
    # Over one integer per partition: which one comes next; after the last, the first.
    used = heads.select("part")
    ordered = Window.orderBy("part")
    first = F.min("part").over(ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    step = used.select("part", F.coalesce(F.lead("part").over(ordered), first).alias("next"))
    ends = tails.join(step, "part").join(heads.withColumnRenamed("part", "next"), "next")
    ends = ends.select("doc_id", "text", "following").mapInArrow(_last_rows, _DDL)
    return rows.where(f"role = {_DONE}").select(*_RESULT.names).union(ends)
