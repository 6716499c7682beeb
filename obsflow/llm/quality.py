"""Quality classifier: random-indexing word vectors, pooled, and a two-layer network.

Every term has a fixed sparse random index vector. The vector of a term is the sum
of the index vectors of its neighbours over all documents, which Spark adds up
from every task; sums of whole numbers, so they do not depend on order. Terms come in two
kinds: words, and shapes of words (runs of capitals, small letters, digits and
single marks). Both are hashed into tables of fixed size. A document
is the mean and the spread of the vectors of its terms. A network of one hidden layer is
trained on a bounded sample of labelled documents, and a temperature fitted on
a part of the sample that training did not see turns its output into probabilities.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F

from obsflow.llm.blocks import in_small_batches, pack, unpack
from obsflow.llm.labelled import Adam, held_out, labelled_sample, sigmoid, temperature
from obsflow.llm.words import byte_hashes, mix, slices

WORDS, SHAPES = 1 << 14, 1 << 11
DIM = 48
NONZERO = 4
REACH = (1, 2)
#: Labelled documents of each label used for training, at most.
SAMPLE = 6000
HIDDEN = 32
ROWS = 512
SALTS = 64
SLICE = 1 << 20
#: Bytes of text whose word vectors are held at once; they take some 200 bytes for each.
ROOM = 1 << 17

_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[0x41:0x5B] = 0x41
_SHAPE[0x61:0x7B] = 0x61
_SHAPE[0x80:] = 0x61
_SHAPE[0x30:0x3A] = 0x30


def index_vectors(n, salt):
    """Sparse random vectors of ``n`` terms: places and signs of their non-zero components."""
    h = mix(np.arange(n * NONZERO, dtype=np.uint64), salt).reshape(n, NONZERO)
    return (h % np.uint64(DIM)).astype(np.int64), np.where((h >> np.uint64(40)) & np.uint64(1), 1, -1).astype(np.int64)


_TABLES = ((WORDS, 201), (SHAPES, 202))


def terms(part):
    """Buckets of the words of a slice and of their shapes."""
    words = (part.word_hashes() >> np.uint64(20)) % np.uint64(WORDS)
    # A shape: the kinds of the bytes of a word, equal neighbours once.
    kind = _SHAPE[part.data]
    new = np.ones(len(kind), dtype=bool)
    new[1:] = kind[1:] != kind[:-1]
    new[part.start] = True
    place = np.concatenate([[0], np.cumsum(new)])
    shapes = mix(byte_hashes(kind[new], place[part.start], place[part.end]), 203)
    return words.astype(np.int64), ((shapes >> np.uint64(20)) % np.uint64(SHAPES)).astype(np.int64)


def _context(batches):
    """Task side: sums of the index vectors of neighbours, packed by ``ROWS`` terms."""
    totals = [np.zeros(n * DIM, dtype=np.int64) for n, _ in _TABLES]
    index = [index_vectors(n, salt) for n, salt in _TABLES]
    for b in batches:
        for part in slices(b.column("text"), limit=SLICE):
            for total, (place, sign), term in zip(totals, index, terms(part)):
                for reach in REACH:
                    same = part.doc[reach:] == part.doc[:-reach] if len(term) > reach else np.zeros(0, bool)
                    left, right = term[:-reach][same], term[reach:][same]
                    for a, b2 in ((left, right), (right, left)):
                        at = (a[:, None] * DIM + place[b2]).ravel()
                        total += np.bincount(at, weights=sign[b2].ravel(), minlength=len(total)).astype(np.int64)
    keys, sums = [], []
    for table, total in enumerate(totals):
        for i, rows in enumerate(total.reshape(-1, ROWS * DIM)):
            if rows.any():
                keys.append(table << 20 | i)
                sums.append(pack(rows))
    salt = TaskContext.get().partitionId() % SALTS
    yield pa.record_batch([pa.array(keys, type=pa.int32()), pa.array([salt] * len(keys), type=pa.int32()), pa.array(sums, type=pa.binary())], names=["key", "salt", "sums"])


def _add(batches):
    """Task side: sums by key, one held per key."""
    held = {}
    for b in batches:
        for key, rows in zip(b.column("key").to_pylist(), b.column("sums").to_pylist()):
            rows = unpack(rows, np.int64)
            held[key] = held[key] + rows if key in held else rows
    yield pa.record_batch([pa.array(list(held), type=pa.int32()), pa.array([pack(v) for v in held.values()], type=pa.binary())], names=["key", "sums"])


def word_vectors(docs):
    """Vectors of all terms from all documents: one float array per table, rows of unit length."""
    sums = docs.select("text").mapInArrow(_context, "key int, salt int, sums binary")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Two steps, each adding as it reads: no task holds more than a table.
    sums = sums.repartition(parts, "key", "salt").mapInArrow(_add, "key int, sums binary")
    sums = sums.repartition(parts, "key").mapInArrow(_add, "key int, sums binary")
    out = [np.zeros((n, DIM), dtype=np.float64) for n, _ in _TABLES]
    for row in sums.collect():  # at most WORDS + SHAPES rows of DIM numbers, whatever the data
        table, i = row["key"] >> 20, row["key"] & 0xFFFFF
        out[table][i * ROWS : (i + 1) * ROWS] += unpack(row["sums"], np.int64).reshape(ROWS, DIM)
    for (n, salt), vectors in zip(_TABLES, out):
        vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1.0)
        place, sign = index_vectors(n, salt)
        np.add.at(vectors, (np.arange(n)[:, None], place), sign / NONZERO)
    return [v.astype(np.float32) for v in out]


def document_features(part, vectors):
    """For each document of a slice: mean and spread of its vectors, and its length in words."""
    first, n = part.first[:-1], part.n_words
    full = np.flatnonzero(n)
    out = [np.zeros((part.n_docs, 4 * DIM + 2))]
    out = out[0]
    for i, (table, term) in enumerate(zip(vectors, terms(part))):
        if not len(full):
            break
        rows = table[term].astype(np.float64)
        mean = np.add.reduceat(rows, first[full], axis=0) / n[full, None]
        square = np.add.reduceat(rows * rows, first[full], axis=0) / n[full, None]
        out[full, 2 * i * DIM : (2 * i + 1) * DIM] = mean
        out[full, (2 * i + 1) * DIM : (2 * i + 2) * DIM] = np.sqrt(np.maximum(square - mean * mean, 0))
    out[:, -2] = np.log1p(n)
    out[:, -1] = np.log1p(np.diff(part.offsets) / np.maximum(n, 1))
    return out


@dataclass
class Model:
    """A trained classifier: word vectors, scales of features, two layers, temperature."""

    vectors: list
    mean: np.ndarray
    scale: np.ndarray
    layers: list
    heat: float

    def score(self, features):
        """Probability of label 1."""
        x = (features - self.mean) / self.scale
        w, b, v, c = self.layers
        return sigmoid((np.tanh(x @ w + b) @ v + c) / self.heat)


def train(features, labels, weights, vectors, epochs=60, seed=7):
    """Fit the network on three quarters of the sample, the temperature on the rest."""
    random = np.random.default_rng(seed)
    order = random.permutation(len(labels))
    mean, scale = features.mean(axis=0), features.std(axis=0) + 1e-6
    x = np.clip((features - mean) / scale, -8, 8)
    w = random.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN))
    layers = [w, np.zeros(HIDDEN), random.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
    cut = max(len(order) * 3 // 4, 1)
    own, rest = order[:cut], order[cut:]
    adam = Adam(layers, 0.003)
    for _ in range(epochs):
        random.shuffle(own)
        for lo in range(0, len(own), 128):
            at = own[lo : lo + 128]
            w, b, v, c = layers
            hidden = np.tanh(x[at] @ w + b)
            error = (sigmoid(hidden @ v + c) - labels[at]) * weights[at] / weights[at].sum()
            back = np.outer(error, v) * (1 - hidden**2)
            adam.step([x[at].T @ back + 1e-4 * w, back.sum(axis=0), hidden.T @ error, np.array([error.sum()])])
    model = Model(vectors, mean, scale, layers, 1.0)
    if len(rest):
        w, b, v, c = layers
        model.heat = temperature(np.tanh(x[rest] @ w + b) @ v + c, labels[rest], weights[rest])
    return model


def _featured(vectors):
    def run(batches):
        for b in batches:
            for part in slices(b.column("text"), limit=ROOM):
                rows = [pack(x) for x in document_features(part, vectors)]
                yield pa.record_batch([b.column("label").slice(part.lo, part.n_docs), pa.array(rows, type=pa.binary())], names=["label", "features"])

    return run


def fit_quality(docs, labels, sample=SAMPLE, out=None, label="quality"):
    """Train on at most ``sample`` labelled documents of each label, word vectors on all documents.

    ``out`` maps a doc_id column to whether a document is held out. None if no document has a label.
    """
    in_small_batches(docs.sparkSession)
    out = out or (lambda c: held_out(c, 5, 0))
    vectors = word_vectors(docs)
    picked = labelled_sample(docs, labels, label, out, sample, worst=0)
    spark = docs.sparkSession
    model_input = spark.sparkContext.broadcast(vectors)
    rows = picked.select("text", "label").mapInArrow(_broadcast_features(model_input), "label int, features binary").collect()
    if not rows:
        return None
    y = np.array([r["label"] for r in rows], dtype=np.float64)
    x = np.array([unpack(r["features"], np.float64) for r in rows])
    # The rarer label counts as much as the other.
    order = np.lexsort((*x.T[:4], y))
    x, y = x[order], y[order]
    share = np.where(y == 1, 1 / max(y.sum(), 1), 1 / max((1 - y).sum(), 1))
    return train(x, y, share / share.mean(), vectors)


def _broadcast_features(vectors):
    def run(batches):
        return _featured(vectors.value)(batches)

    return run


def _scored(model, threshold, names):
    """Task side: the columns of ``names``, then scores and what they predict; ``model`` gives the model in a task."""

    def run(batches):
        own = model()
        for b in batches:
            scores = [own.score(np.clip(document_features(p, own.vectors), -1e6, 1e6)) for p in slices(b.column("text"), limit=ROOM)]
            scores = np.concatenate(scores) if scores else np.zeros(0)
            predicted = pa.array((scores >= threshold).astype(np.int32))
            yield pa.record_batch([*(b.column(c) for c in names), pa.array(scores), predicted], names=[*names, "_score", "_predicted"])

    return run


def score_quality(docs, model, threshold=0.3):
    """``docs`` with ``_score`` (0 to 1, higher: label 1 likelier) and ``_predicted``.

    Only ``text`` is an input; null and empty texts get the score of a text without
    words. Without a model (no labels) every score is 1. Columns stay; those
    named like the new ones are replaced.
    """
    spark = in_small_batches(docs.sparkSession)
    names = [c for c in docs.columns if c not in ("_score", "_predicted")]
    docs = docs.select(*(F.col(f"`{c}`") for c in names))
    if model is None:
        return docs.withColumns({"_score": F.lit(1.0), "_predicted": F.lit(1)})
    sent = spark.sparkContext.broadcast(model)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(_scored(lambda: sent.value, threshold, names), f"{fields}, _score double, _predicted int")
