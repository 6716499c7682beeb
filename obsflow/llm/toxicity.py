"""Toxicity: a counterfactual-regularised linear classifier.

A document is the set of its words in lower case; a word counts as itself and as
its beginnings, which hold the stem where endings vary, all hashed into one table
of weights. For every training document a counterfactual is made by swapping the
identity terms in it for others of the list, or by adding a mention where it has
none. Training minimises the log loss plus a penalty on the squared difference of the
scores of the two, so what a group is called carries no weight, and a neutral
mention is no reason to flag a text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

from pyspark.sql import functions as F

from obsflow.llm.blocks import changes, pack, shipped, unpack
from obsflow.llm.labelled import Adam, held_out, labelled_sample, sigmoid, temperature
from obsflow.llm.words import _BYTE, NO_LETTER, mix, prefix_hashes, slices, span_hashes

BUCKETS = 1 << 18
#: Lengths in bytes of the beginnings of words.
BEGINNINGS = (4, 5, 6)
#: Labelled documents of each label used for training, at most.
SAMPLE = 5000
#: Weight of the squared score difference between a document and its counterfactual.
PENALTY = 1.0
DECAY = 0.05
#: A bucket must occur in so many sampled documents to carry a weight.
LEAST = 3
#: Names of groups in the languages of the corpus; a parameter.
IDENTITY = (
    "women men girls boys mothers fathers muslims christians jews hindus buddhists atheists immigrants refugees "
    "foreigners gays lesbians blacks whites asians africans arabs europeans elderly disabled deaf blind "
    "femmes hommes musulmans chrétiens juifs immigrés réfugiés étrangers "
    "frauen männer muslime christen juden einwanderer flüchtlinge ausländer "
    "mujeres hombres musulmanes cristianos judíos inmigrantes refugiados extranjeros"
).split()


def counterfactual(text, terms, random):
    """``text`` with every identity term swapped for another one, or with one added at its end."""
    if len(terms) < 2:
        return text
    known = {t: i for i, t in enumerate(terms)}
    shift = int(random.integers(1, len(terms)))

    def swap(found):
        word = found.group()
        other = terms[(known[word.lower()] + shift) % len(terms)]
        return other.capitalize() if word[:1].isupper() else other

    changed, n = regex.subn(r"\b(?:" + "|".join(map(regex.escape, terms)) + r")\b", swap, text, flags=regex.I)
    return changed if n else f"{text} {terms[shift]}"


def word_buckets(part):
    """Buckets of the distinct words of a slice (one row of columns: word, beginnings; -1: none), and their documents."""
    prefix = prefix_hashes(_BYTE[part.data])
    size = part.end - part.start
    words = mix(span_hashes(prefix, part.start, part.end) + size.astype(np.uint64))
    order = np.argsort(words)
    kind = np.uint16 if part.n_docs < 1 << 16 else np.int64
    order = order[np.argsort(part.doc[order].astype(kind), kind="stable")]
    order = order[changes(part.doc[order], words[order])]
    out = np.full((len(order), 1 + len(BEGINNINGS)), -1, dtype=np.int64)
    out[:, 0] = words[order] >> np.uint64(46)
    for i, n in enumerate(BEGINNINGS):
        long = size[order] > n
        start = part.start[order[long]]
        out[long, i + 1] = mix(span_hashes(prefix, start, start + n), 300 + n) >> np.uint64(46)
    return out, part.doc[order]


def _lowered(column):
    return pc.utf8_lower(pc.fill_null(column, ""))


def _features(column):
    """The feature buckets of each text, each as often as words of it have it."""
    for part in slices(_lowered(column), gaps=NO_LETTER):
        buckets, doc = word_buckets(part)
        ends = np.searchsorted(doc, np.arange(part.n_docs + 1))
        for i, j in zip(ends[:-1], ends[1:]):
            own = buckets[i:j].ravel()
            yield np.sort(own[own >= 0]).astype(np.int32)


def _training_rows(terms, seed):
    """Task side: features of sampled documents and of their counterfactuals."""

    def run(batches):
        for b in batches:
            texts, ids = b.column("text").to_pylist(), b.column("doc_id").to_pylist()
            other = [counterfactual(t, terms, np.random.default_rng([seed, i & 0x7FFFFFFF])) for t, i in zip(texts, ids)]
            own = [pack(x) for x in _features(b.column("text"))]
            swapped = [pack(x) for x in _features(pa.array(other, type=pa.string()))]
            kinds = [pa.array(x, type=pa.binary()) for x in (own, swapped)]
            yield pa.record_batch([b.column("doc_id"), b.column("label"), *kinds], names=["doc_id", "label", "own", "swapped"])

    return run


def _sums(w, flat, owner, n):
    return np.bincount(owner, weights=w[flat], minlength=n)


@dataclass
class Model:
    """Weights of buckets, bias and temperature."""

    weights: np.ndarray
    bias: float
    heat: float = 1.0


def evidence(own, labels):
    """How far each bucket tells the labels apart: squared log ratio of its shares of documents, 0 where it is rare."""
    counts = np.zeros((2, BUCKETS))
    for buckets, label in zip(own, labels):
        counts[int(label), np.unique(buckets)] += 1
    sizes = np.array([(labels == 0).sum(), (labels == 1).sum()])[:, None]
    ratio = np.abs(np.diff(np.log((counts + 1) / (sizes + 2)), axis=0)[0])
    return np.where(counts.sum(axis=0) >= LEAST, ratio**2, 0.0)


def train(own, swapped, labels, share, penalty=PENALTY, decay=DECAY, epochs=40, seed=11):
    """Fit weights on lists of feature buckets, of documents and of their counterfactuals.

    A weight is the evidence of its bucket times a fitted factor, so that thousands
    of rare words of few documents don't outweigh the words that many share.
    """
    random = np.random.default_rng(seed)
    order = random.permutation(len(labels))
    cut = max(len(order) * 4 // 5, 1)
    fitted, rest = order[:cut], order[cut:]
    scale = evidence([own[i] for i in fitted], labels[fitted])
    v, bias = np.zeros(BUCKETS), np.zeros(1)
    adam = Adam([v, bias], 0.01)
    for _ in range(epochs):
        random.shuffle(fitted)
        for lo in range(0, len(fitted), 500):
            at = fitted[lo : lo + 500]
            n = len(at)
            a, b = [own[i] for i in at], [swapped[i] for i in at]
            a_owner, b_owner = (np.repeat(np.arange(n), [len(x) for x in v_]) for v_ in (a, b))
            a, b = np.concatenate(a), np.concatenate(b)
            w = v * scale
            score = _sums(w, a, a_owner, n)
            error = (sigmoid(score + bias) - labels[at]) * share[at] / n
            drift = 2 * penalty * (score - _sums(w, b, b_owner, n)) / n
            gradient = np.bincount(a, weights=(error + drift)[a_owner], minlength=BUCKETS)
            gradient -= np.bincount(b, weights=drift[b_owner], minlength=BUCKETS)
            adam.step([gradient * scale + decay * v, np.array([error.sum()])])
    w = v * scale
    model = Model(w.astype(np.float32), float(bias[0]))
    if len(rest):
        scores = np.array([float(w[own[i]].sum()) for i in rest]) + model.bias
        model.heat = temperature(scores, labels[rest], share[rest])
    return model


def fit_toxicity(docs, labels, sample=SAMPLE, terms=IDENTITY, penalty=PENALTY, out=None, label="toxic"):
    """Train on at most ``sample`` labelled documents of each label; None if no document has a label.

    ``out`` maps a doc_id column to whether a document is held out.
    """
    shipped(docs.sparkSession)
    out = out or (lambda c: held_out(c, 3, 1))
    picked = labelled_sample(docs, labels, label, out, sample, worst=1)
    terms = tuple(terms)
    rows = picked.mapInArrow(_training_rows(terms, 5), "doc_id long, label int, own binary, swapped binary").collect()
    if not rows:
        return None
    rows = sorted(rows, key=lambda r: (r["doc_id"], r["own"]))
    y = np.array([r["label"] for r in rows], dtype=np.float64)
    share = np.where(y == 1, 1 / max(y.sum(), 1), 1 / max((1 - y).sum(), 1))
    return train([unpack(r["own"], np.int32) for r in rows], [unpack(r["swapped"], np.int32) for r in rows], y, share / share.mean(), penalty)


def score_toxicity(docs, model, threshold=0.7):
    """``docs`` with ``_score`` (0 to 1, higher: label 1 likelier) and ``_predicted``.

    Only ``text`` is an input; null and empty texts get the score of a text without
    words. Without a model (no labels) every score is 0. Columns stay; those
    named like the new ones are replaced.
    """
    spark = shipped(docs.sparkSession)
    names = [c for c in docs.columns if c not in ("_score", "_predicted")]
    docs = docs.select(*(F.col(f"`{c}`") for c in names))
    if model is None:
        return docs.withColumns({"_score": F.lit(0.0), "_predicted": F.lit(0)})
    sent = spark.sparkContext.broadcast(model)

    def run(batches):
        weights = np.append(sent.value.weights, np.float32(0)).astype(np.float64)
        for b in batches:
            scores = []
            for part in slices(_lowered(b.column("text")), gaps=NO_LETTER):
                buckets, doc = word_buckets(part)
                # Bucket -1 is the zero at the end.
                scores.append(np.bincount(doc, weights=weights[buckets].sum(axis=1), minlength=part.n_docs))
            scores = np.concatenate(scores) if scores else np.zeros(0)
            scores = sigmoid((scores + sent.value.bias) / sent.value.heat)
            predicted = pa.array((scores >= threshold).astype(np.int32))
            yield pa.record_batch([*(b.column(c) for c in names), pa.array(scores), predicted], names=[*names, "_score", "_predicted"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{fields}, _score double, _predicted int")
