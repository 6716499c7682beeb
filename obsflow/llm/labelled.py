"""Bounded samples of labelled documents, and what the classifiers share."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F


def held_out(doc_id, modulus, remainder):
    """Whether a document is kept from training: by crc32 of its id as text; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus == remainder


def labelled_sample(docs, labels, label, out, size, worst):
    """``doc_id``, ``text`` and ``label`` of at most ``size`` documents of each label that are not held out (``out``).

    Taken by a hash of the id, so the sample is the same at every run. A document
    with several labels counts with the ``worst``: 0 or 1. Rows that share an id
    are one document, with the text whose hash is smallest.
    """
    given = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~out(F.col("doc_id")))
    given = given.groupBy("doc_id").agg((F.max(label) if worst else F.min(label)).alias("label"))
    picked = None
    for value in (0, 1):
        own = given.where(F.col("label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(size)
        picked = own if picked is None else picked.union(own)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # Broadcast, and one text per id inside map tasks: an id on many rows is not dealt to one task.
    met = texts.join(F.broadcast(picked), "doc_id").groupBy("doc_id", "label")
    return met.agg(F.min(F.struct(F.xxhash64("text"), "text"))["text"].alias("text")).select("doc_id", "text", "label")


def sigmoid(x):
    """Logistic function."""
    return 1.0 / (1.0 + np.exp(-np.clip(x, -60, 60)))


class Adam:
    """Adam steps on a list of arrays, in place."""

    def __init__(self, values, rate):
        self.values, self.rate, self.t = values, rate, 0
        self.m = [np.zeros_like(v) for v in values]
        self.s = [np.zeros_like(v) for v in values]

    def step(self, gradients):
        """One step along the gradients."""
        self.t += 1
        for v, g, m, s in zip(self.values, gradients, self.m, self.s):
            m += 0.1 * (g - m)
            s += 0.001 * (g * g - s)
            v -= self.rate * (m / (1 - 0.9**self.t)) / (np.sqrt(s / (1 - 0.999**self.t)) + 1e-8)


def temperature(logits, labels, weights):
    """The divisor of logits with the least log loss."""
    best = (np.inf, 1.0)
    for t in np.exp(np.linspace(np.log(0.2), np.log(8.0), 75)):
        p = np.clip(sigmoid(logits / t), 1e-9, 1 - 1e-9)
        loss = -(weights * (labels * np.log(p) + (1 - labels) * np.log(1 - p))).sum()
        best = min(best, (float(loss), float(t)))
    return best[1]
