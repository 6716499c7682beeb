"""Embedding near-dedup against plain Python, and the estimates it decides with."""

import math

import numpy as np
import pytest

from obsflow.llm import near_vectors as module
from obsflow.llm.near_vectors import near_vectors


def cosine(a, b):
    return float(np.dot(a, b) / math.sqrt(np.dot(a, a)) / math.sqrt(np.dot(b, b)))


def brute(rows, threshold=0.93):
    """(vec_id, n_links, component_id, kept) of rows (vec_id, vector, label)."""

    def fit(v, label):
        return label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    n, group = len(rows), list(range(len(rows)))
    links = [0] * n
    for i in range(n):
        for j in range(i):
            (_, a, x), (_, b, y) = rows[i], rows[j]
            if fit(a, x) and fit(b, y) and x == y and len(a) == len(b) and cosine(a, b) >= threshold:
                links[i] += 1
                links[j] += 1
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    out = []
    for i, (vec_id, _, _) in enumerate(rows):
        least = min((rows[j][0] for j in range(n) if group[j] == group[i] and rows[j][0] is not None), default=None)
        out.append((vec_id, links[i], least, vec_id == least))
    return sorted(out, key=repr)


def vectors(seed=2, dimension=12):
    r = np.random.default_rng(seed)
    rows = []
    for k in range(12):
        centre = r.standard_normal(dimension)
        for _ in range(int(r.integers(1, 9))):
            rows.append(((centre + r.standard_normal(dimension) * 0.28).tolist(), int(k % 3)))
    rows += [rows[0], rows[0], ([2 * x for x in rows[0][0]], rows[0][1]), (rows[0][0], 7), (rows[0][0], None), (rows[0][0], None)]
    rows += [(None, 1), ([], 1), ([0.0] * dimension, 1), ([0.0] * dimension, 1), ([1.0, None], 1), ([math.nan] * 2, 1)]
    rows += [([math.inf, 1.0], 1), ([1e200, 1e200], 1), ([1.0, 1.0], 1), ([1e-200, 1e-200], 1), ([-0.0, 1.0], 2), ([0.0, 1.0], 2)]
    out = [(1000 - 7 * i, *row) for i, row in enumerate(rows)]
    return [*out, (None, rows[5][0], rows[5][1]), (None, [5.0, 1.0], 9), out[3], out[3]]


def small(v):
    return v is None or not any(x is not None and math.isfinite(x) and (x != 0 and not 1e-100 < abs(x) < 1e100) for x in v)


@pytest.mark.parametrize("bucket,block", [(8192, 1024), (2, 3), (8192, 4)])
def test_links_and_components_equal_brute_force(spark, monkeypatch, bucket, block):
    monkeypatch.setattr(module, "BUCKET", bucket)
    monkeypatch.setattr(module, "BLOCK", block)
    rows = [r for r in vectors() if small(r[1])]
    schema = "vec_id long, embedding array<double>, label int, node int, h1 string, size int, key int, block int, kept int"
    df = spark.createDataFrame([(*r, 0, "h", 1, 2, 3, 4) for r in rows], schema).repartition(3)
    got = sorted((tuple(r) for r in near_vectors(df).select("vec_id", "n_links", "component_id", "kept").collect()), key=repr)
    assert got == brute(rows)
    assert any(r[1] > 2 for r in got)


def test_extreme_lengths_do_not_matter(spark):
    rows = [(1, [1e200, 1e200], 1), (2, [1.0, 1.0], 1), (3, [1e-200, 1e-200], 1), (4, [-1.0, 1.0], 1)]
    got = {r.vec_id: (r.n_links, r.component_id) for r in near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    assert got == {1: (2, 1), 2: (2, 1), 3: (2, 1), 4: (0, 4)}


def test_estimates_are_unbiased_and_bounded():
    r = np.random.default_rng(3)
    one = module.unit(r.standard_normal((300, 64)))
    two = module.unit(one + 0.05 * r.standard_normal((300, 64)))
    signs, factors = module.encode(two, 256)
    guess, spread = module.estimates(one, signs, factors)
    errors = guess - one @ two.T
    assert abs(errors.mean()) < 0.002
    assert abs((errors / spread).std() - 1) < 0.05
    assert (np.abs(errors) <= module.CONFIDENCE * spread).all()


def test_the_bound_spares_most_pairs(monkeypatch):
    """Of far pairs next to none is computed, of near pairs all are."""
    r = np.random.default_rng(4)
    one = module.unit(r.standard_normal((400, 64)))
    signs, factors = module.encode(one, module.BITS)
    guess, spread = module.estimates(one, signs, factors)
    maybe = guess + module.CONFIDENCE * spread >= 0.93
    assert maybe.diagonal().all() and maybe.sum() < 1.01 * len(one)


def test_bands_find_pairs_at_the_threshold(spark, monkeypatch):
    """Pairs a little above the threshold, in bands of several bits: as many as brute force finds, or nearly."""
    monkeypatch.setattr(module, "BUCKET", 16)
    r = np.random.default_rng(6)
    one = module.unit(r.standard_normal((400, 32)))
    off = r.standard_normal((400, 32))
    off -= (off * one).sum(axis=1, keepdims=True) * one
    two = 0.935 * one + math.sqrt(1 - 0.935**2) * module.unit(off)
    rows = [(i, v.tolist(), 1) for i, v in enumerate(np.concatenate([one, two]))]
    got = near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))
    assert got.where("n_links > 0").count() >= 0.99 * len(rows)


def test_float_vectors_and_empty_table(spark):
    schema = "vec_id long, embedding array<float>, label string"
    assert near_vectors(spark.createDataFrame([], schema)).count() == 0
    rows = [(2, [1.0, 2.0], "a"), (1, [1.0, 2.1], "a"), (0, [1.0, 2.0], "b")]
    got = sorted(tuple(r) for r in near_vectors(spark.createDataFrame(rows, schema)).collect())
    assert got == [(0, 0, 0, True), (1, 1, 1, True), (2, 1, 1, False)]
