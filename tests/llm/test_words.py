"""Hashes of words: the same wherever words stand, in little memory."""

import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from obsflow.llm import line_dedup, quality
from obsflow.llm.blocks import in_small_batches
from obsflow.llm.words import _BYTE, _SPACE, NO_LETTER, mix, powers, prefix_hashes, slices, span_hashes


def test_word_hashes_are_those_of_prefixes_of_the_whole_slice():
    texts = ["", None, "one  two\tthree", "x" * 200_000, "été one " * 30_000, "\n", "y"]
    for part in slices(pa.array(texts)):
        prefix = prefix_hashes(_BYTE[part.data])
        want = mix(span_hashes(prefix, part.start, part.end) + (part.end - part.start).astype(np.uint64))
        assert (part.word_hashes() == want).all()


@pytest.mark.parametrize("gaps", [_SPACE, NO_LETTER])
def test_bounds_of_words_are_those_of_each_text(gaps):
    """Also where texts follow each other without a byte between words, and around empty ones."""
    texts = ["", "a b", "c", "", "", "d\te ", None, " f\n", "gh", "é x\x0b\x1cy-z", ""]
    (part,) = slices(pa.array(texts), gaps=gaps)
    got = [part.data[a:b].tobytes() for a, b in zip(part.start, part.end)]
    kind = rb"[^\x20\x09-\x0D]+" if gaps is _SPACE else rb"[A-Za-z\x80-\xff]+"
    words = [re.findall(kind, (x or "").encode()) for x in texts]
    assert got == sum(words, []) and part.n_words.tolist() == [len(x) for x in words]


def test_word_hashes_take_little_more_than_the_words():
    (part,) = slices(pa.array(["some words of a text " * 150_000]))
    powers(1 << 17), powers(1 << 17, down=True)
    part.word_hashes()
    tracemalloc.start()
    part.word_hashes()
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    # Prefixes of all bytes take eight bytes for each and as much for every step.
    assert peak < 100 * len(part.start) < 24 * len(part.data)


def test_workers_get_small_batches(spark):
    """Thirty megabytes of text in one partition come a few megabytes at a time."""
    docs = spark.range(3000).repartition(1).select(F.repeat(F.lit("some words "), 1000).alias("text"))
    in_small_batches(spark)
    sizes = [r.n for r in docs.mapInArrow(lambda batches: (pa.record_batch([[b.nbytes]], ["n"]) for b in batches), "n long").collect()]
    assert sum(sizes) > 30 << 20
    assert max(sizes) < 5 << 20


@pytest.mark.parametrize("learn", [False, True])
def test_word_vectors_are_held_for_a_part_of_a_batch(learn):
    """The vectors of the words of four megabytes would take 600 MB."""
    vectors = [np.ones((n, quality.DIM), dtype=np.float32) for n, _ in quality._TABLES]
    text = pa.array(["a few words of text " * 200] * 1000)
    rows = pa.record_batch([text, pa.array([1] * len(text), pa.int32())], ["text", "label"])
    weights = [np.zeros((4 * quality.DIM + 2, quality.HIDDEN)), np.zeros(quality.HIDDEN), np.zeros(quality.HIDDEN), np.zeros(1)]
    model = quality.Model(vectors, 0.0, 1.0, weights, 1.0)
    run = quality._featured(vectors) if learn else quality._scored(lambda: model, 0.3, ["text"])
    sum(b.num_rows for b in run(iter([rows.slice(0, 10)])))
    tracemalloc.start()
    done = sum(b.num_rows for b in run(iter([rows])))
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert done == len(text)
    assert peak < 60 << 20


def test_words_of_the_lines_asked_for_only():
    """Sets of lines asked for equal those of all lines; words of other lines are neither hashed nor sorted."""
    texts = ["a b a\n\nc d", None, "x" * 70_000 + "\ne f\n" + "g h " * 40_000 + "\nc b a", "", "b a"]
    asked = [[0, 2, 9], [0], [1, 3], [], [0]]
    (part,) = slices(pa.array(texts))
    words, line, doc, number = line_dedup._line_sets(part)
    keep = np.array([n in asked[d] for d, n in zip(doc, number)])
    some, own, doc2, number2 = line_dedup._line_sets(part, lambda d: asked[d])
    assert (doc == doc2).all() and (number == number2).all()
    assert (some == words[keep[line]]).all() and (own == line[keep[line]]).all() and 0 < len(own) < len(line)
