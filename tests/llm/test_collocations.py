"""Collocations against plain Python."""

import random
import re
from collections import Counter

import pytest

from obsflow.llm import collocations as module
from obsflow.llm.collocations import collocations

UPPER = {c: c + 32 for c in range(65, 91)}
COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def brute(rows, first, least):
    counts, n = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for i in range(len(words)):
                for k in range(1, min(5, len(words) - i) + 1):
                    counts.setdefault(lang, Counter())[tuple(words[i : i + k])] += 1
    out = []
    for lang, f in counts.items():
        found = {p for p in f if len(p) > 1 and f[p] >= least}
        gone = {p[i:j] for p in found for i in range(len(p)) for j in range(i + 2, len(p) + 1) if j - i < len(p) and f[p] >= f[p[i:j]]}
        ranked = []
        for p in found - gone:
            score, k = min((1000 * f[p] * n[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            ranked.append((-score, -f[p], " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for place, (score, a, phrase, left, right) in enumerate(sorted(ranked)[:first]):
            out.append((lang, place + 1, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def corpus(seed=1):
    r = random.Random(seed)
    words = [f"{c}{d}" for c in "abcé" for d in "wxyzß"] + ["A", "the", "the", "the"]
    fixed = ["one two three four five six seven", "the the the the the the", "north of the border", "New York City Hall", "x\ty  z"]
    rows = []
    for i in range(120):
        parts = []
        for _ in range(r.randint(0, 12)):
            parts.append(r.choice(fixed) if r.random() < 0.4 else " ".join(r.choices(words, k=r.randint(0, 7))))
        rows.append((r.choice([".", "\n", " ", ", ", "\x0b", " - "]).join(parts), r.choice(["en", "de", None, "und"])))
    return [*rows, (None, "en"), ("", "xx"), (" \t ", "yy"), rows[0], rows[0], ("so long " * 30000, "de")]


@pytest.mark.parametrize("first,least,share", [(2000, 4, 0.5), (6, 4, 0.05)])
def test_phrases_equal_brute_force(spark, monkeypatch, first, least, share):
    monkeypatch.setattr(module, "SHARE", share)
    rows = corpus()
    schema = "text string, lang string, h long, n int, word string, rank int, words string, place int"
    docs = spark.createDataFrame([(*r, 1, 2, "w", 3, "x", 4) for r in rows], schema).repartition(3)
    got = sorted(tuple(r) for r in collocations(docs, first, least).select(COLUMNS).collect())
    assert got == brute(rows, first, least)
    assert got


def test_families_below_the_last_score_are_not_grown(spark, monkeypatch):
    """Rare pairs fill the list in the first round, so prefixes of the common word are never expanded."""
    monkeypatch.setattr(module, "SHARE", 0.01)
    seen = []
    grow = module._expanded

    def spy(chosen, *rest):
        seen.extend(r.words[0] for r in chosen.collect())
        return grow(chosen, *rest)

    monkeypatch.setattr(module, "_expanded", spy)
    rows = [(f"rare{i} pair{i}", "en") for i in range(4) for _ in range(5)] + [("often seen", "en")] * 400
    docs = spark.createDataFrame(rows, "text string, lang string")
    got = sorted(tuple(r) for r in collocations(docs, 3, 5).select(COLUMNS).collect())
    assert got == brute(rows, 3, 5) and len(got) == 3
    frequent = module.materialise(docs.mapInArrow(module.count_words, "lang string, word string, h long, n long")).where("word IN ('often', 'seen')")
    assert not {r.h for r in frequent.collect()} & set(seen)


def test_wrong_hits_of_the_bitmap_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(module, "BITMAP", 7)
    rows = corpus(5)
    docs = spark.createDataFrame(rows, "text string, lang string")
    assert sorted(tuple(r) for r in collocations(docs, 20, 4).select(COLUMNS).collect()) == brute(rows, 20, 4)


def test_products_beyond_64_bits(spark):
    n, a = 9_000_000_000_000_000_000, 8_000_000_000_000_000_000
    row = spark.createDataFrame([(7, [1], n, [a + 1, a], "en", [5], 0, 0)], "h long, ends array<long>, n long, ls array<long>, lang string, words array<long>, before long, behind long")
    known = spark.createDataFrame([(1, a + 3)], "h long, a long")
    got = module._scored(row, known, ["h"]).first()
    assert got.score == 1000 * a * n // ((a + 1) * (a + 3))


def test_empty_and_wordless_tables(spark):
    for rows in ([], [(None, None)], [("a", "en"), ("b. c", "en")]):
        got = collocations(spark.createDataFrame(rows, "text string, lang string"), 5, 1)
        assert got.count() == 0 and got.columns == COLUMNS


def test_workers_get_small_batches(spark, monkeypatch):
    """Texts and rows of names come a few megabytes at a time, not ten thousand rows."""
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    seen, sizes = spark.sparkContext.accumulator(0), module.count_words

    def watched(batches):
        def told():
            for b in batches:
                seen.add(b.nbytes > 5 << 20)
                yield b

        return sizes(told())

    monkeypatch.setattr(module, "count_words", watched)
    docs = spark.range(1500).repartition(1).selectExpr("repeat('some words ', 1000) text", "'en' lang")
    assert collocations(docs).count()
    assert seen.value == 0
