"""Substring dedup, line dedup and the n-gram join on a messy table, against plain Python."""

import hashlib

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from obsflow.llm import line_dedup, ngram_join
from obsflow.llm.line_dedup import dedup_lines
from obsflow.llm.links import components
from obsflow.llm.ngram_join import jaccard_components, one_of_each
from obsflow.llm.substring_dedup import dedup_substrings
from obsflow.llm.words import slices
import brute


@pytest.fixture(scope="module")
def rows(documents):
    """Documents as (id or -inf, text, hash of the text): the order of reading."""
    found = documents.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("t")).distinct().collect()
    return [(float("-inf") if r.doc_id is None else r.doc_id, r.text, r.t) for r in found]


def by_reading(row):
    return row[0], row[2]


def of(r):
    return float("-inf") if r.doc_id is None else r.doc_id


def test_substrings_equal_brute_force(documents, rows):
    got = dedup_substrings(documents).collect()
    want = brute.substring(rows, by_reading)
    assert len(got) == documents.count()
    by_id = {}
    for row, found in want.items():
        by_id.setdefault(row[0], set()).add(found)
    for r in got:
        assert (r._n_words, r._n_removed, r._kept_sha256) in by_id[of(r)]
        kept = brute.words(r.text)
        assert hashlib.sha256(b" ".join(kept)).hexdigest() == r._kept_sha256
        assert sum(s.end - s.start for s in r._spans) == r._n_removed
    assert sorted((of(r), r._kept_sha256) for r in {(x.doc_id, x._kept_sha256): x for x in got}.values()) == sorted(
        {(row[0], found[2]) for row, found in want.items()}
    )
    assert any(r._n_removed for r in got)


def test_substrings_keep_columns_and_nulls(documents):
    got = dedup_substrings(documents)
    assert got.columns[: len(documents.columns)] == documents.columns
    assert got.where("text is null").count() == documents.where("text is null").count()
    assert got.where("`_k` <> 'extra 0' or rank <> 'extra 12'").count() == 0


def test_repeated_word_and_short_window(spark):
    docs = spark.createDataFrame([(1, "of " * 21), (2, "of " * 19), (3, "of " * 20)], "doc_id long, text string")
    got = {r.doc_id: r._n_removed for r in dedup_substrings(docs).collect()}
    assert got == {1: 20, 2: 0, 3: 20}


def test_lines_equal_brute_force(documents, rows, monkeypatch):
    want = {}
    for row, found in brute.lines(rows).items():
        want.setdefault(row[0], set()).add(found)
    for named in (line_dedup.NAMED, 1):
        monkeypatch.setattr(line_dedup, "NAMED", named)
        got = dedup_lines(documents).collect()
        assert len(got) == documents.count()
        assert {(of(r), r.text, r._n_removed) for r in got} == {(i, *x) for i, found in want.items() for x in found}


def test_lines_of_few_words(spark):
    texts = ["a b c d e\na b c d\nq", "a b c d\n\nA b c d e\nq q q", "d c b a e f\nr"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.text for r in dedup_lines(docs).collect()}
    want = brute.lines(list(enumerate(texts)))
    assert got == {i: want[i, t][0] for i, t in enumerate(texts)}


def test_large_groups_of_near_lines_are_finished(spark, monkeypatch):
    """More partners than a group names, of which none of the first is similar enough."""
    monkeypatch.setattr(line_dedup, "NAMED", 2)
    base = [f"w{i}" for i in range(30)]
    texts = [" ".join(base[:23] + [f"x{i}{j}" for j in range(7)]) for i in range(9)]
    texts.append(" ".join(base[:23] + [f"x8{j}" for j in range(6)]))
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r._n_removed for r in dedup_lines(docs).collect()}
    assert got == {i: brute.lines(rows)[i, t][1] for i, t in rows}


@pytest.mark.parametrize("broadcast", [0, line_dedup.BROADCAST])
def test_lines_of_one_template_meet_in_pairs_of_parts(spark, monkeypatch, broadcast):
    """Lines that share their rarest word and pass the filters without being similar, over several parts."""
    for name, value in (("NAMED", 1), ("PART", 4), ("BROADCAST", broadcast)):
        monkeypatch.setattr(line_dedup, name, value)
    base = [f"w{i}" for i in range(30)]
    texts = [" ".join(base[:23] + [f"x{i}y{j}" for j in range(7)]) for i in range(14)]
    texts += [" ".join(base[:23] + [f"x{i}y{j}" for j in range(6)]) for i in (13, 2, 9)]
    texts += [" ".join(base[:23] + ["x5y0", "x5y1", "x5y2", "x5y3", "x5y4", f"z{i}", "z"]) for i in range(6)]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r._n_removed for r in dedup_lines(docs).collect()}
    want = {i: brute.lines(rows)[i, t][1] for i, t in rows}
    assert got == want and 0 < sum(want.values()) < len(rows)


def test_two_words_of_one_key_do_not_hide_each_other(spark):
    """A group can hold two postings of a line, at different places."""
    own = {"size": np.array([10, 10, 10]), "place": np.array([0, 1, 1]), "name": np.array([5, 5, 7])}
    own |= {"bits": np.zeros(3, np.uint64), "wide": np.zeros((3, 4), np.uint64)}
    late, early = np.array([1, 2, 2]), np.array([0, 0, 1])
    assert line_dedup._may_match(own, late, own, early, 80).tolist() == [False, True, True]


def test_pairs_pass_in_the_group_of_their_first_common_word_only():
    """At place 1 of ten words each, nine can follow; at place 2 only eight, so an earlier word is common or too few are."""
    own = {"size": np.array([10, 10, 10]), "place": np.array([1, 1, 2]), "name": np.array([5, 6, 7])}
    own |= {"bits": np.zeros(3, np.uint64), "wide": np.zeros((3, 4), np.uint64)}
    late, early = np.array([1, 2]), np.array([0, 0])
    assert line_dedup._may_match(own, late, own, early, 80).tolist() == [True, False]
    own["place"][0] = 2
    assert line_dedup._may_match(own, late, own, early, 80).tolist() == [False, False]


@pytest.mark.parametrize("ids", [range(300), [-(1 << 63), (1 << 63) - 1, *range(298)], [7] * 300])
def test_postings_are_ordered_and_repeated_ones_found(ids):
    """By one number, or, where ids lie far apart or postings tie, by their columns."""
    random = np.random.default_rng(4)
    own = {"key": random.integers(0, 9, 300).astype(np.uint32), "k": random.permutation(np.array(ids, np.int64))}
    own |= {"line": random.integers(0, 5, 300), "name": random.integers(0, 20, 300), "place": random.integers(0, 2, 300).astype(np.int32)}
    rows = [*zip(*(own[c].tolist() for c in ("key", "k", "line", "name")))]
    order = line_dedup._in_order(own)
    assert [rows[i] for i in order] == sorted(rows)
    seen, again = set(), []
    for i, posting in enumerate(zip(*(own[c].tolist() for c in ("key", "name", "place")))):
        if posting in seen:
            again.append(i)
        seen.add(posting)
    assert sorted(line_dedup._repeated(own)) == again and again


def test_counters_travel_in_few_rows(spark):
    texts = [f"a {i} b{i % 7}\n\nc a" for i in range(5000)] + [None, ""]
    rows = pa.record_batch([pa.array(texts)], ["text"])
    (counted,) = line_dedup._count(iter([rows, rows]))
    assert counted.num_rows <= line_dedup.COUNTERS // line_dedup.SHARE
    docs = spark.createDataFrame([(x,) for x in texts + texts], "text string").repartition(3)
    want = np.zeros(line_dedup.COUNTERS, dtype=np.int64)
    for part in slices(pa.array(texts + texts)):
        np.add.at(want, line_dedup._slot(part.word_hashes()), 1)
    assert (line_dedup.rarity(docs) == want).all() and want.sum() == 50_000


def test_words_are_hashed_again_only_where_rows_share_an_id(monkeypatch):
    texts, gone = ["a b\nc\n", None, "q\nr", "a b\nc"], [[{"line": 0, "name": 1}, {"line": 2, "name": 2}], None, None, [{"line": 1, "name": 3}]]
    columns = [pa.array([x and zstandard.compress(x.encode()) for x in texts]), pa.array(gone), pa.array([None] * 4, pa.bool_()), pa.array(range(4))]
    with monkeypatch.context() as m:
        m.setattr(line_dedup, "_line_sets", None)
        (out,) = line_dedup._drop(iter([pa.record_batch(columns, ["text", "gone", "shared", "_row"])]))
    assert out.column("text").to_pylist() == ["c", None, "q\nr", "a b"]
    assert out.column("_n_removed").to_pylist() == [2, 0, 0, 1]
    columns[2] = pa.array([None, None, None, True])  # of these rows no line has the name
    (out,) = line_dedup._drop(iter([pa.record_batch(columns, ["text", "gone", "shared", "_row"])]))
    assert out.column("_n_removed").to_pylist() == [2, 0, 0, 0]


def test_one_number_orders_words_by_rarity():
    random = np.random.default_rng(3)
    rank = random.permutation(line_dedup.COUNTERS).astype(np.uint32)
    for lines, values in ((1, 40), (50, 900), (3000, 20000)):
        # Words that differ in their last bits only must be told apart too.
        words = random.integers(0, 1 << 60, values, dtype=np.uint64) * np.uint64(16)
        words = np.concatenate([words, words[: values // 4] + np.uint64(1)])
        line = np.concatenate([part := random.integers(0, lines, values), part[: values // 4]])
        order = np.lexsort((words, line))
        words, line = words[order], line[order]
        want = np.lexsort((words, rank[line_dedup._slot(words)], line))
        assert (line_dedup._by_rarity(words, line, rank) == want).all()
    assert not len(line_dedup._by_rarity(words[:0], line[:0], rank))


def test_small_numbers_come_back():
    for values in ([], [0, 255], [256, 3], [65536, 1]):
        assert line_dedup._large(line_dedup._small(np.array(values, dtype=np.int64))).tolist() == values


def test_components_equal_brute_force(documents, rows):
    want = {}
    for row, (size, group) in zip(rows, brute.components([(r[0], r[1]) for r in rows])):
        known = [i for i, _ in group if i != float("-inf")]
        want.setdefault(row[0], set()).add((size, min(known) if known and size else (None if row[0] == float("-inf") else row[0])))
    got = jaccard_components(documents).collect()
    assert len(got) == documents.count()
    assert {(of(r), r.n_shingles, r.component_id) for r in got} == {(i, *x) for i, found in want.items() for x in found}


def test_links_beyond_the_first_of_a_group(spark):
    """A chain: neighbours link, ends do not, and the first of a group is far from most."""
    words = [f"w{i}" for i in range(140)]
    texts = [" ".join(words[i * 3 : i * 3 + 80]) for i in range(20)]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard_components(docs).collect()}
    want = brute.components(rows)
    assert got == {i: min(g)[0] for i, (_, g) in enumerate(want)}
    assert set(got.values()) == {0}


def test_links_behind_partners_tried_elsewhere(spark, monkeypatch):
    """The last two link, but share only pieces of the first, which looks near to both and was tried already."""
    monkeypatch.setattr(ngram_join, "EARLIEST", 1)
    same = "w2231 w903 w2583 w2846 w2115 w1846 w914 w2145 w2656 w125 w1617 w2764 w2358 w1315 w2702 w2584 w1746 w240 "
    rows = [(7, same + "w1203 w1428"), (2, same + "w1223 w514"), (5, same + "w1223 w868")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = {r.doc_id: r.component_id for r in jaccard_components(docs, shingle=1).collect()}
    assert got == {7: 7, 2: 2, 5: 2}


@pytest.mark.parametrize("sizes", [(9, 10), (10, 11), (19, 20), (27, 30), (180, 200)])
def test_links_across_bands(spark, sizes):
    words = [f"w{i}" for i in range(max(sizes) + 2)]
    rows = [(i, " ".join(words[: n + 2])) for i, n in enumerate(sizes)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard_components(docs).collect()}
    assert got == {i: min(g)[0] for i, (_, g) in enumerate(brute.components(rows))}


def test_empty_pieces_lose_no_link():
    """Two sets that agree on empty pieces only still share a key."""
    import numpy as np

    random = np.random.default_rng(5)
    for n in (10, 12, 20, 60):
        for _ in range(60):
            a = np.sort(random.integers(0, 1 << 64, n, dtype=np.uint64))
            b = np.sort(np.append(a[: n - n // 19], random.integers(0, 1 << 64, n // 19, dtype=np.uint64)))
            x, _ = ngram_join.sketch_keys(a, np.array([0, n]))
            y, _ = ngram_join.sketch_keys(b, np.array([0, len(b)]))
            assert len(np.intersect1d(x, y))


@pytest.mark.parametrize("percent", [60, 80, 90])
def test_linked_sets_share_a_key_at_every_size(percent):
    """Pairs as far apart as the similarity allows, of equal and of different sizes."""
    import numpy as np

    random = np.random.default_rng(percent)
    for n in [*range(1, 40), 75, 140, 700]:
        for _ in range(10):
            m = random.integers(-(-n * percent // 100), n + 1)
            differing = int((m + n) * (100 - percent) // (100 + percent))
            common = int((m + n - differing + 1) // 2)
            pool = random.integers(0, 1 << 64, m + n - common, dtype=np.uint64)
            a, b = np.sort(pool[:n]), np.sort(np.concatenate([pool[:common], pool[n:]]))
            assert 100 * common >= percent * len(pool)
            x, _ = ngram_join.sketch_keys(a, np.array([0, len(a)]), percent)
            y, _ = ngram_join.sketch_keys(b, np.array([0, len(b)]), percent)
            assert len(np.intersect1d(x, y))


def test_keys_stay_fewer_than_shingles():
    """Half a key for a shingle at 80 percent: no set needs its empty pieces."""
    import numpy as np

    random = np.random.default_rng(2)
    sizes = random.integers(30, 3000, 200)
    hashes = np.concatenate([np.sort(random.integers(0, 1 << 64, n, dtype=np.uint64)) for n in sizes])
    keys, _ = ngram_join.sketch_keys(hashes, np.concatenate([[0], np.cumsum(sizes)]), 80)
    assert len(keys) < 0.6 * len(hashes)


def test_a_common_phrase_makes_no_candidates():
    """Sets that have a few shingles in common agree on next to no piece: two of those would have to fall into one."""
    random = np.random.default_rng(5)
    common = random.integers(0, 1 << 64, 20, dtype=np.uint64)
    sizes = random.integers(1700, 2200, 400)
    hashes = np.concatenate([np.sort(np.append(random.integers(0, 1 << 64, n - 20, dtype=np.uint64), common)) for n in sizes])
    keys, _ = ngram_join.sketch_keys(hashes, np.concatenate([[0], np.cumsum(sizes)]), 80)
    _, held = np.unique(keys, return_counts=True)
    assert (held > 1).sum() < 10


@pytest.mark.parametrize("sizes", [(700, 800), (1500, 1540), (3000, 3700), (9000, 9000)])
def test_large_sets_are_told_apart_by_their_sketches(sizes):
    """Linked sets share a key and may link, also where one sketch is wider; sets that have half in common may not."""
    random = np.random.default_rng(sizes[0])
    n, m = sizes
    differing = (m + n) * 20 // 180
    for common, linked in (((m + n - differing + 1) // 2, True), (n // 2, False)):
        pool = random.integers(0, 1 << 64, m + n - common, dtype=np.uint64)
        a, b = np.sort(pool[:n]), np.sort(np.concatenate([pool[:common], pool[n:]]))
        first = np.array([0, n, n + m])
        x, y = (np.frombuffer(s, np.uint64) for s in ngram_join.wide_sketches(np.concatenate([a, b]), first, 80))
        assert ngram_join._may_link(n, m, x, y, 80) == linked
        assert ngram_join._may_link(m, n, y, x, 80) == linked
        if linked:
            assert len(np.intersect1d(*(ngram_join.sketch_keys(s, np.array([0, len(s)]), 80)[0] for s in (a, b))))


def test_long_documents_with_one_passage_need_no_sets(spark, monkeypatch):
    """Long documents that share a passage and nothing else are refused before their sets are fetched."""
    names, write = [], ngram_join.materialise
    monkeypatch.setattr(ngram_join, "materialise", lambda df, name: names.append(name) or write(df, name))
    passage = " ".join(f"s{i}" for i in range(300))
    rows = [(i, f"{passage} " + " ".join(f"o{i}_{j}" for j in range(3200 + i))) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.component_id for r in jaccard_components(docs, 5, 80).collect()}
    assert got == {i: i for i in range(12)}
    assert "stars" in names and "sets" not in names


def test_large_groups_meet_in_parts(spark, monkeypatch):
    """Documents that share a passage and link in far apart pairs, compared two by two parts of a group."""
    monkeypatch.setattr(ngram_join, "PART", 3)
    monkeypatch.setattr(ngram_join, "EARLIEST", 1)
    passage = " ".join(f"s{i}" for i in range(60))
    rows = [(i, f"{passage} " + " ".join(f"o{i % 8}_{j}" for j in range(20)) + f" end{i // 8 % 2}") for i in range(32)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.component_id for r in jaccard_components(docs).collect()}
    assert got == {i: min(g)[0] for i, (_, g) in enumerate(brute.components(rows))}
    assert set(got.values()) == set(range(8))


def test_one_document_of_each_group_stays(documents):
    got = one_of_each(documents, 3, 90)
    assert got.columns == documents.columns
    kept = [(of(r), r.text) for r in got.collect()]
    groups = brute.components(kept)
    assert all(size == 0 or len(group) == 1 for size, group in groups)
    every = {frozenset(g) for s, g in brute.components([(of(r), r.text) for r in documents.distinct().collect()]) if s}
    assert len(every) == sum(size > 0 for size, _ in groups)


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(30)] + [(50, 51)], "a long, b long")
    got = {r.node: r.component for r in components(edges).collect()}
    assert got == {**dict.fromkeys(range(31), 0), 50: 50, 51: 50}


def test_empty_tables(empty):
    assert dedup_substrings(empty).count() == 0
    assert dedup_lines(empty).count() == 0
    assert jaccard_components(empty).count() == 0
    assert one_of_each(empty).count() == 0
