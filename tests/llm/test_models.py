"""Sharding, top-k search and the classifiers."""

import collections
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from obsflow.llm import quality, sharding, topk, toxicity
from obsflow.llm.labelled import held_out, labelled_sample
from obsflow.llm.quality import fit_quality, score_quality
from obsflow.llm.topk import top_k
from obsflow.llm.toxicity import fit_toxicity, score_toxicity


def preference(name, slots):
    at, skip = sharding._number(name, "offset") % slots, sharding._number(name, "skip") % (slots - 1) + 1
    return [(at + i * skip) % slots for i in range(slots)]


@pytest.mark.parametrize("n, slots", [(1, 2), (3, 7), (7, 97), (64, 1009)])
def test_table_is_filled_by_turns(n, slots):
    names = sharding.shard_names(n)
    walks, table, turn = [preference(s, slots) for s in names], {}, 0
    while len(table) < slots:
        table.setdefault(next(s for s in walks[turn % n] if s not in table), turn % n)
        turn += 1
    got = sharding.lookup_table(names, slots)
    assert got == [table[i] for i in range(slots)]
    counts = collections.Counter(got)
    assert max(counts.values()) - min(counts.values()) <= 1


def test_few_keys_move_when_a_shard_leaves():
    names = sharding.shard_names(10)
    before, after = sharding.lookup_table(names, 1009), sharding.lookup_table(names[:-1], 1009)
    moved = sum(a != b for a, b in zip(before, after) if a != 9)
    assert moved < 0.1 * 1009


def test_bad_tables_are_refused():
    for shards, slots in (([], 7), (["a", "a"], 7), (["a"], 8), (["a", "b", "c"], 2)):
        with pytest.raises(ValueError):
            sharding.lookup_table(shards, slots)


def test_place(documents, empty):
    got = sharding.place(documents.withColumn("_slot", F.lit("x")), "doc_id", 5, 101)
    assert got.columns == [*documents.columns, "_slot", "_shard"] and got.count() == documents.count()
    assert got.groupBy("doc_id").agg(F.countDistinct("_shard").alias("n")).where("n > 1").count() == 0
    assert got.where("_shard is null or _shard >= 5").count() == 0
    assert sharding.place(empty, "doc_id", 5, 101).count() == 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange hashpartitioning" not in plan


def best(vectors, queries, k):
    out = []
    for q, x in queries.items():
        ranked = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in vectors if i != q)
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(ranked[:k])]
    return out


@pytest.mark.parametrize("k, block", [(1, 8192), (5, 100), (2000, 300)])
def test_top_k_equals_brute_force(spark, monkeypatch, k, block):
    monkeypatch.setattr(topk, "PAGE", 16)
    r = random.Random(4)
    vectors = [(i, [r.gauss(0, 1) * (1 + i % 7) for _ in range(6)]) for i in range(900)]
    vectors += [(900 + i, vectors[3][1]) for i in range(60)] + [(960 + i, [0.0] * 6) for i in range(5)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>").repartition(3)
    held = [(v.vec_id, [int(np.floor(256 * x)) for x in v.embedding]) for v in df.collect()]
    asked = {i: v for i, v in held if i % 120 == 3 or i == 961}
    got = top_k(df, df.where("vec_id % 120 = 3 or vec_id = 961"), k, block=block).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == sorted(best(held, asked, k))


def test_vectors_that_take_no_part(spark):
    rows = [(0, [1.0, 2.0], "x"), (1, None, "x"), (2, [], "x"), (3, [1.0, None], "x"), (4, [float("nan"), 1.0], "x")]
    rows += [(5, [float("inf"), 1.0], "x"), (6, [3.0], "x"), (None, [9.0, 9.0], "x"), (7, [-1.0, 1.0, 5.0], "x"), (0, [1.0, 2.0], "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string")
    got = sorted(tuple(r) for r in top_k(df, df, 3).collect())
    held = [(0, [256, 512]), (6, [768]), (7, [-256, 256, 1280]), (0, [256, 512])]
    assert got == sorted(best(held, dict(held), 3))
    assert top_k(df.limit(0), df, 3).count() == 0 and top_k(df, df.limit(0), 3).count() == 0


@pytest.mark.parametrize("repeats", [3, 9])
def test_rows_of_the_query_take_no_place_of_others(spark, repeats):
    rows = [(0, [10.0, 1.0])] * repeats + [(i, [10.0 - i / 8, 1.0]) for i in range(1, 40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").coalesce(1)
    held = [(i, [int(256 * x) for x in v]) for i, v in rows]
    got = sorted(tuple(r) for r in top_k(df, df.where("vec_id = 0"), 3).collect())
    assert got == sorted(best(held, {0: held[0][1]}, 3)) and len(got) == 3


def test_large_components_stay_exact(spark):
    big = [(0, [2.0**22, 1.0]), (1, [2.0**22, 2.0]), (2, [2.0**22, 3.0])]
    df = spark.createDataFrame(big, "vec_id long, embedding array<double>")
    held = [(i, [int(256 * x) for x in v]) for i, v in big]
    assert sorted(tuple(r) for r in top_k(df, df, 2).collect()) == sorted(best(held, dict(held), 2))


def labelled(spark, n=240):
    r = random.Random(9)
    words = ["".join(r.choice("abcdefghij") for _ in range(r.randint(2, 7))) for _ in range(300)]
    docs, labels = [], []
    for i in range(n):
        own = [r.choice(words) for _ in range(r.randint(20, 80))]
        good, toxic = i % 3 > 0, i % 4 == 0
        if not good:
            own = [w.upper() + "!!" for w in own]
        if toxic:
            own[:: 9] = [r.choice(["nastyzzz", "vilezzz"]) for _ in own[::9]]
        docs.append((i, " ".join(own)))
        labels.append((i, int(good), int(toxic)))
    labels += [(0, None, None), (None, 1, 1), (5, int(5 % 3 > 0), int(5 % 4 == 0))]
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_sample_holds_one_row_of_each_id(spark):
    rows = [(i, f"text {i}") for i in range(20)] + [(3, f"more {j}") for j in range(50)] + [(4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, toxic int")
    got = [
        labelled_sample(d, labels, "toxic", lambda c: F.lit(False), 8, worst=1).collect()
        for d in (docs.coalesce(1), docs.repartition(5), docs.where("doc_id = 3 or doc_id < 3"))
    ]
    assert collections.Counter(r.label for r in got[0]) == {0: 8, 1: 8}
    assert len({r.doc_id for r in got[0]}) == 16 and sorted(got[0]) == sorted(got[1])
    own = labelled_sample(docs, labels, "toxic", lambda c: F.lit(False), 20, worst=1).where("doc_id = 3").collect()
    assert len(own) == 1 and (3, own[0].text) in rows
    assert {r.doc_id for r in got[2]} <= {0, 1, 2, 3} and len({r.doc_id for r in got[2]}) == len(got[2])


def accuracy(scored, labels, label, out):
    rows = scored.join(labels.dropna().distinct(), "doc_id").where(out(F.col("doc_id"))).select("_predicted", label).collect()
    assert len(rows) > 20
    return sum(r[0] == r[1] for r in rows) / len(rows)


def test_quality_on_held_out_documents(spark, documents, empty):
    docs, labels = labelled(spark)
    model = fit_quality(docs, labels)
    assert accuracy(score_quality(docs, model), labels, "quality", lambda c: held_out(c, 5, 0)) > 0.9
    messy = score_quality(documents.withColumn("_score", F.lit("x")), model)
    assert messy.columns == [*documents.columns, "_score", "_predicted"] and messy.count() == documents.count()
    assert messy.where("_score between 0 and 1").count() == documents.count()
    assert score_quality(empty, model).count() == 0
    assert fit_quality(docs, labels.where("false")) is None
    assert score_quality(docs, None).where("_predicted = 1").count() == docs.count()


def test_word_vectors_cover_all_documents_in_any_order(spark, documents):
    a, b = quality.word_vectors(documents), quality.word_vectors(documents.repartition(7))
    assert all(np.array_equal(x, y) for x, y in zip(a, b))
    assert (np.linalg.norm(a[0], axis=1) > 0.9).sum() > 300


def test_scores_ignore_other_columns_and_partitions(spark):
    docs, labels = labelled(spark)
    for fit, score in ((fit_quality, score_quality), (fit_toxicity, score_toxicity)):
        model = fit(docs, labels)
        a = {r.doc_id: r._score for r in score(docs, model).collect()}
        b = {r.doc_id - 1000: r._score for r in score(docs.withColumn("doc_id", F.col("doc_id") + 1000).repartition(5), model).collect()}
        assert a == b


def test_toxicity_on_held_out_documents(spark, documents, empty):
    docs, labels = labelled(spark)
    model = fit_toxicity(docs, labels)
    assert accuracy(score_toxicity(docs, model, 0.5), labels, "toxic", lambda c: held_out(c, 3, 1)) > 0.9
    messy = score_toxicity(documents, model)
    assert messy.columns == [*documents.columns, "_score", "_predicted"] and messy.count() == documents.count()
    assert messy.where("_score between 0 and 1").count() == documents.count()
    assert score_toxicity(empty, model).count() == 0
    assert fit_toxicity(docs, labels.where("false")) is None
    assert score_toxicity(docs, None).where("_predicted = 0").count() == docs.count()


def test_penalty_keeps_group_names_from_counting(spark):
    """Toxic examples that name one group: without the penalty its name counts against neutral texts."""
    r = random.Random(6)
    words = ["".join(r.choice("abcdefghij") for _ in range(5)) for _ in range(200)]
    rows = []
    for i in range(300):
        own = [r.choice(words) for _ in range(15)]
        if i % 3 == 0:
            own.insert(3, "refugees")
            if r.random() < 0.6:
                own.insert(7, "nastyzzz")
        rows.append((i, " ".join(own), int(i % 3 == 0)))
    docs = spark.createDataFrame([x[:2] for x in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(x[0], x[2]) for x in rows], "doc_id long, toxic int")
    neutral = spark.createDataFrame([(1, "refugees " + " ".join(words[:12]))], "doc_id long, text string")
    scores = [score_toxicity(neutral, fit_toxicity(docs, labels, penalty=p)).first()._score for p in (0.0, 5.0)]
    assert scores[1] < 0.5 < scores[0]


def test_counterfactuals():
    random_ = np.random.default_rng(1)
    terms = ("women", "men", "juifs")
    swapped = toxicity.counterfactual("Women and men, mention", terms, random_)
    first, second = swapped.split(",")[0].split(" and ")
    assert first != "Women" and first[0].isupper() and second != "men" and swapped.endswith(", mention")
    assert toxicity.counterfactual("nothing here", terms, random_).rsplit(" ", 1)[1] in terms


def test_held_out_ids(spark):
    import zlib

    df = spark.createDataFrame([(i,) for i in (0, 7, 12345, None)], "doc_id long")
    got = [r[0] for r in df.select(held_out(F.col("doc_id"), 5, 0)).collect()]
    assert got == [zlib.crc32(str(i).encode() if i is not None else b"") % 5 == 0 for i in (0, 7, 12345, None)]
