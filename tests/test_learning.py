import random

import pytest
from pyspark.sql import functions as F

from obsflow.operators import kmeans, scaling, svm
from obsflow.plans import supervised, unsupervised

SCORED = "station string, valid timestamp, temp double, relh_avg double, vsby_avg double, avg_temp double, stddev_temp double, z_score double"


def scored(spark, items):
    rows = [(f"s{i % 3}", i, *values) for i, values in enumerate(items)]
    df = spark.createDataFrame(rows, SCORED.replace("timestamp", "long"))
    return df.withColumn("valid", F.timestamp_seconds(F.col("valid") * 900))


def separable(n=400, seed=1):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        hot = rng.random() < 0.5
        temp = rng.uniform(0.5, 1.0) if hot else rng.uniform(-1.0, -0.5)
        out.append((temp, rng.random() * 0.1, rng.random() * 0.1, 0.0, 0.1, 3.0 if hot else 0.0))
    return out


def test_separable_classes_are_learnt(spark, tmp_path):
    df = scored(spark, separable())
    store = unsupervised.BatchStore(spark, str(tmp_path / "flagged"))
    found = supervised.detect(df, store, 7)
    assert found.auroc == 1.0 and len(found.weights) == 5 and found.weights[0] > 0
    test = found.predictions.collect()
    assert 100 < len(test) < 220 and all(r["prediction"] == r["label"] for r in test)
    saved = store.read()
    assert saved.count() == sum(r["prediction"] > 0 for r in test)
    assert {r["batch_id"] for r in saved.select("batch_id").distinct().collect()} == {7}


@pytest.mark.parametrize("items", [[], separable(4), [(0.5, 0.1, 0.1, 0.0, 0.1, 0.0)] * 20])
def test_small_and_single_class_batches_are_skipped(spark, items):
    assert svm.train_and_detect(scored(spark, items)) is None


def test_split_depends_on_the_key_only(spark):
    df = scored(spark, separable(300))
    one = svm.hash_split(df.repartition(1)).select("station", "valid", "is_train")
    many = svm.hash_split(df.repartition(7)).select("station", "valid", "is_train")
    assert one.exceptAll(many).count() == 0
    share = one.agg(F.avg(F.col("is_train").cast("int"))).first()[0]
    assert 0.5 < share < 0.7
    other = svm.hash_split(df, seed=12).select("station", "valid", "is_train")
    assert one.exceptAll(other).count() > 0


def test_gate_and_auroc(spark):
    df = svm.labelled(scored(spark, separable(50)))
    gate = svm.train_gate(df).first()
    assert gate["n_rows"] == 50 and gate["ready"] and 0 < gate["n_positive"] < 50
    rows = spark.createDataFrame([(1.0, 1.0), (1.0, 0.0), (0.0, 0.0), (0.0, 0.0), (0.0, 1.0), (0.0, 0.0)], "label double, prediction double")
    ours = svm.hard_auroc(rows).first()[0]
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    theirs = BinaryClassificationEvaluator(rawPredictionCol="prediction").evaluate(rows)
    assert ours == pytest.approx(theirs) == pytest.approx(0.625)


def test_step_by_hand(spark):
    centres = kmeans.Centres([[0.0, 0.0], [10.0, 0.0], [50.0, 50.0]], [1.0, 2.0, 4.0])
    df = spark.createDataFrame([(1.0, 1.0), (3.0, 1.0), (9.0, 0.0), (12.0, 2.0)], "x double, y double")
    assigned = kmeans.assign(df, centres, ["x", "y"])
    assert [r["cluster"] for r in assigned.collect()] == [0, 0, 1, 1]
    assert assigned.collect()[0]["distance"] == pytest.approx(2 ** 0.5)
    moved = kmeans.step(assigned, centres, 0.5, ["x", "y"])
    assert moved.weights == [2.5, 3.0, 2.0]
    assert moved.points[0] == pytest.approx([4.0 / 2.5, 2.0 / 2.5])
    assert moved.points[1] == pytest.approx([(10.0 + 21.0) / 3, 2.0 / 3])
    assert moved.points[2] == [50.0, 50.0]


def test_dead_centre_is_revived_beside_the_heaviest(spark):
    centres = kmeans.Centres([[0.0], [100.0]], [1e12, 1e-3])
    df = spark.createDataFrame([(1.0,)], "x double")
    moved = kmeans.step(kmeans.assign(df, centres, ["x"]), centres, 1.0, ["x"])
    assert moved.weights[0] == moved.weights[1] == pytest.approx(5e11)
    assert moved.points[0][0] == pytest.approx(moved.points[1][0])
    with pytest.raises(ValueError):
        kmeans.step(kmeans.assign(df, centres, ["x"]), centres, 5.0, ["x"])


def test_distance_anomalies_are_one_sided(spark):
    centres = kmeans.Centres([[0.0]])
    df = spark.createDataFrame([(x,) for x in (1.0, 1.0, 1.0, 1.0, 9.0)], "x double")
    flags = [r["anomaly"] for r in kmeans.distance_anomalies(kmeans.assign(df, centres, ["x"])).collect()]
    assert flags == [False] * 4 + [True]
    single = kmeans.distance_anomalies(kmeans.assign(df.limit(1), centres, ["x"])).first()
    assert single["anomaly"] is None and single["distance_z"] is None


def test_random_centres_are_reproducible():
    a, b = kmeans.random_centres(seed=4), kmeans.random_centres(seed=4)
    assert a == b and len(a.points) == 3 and a.weights == [100.0] * 3


def test_scaling_equals_the_fitted_scaler(spark):
    df = spark.createDataFrame([(float(i),) for i in (1, 4, 6, 10)], "x double")
    ours = [r["x_norm"] for r in scaling.standard_scale(df, "x").orderBy("x").collect()]
    model, assembled = scaling.fit_scaler(df, ["x"])
    theirs = [float(r["features_norm"][0]) for r in model.transform(assembled).orderBy("x").collect()]
    assert ours == pytest.approx(theirs)
    flat = spark.createDataFrame([(2.0,), (2.0,)], "x double")
    assert [r["x_norm"] for r in scaling.standard_scale(flat, "x").collect()] == [0.0, 0.0]


def test_centres_without_rows_keep_their_place(spark):
    points = spark.createDataFrame([("s", 1.0, 1.0, 1.0)], "station string, relh_avg double, vsby_avg double, z_score double")
    centres = kmeans.Centres([[0.0] * 3, [50.0] * 3, [99.0] * 3], [10.0, 20.0, 30.0])
    assigned = kmeans.assign(points, centres)
    got = {r.cluster: (r.weight, r.relh_avg) for r in kmeans.updated_centres(assigned, centres, 0.5).collect()}
    assert got == {0: (6.0, 1 / 6), 1: (10.0, 50.0), 2: (15.0, 99.0)}
    assert kmeans.step(assigned.limit(0), centres, 0.5) is centres
    assert kmeans.step(assigned, centres, 0.5).weights == [6.0, 10.0, 15.0]
