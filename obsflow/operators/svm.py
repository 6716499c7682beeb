"""Supervised detection: a linear support vector machine on scored observations.

It is trained by subgradient descent over whole batches: a round is one aggregation
of the rows inside the margin, with the weights as constants of the plan, so nothing
is drawn at random and only as many numbers as there are features reach the driver.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from obsflow.functions.scalar import anomaly_label, dot, hash_share
from obsflow.session import fixed_plans, materialise

FEATURES = ["temp", "relh_avg", "vsby_avg", "avg_temp", "stddev_temp"]
SPLIT_KEYS = ("station", "valid")

# Share of training rows, its seed, the rows a batch must exceed,
# and the training settings: rounds, regularisation, first step and the relative
# change of the weights that ends the training.
TRAIN_SHARE = 0.6
SPLIT_SEED = 11
MIN_ROWS = 4
ITERATIONS = 100
REGULARISATION = 0.1
STEP = 1.0
TOLERANCE = 0.001
#: Training rows that one task passes over in a round.
TASK_ROWS = 200_000


def labelled(scored, threshold=2.0):
    """Label each scored row; the score itself is no feature."""
    return scored.withColumn("label", anomaly_label(F.col("z_score"), threshold))


def features(df, columns=FEATURES):
    """The feature columns as one vector; rows missing one are skipped."""
    return VectorAssembler(inputCols=list(columns), outputCol="features", handleInvalid="skip").transform(df)


def hash_split(df, keys=SPLIT_KEYS, share=TRAIN_SHARE, seed=SPLIT_SEED):
    """Mark training rows by a hash of their key: the same split on every run and retry."""
    texts = [F.date_format(k, "yyyy-MM-dd HH:mm:ss") if dict(df.dtypes)[k].startswith("timestamp") else F.col(k)
             for k in keys]
    return df.withColumn("is_train", hash_share(texts, seed) < F.lit(share))


def train_gate(df, min_rows=MIN_ROWS):
    """One row: how many rows and labels there are, and whether training may start."""
    counts = df.agg(F.count("*").alias("n_rows"), F.coalesce(F.sum("label"), F.lit(0.0)).alias("n_positive"))
    return counts.withColumn("ready", _ready("n_rows", "n_positive", min_rows))


def split_gate(df, min_rows=MIN_ROWS):
    """One row: whether the batch is large enough and its training part has both classes.

    Both questions are answered by one pass.
    """
    train = F.col("is_train")
    counts = df.agg(
        F.count("*").alias("n_rows"),
        F.count_if(train).alias("n_train"),
        F.coalesce(F.sum(F.when(train, F.col("label"))), F.lit(0.0)).alias("n_positive"),
    )
    return counts.withColumn("ready", (F.col("n_rows") > min_rows) & _ready("n_train", "n_positive", 0))


def _ready(rows, positive, min_rows):
    return (F.col(rows) > min_rows) & (F.col(positive) > 0) & (F.col(positive) < F.col(rows))


def subgradient(points, weights, columns=FEATURES):
    """One row: the sum of label times feature over the rows inside the margin.

    ``points`` has the columns and ``sign``, 1 or -1. The expressions are text, which costs a
    tenth of building them call by call in each round.
    """
    margin = " + ".join(f"`{c}` * ({float(w)!r}D)" for c, w in zip(columns, weights))
    inside = points.where(f"sign * ({margin}) < 1D")
    return inside.selectExpr(*[f"coalesce(sum(sign * `{c}`), 0D) AS `{c}`" for c in columns])


def moved(weights, pulls, n, number, regularisation=REGULARISATION, step=STEP):
    """The weights after round ``number``: shrunk, and pulled by the mean of the rows inside the margin."""
    pace = step / math.sqrt(number)
    return [w * (1.0 - pace * regularisation) + pace * (g / n) for w, g in zip(weights, pulls)]


def settled(before, after, tolerance=TOLERANCE):
    """Whether a round hardly changed the weights."""
    return math.dist(before, after) < tolerance * max(math.hypot(*after), 1.0)


def fit(points, columns=FEATURES, iterations=ITERATIONS, regularisation=REGULARISATION, step=STEP, tolerance=TOLERANCE):
    """Weights without intercept on the raw feature scale, by subgradient descent with a step of ``step / sqrt(round)``.

    ``points`` is read once a round, so it should be persisted. Ends after ``iterations`` rounds,
    or when a round after the first changes the weights by less than ``tolerance`` of their length.
    """
    weights, n = [0.0] * len(columns), points.count()
    for number in range(1, iterations + 1):
        pulls = subgradient(points, weights, columns).collect()[0]
        before, weights = weights, moved(weights, pulls, n, number, regularisation, step)
        if number > 1 and settled(before, weights, tolerance):
            break
    return weights


def linear_score(df, weights, columns=FEATURES, threshold=0.0):
    """Score and prediction for given weights, as plain column arithmetic."""
    return df.withColumn("score", dot([F.col(c) for c in columns], weights)).withColumn(
        "prediction", F.when(F.col("score") > threshold, F.lit(1.0)).otherwise(F.lit(0.0))
    )


def hard_auroc(df, prediction="prediction", label="label"):
    """Area under the ROC curve of 0/1 predictions: the mean of both classes' hit rates.

    One aggregation; null where a class is absent.
    """
    hit = (F.col(prediction) == F.col(label)).cast("double")
    positive, negative = (F.avg(F.when(F.col(label) == v, hit)) for v in (1.0, 0.0))
    return df.agg(((positive + negative) / F.lit(2.0)).alias("auroc"))


@dataclass
class Detection:
    """What one batch gave: the test rows with predictions, the weights and the AUROC."""

    predictions: object
    weights: list
    auroc: float | None


def train_and_detect(scored, min_rows=MIN_ROWS, share=TRAIN_SHARE, seed=SPLIT_SEED, threshold=2.0):
    """Split, train on one part and predict the other; None where training cannot start.

    Training passes over its rows once per round, so they are written and persisted, in as
    many parts as their number asks for. Rows that miss a feature are skipped.
    """
    rows = hash_split(labelled(scored, threshold), share=share, seed=seed).dropna(subset=FEATURES)
    gate = split_gate(rows, min_rows).first()
    if not gate["ready"]:
        return None
    train = rows.where("is_train").select((F.col("label") * 2 - 1).alias("sign"), *FEATURES)
    # Written first: a round then plans a scan of the cached table and not the whole way there.
    points = materialise(train.coalesce(max(1, math.ceil(gate["n_train"] / TASK_ROWS))), "points")
    points = points.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        with fixed_plans(points.sparkSession):
            weights = fit(points)
    finally:
        points.unpersist()
    # The prediction is arithmetic on the row, so it needs no model object.
    predictions = linear_score(rows.where("NOT is_train"), weights)
    return Detection(predictions, weights, hard_auroc(predictions).first()["auroc"])
