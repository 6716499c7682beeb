"""Unsupervised detection: distance from k-means centres that follow the stream."""

from __future__ import annotations

import random
from dataclasses import dataclass, field

from pyspark.sql import functions as F

from obsflow.functions.scalar import nearest, z_score

FEATURES = ["relh_avg", "vsby_avg", "z_score"]

# Number of centres, their first weight, the anomaly threshold,
# and the weight ratio below which a centre counts as dead.
CLUSTERS = 3
FIRST_WEIGHT = 100.0
THRESHOLD = 1.0
DEAD_RATIO = 1e-8
NUDGE = 1e-14


@dataclass
class Centres:
    """The model: k points and their weights. Its size depends on k alone."""

    points: list
    weights: list = field(default_factory=list)

    def __post_init__(self):
        if not self.weights:
            self.weights = [FIRST_WEIGHT] * len(self.points)


def random_centres(k=CLUSTERS, dimensions=len(FEATURES), weight=FIRST_WEIGHT, seed=0):
    """Centres drawn from a standard normal distribution."""
    draw = random.Random(seed)
    return Centres([[draw.gauss(0.0, 1.0) for _ in range(dimensions)] for _ in range(k)], [weight] * k)


def feature_rows(scored, columns=FEATURES):
    """Distinct feature points with their identity."""
    return scored.select("station", "valid", *columns).dropDuplicates()


def assign(df, centres, columns=FEATURES):
    """Nearest centre and the distance to it; the centres are constants in the plan."""
    best = nearest([F.col(c) for c in columns], centres.points)
    return df.withColumn("nearest", best).select(
        *df.columns, F.col("nearest.cluster").alias("cluster"), F.col("nearest.distance").alias("distance")
    )


def distance_stats(assigned):
    """One row: count, sum, mean and sample deviation of the distances."""
    return assigned.agg(
        F.count("distance").alias("n"),
        F.sum("distance").alias("total"),
        F.avg("distance").alias("mean"),
        F.stddev_samp("distance").alias("sd"),
    )


def distance_anomalies(assigned, threshold=THRESHOLD):
    """Flag rows whose distance lies above the batch mean by more than some deviations.

    One-sided and strict. The moments are one row, read as a scalar subquery;
    with fewer than two rows there is no deviation and the flag is null.
    """
    moments = distance_stats(assigned).select(F.struct("mean", "sd").alias("m")).scalar()
    z = z_score(F.col("distance"), moments["mean"], moments["sd"])
    return assigned.withColumn("distance_z", z).withColumn("anomaly", F.col("distance_z") > F.lit(float(threshold)))


def cluster_sums(assigned, columns=FEATURES):
    """Rows per cluster and the sum of each feature: at most k rows."""
    return (
        assigned.where(F.col("distance").isNotNull())
        .groupBy("cluster")
        .agg(F.count("*").alias("n"), *[F.sum(c).alias(c) for c in columns])
    )


def updated_centres(assigned, centres, decay=1.0, columns=FEATURES):
    """The moved centres as a table of k rows: old weight and position against the batch's own.

    A centre without rows keeps its place and its decayed weight.
    """
    k = assigned.sparkSession.range(len(centres.points)).select(F.col("id").cast("int").alias("cluster"))
    sums = k.join(cluster_sums(assigned, columns), "cluster", "left")
    old = {
        "weight": _by_cluster(centres.weights),
        **{c: _by_cluster([p[i] for p in centres.points]) for i, c in enumerate(columns)},
    }
    kept = old["weight"] * F.lit(float(decay))
    total = kept + F.coalesce("n", F.lit(0))
    return sums.select(
        "cluster",
        total.alias("weight"),
        *[F.when(F.col("n").isNull(), old[c]).otherwise((old[c] * kept + F.col(c)) / total).alias(c) for c in columns],
    )


def _by_cluster(values):
    return F.element_at(F.array(*[F.lit(float(v)) for v in values]), F.col("cluster") + 1)


def step(assigned, centres, decay=1.0, columns=FEATURES):
    """The model after one batch. Only k rows reach the driver.

    Centres without rows keep their place and decay; a batch without any row leaves
    the model as it was, so the pace of the triggers does not change it. A centre whose weight has
    all but vanished is revived beside the heaviest one, which shares its weight.
    """
    if not 0.0 <= decay <= 1.0:
        raise ValueError("the decay lies between 0 and 1")
    points = [list(p) for p in centres.points]
    weights = [w * decay for w in centres.weights]
    rows = updated_centres(assigned, centres, decay, columns).collect()
    if all(row["weight"] == weights[row["cluster"]] for row in rows):
        return centres
    for row in rows:
        points[row["cluster"]] = [row[c] for c in columns]
        weights[row["cluster"]] = row["weight"]
    heavy = max(range(len(weights)), key=weights.__getitem__)
    light = min(range(len(weights)), key=weights.__getitem__)
    if weights[light] < DEAD_RATIO * weights[heavy]:
        weights[heavy] = weights[light] = (weights[heavy] + weights[light]) / 2
        source = points[heavy]
        points[light] = [x - NUDGE * max(abs(x), 1.0) for x in source]
        points[heavy] = [x + NUDGE * max(abs(x), 1.0) for x in source]
    return Centres(points, weights)
