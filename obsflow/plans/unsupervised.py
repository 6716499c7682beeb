"""The unsupervised job: flag points far from k-means centres that follow the stream."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Row
from pyspark.sql import functions as F

from obsflow.operators import kmeans
from obsflow.operators.clean import feature_engineering
from obsflow.operators.scoring import scored_observations
from obsflow.session import materialise
from obsflow.streaming import windows
from obsflow.streaming.sinks import for_each_batch
from obsflow.streaming.store import BatchStore


def save_centres(spark, store, centres, batch_id):
    """The model as a table of k rows."""
    rows = [Row(cluster=i, weight=float(w), point=[float(x) for x in p])
            for i, (p, w) in enumerate(zip(centres.points, centres.weights))]
    store.write(spark.createDataFrame(rows, "cluster int, weight double, point array<double>").coalesce(1), batch_id)


def load_centres(store, before=None):
    """The latest model, or the latest before a batch; None if there is none. It has k rows."""
    number = store.latest(before)
    if number is None:
        return None
    rows = store.read(number).orderBy("cluster").collect()
    return kmeans.Centres([list(r["point"]) for r in rows], [r["weight"] for r in rows])


def detect(scored, centres, threshold=kmeans.THRESHOLD):
    """Distinct feature points with their cluster, distance and flag."""
    return kmeans.distance_anomalies(kmeans.assign(kmeans.feature_rows(scored), centres), threshold)


def log_lines(flagged, columns=kmeans.FEATURES):
    """What the anomaly log keeps of each point."""
    return flagged.select("station", "valid", *columns, F.coalesce("anomaly", F.lit(False)).alias("prediction"))


def run_batch(observations, centres=None, decay=1.0, threshold=kmeans.THRESHOLD, cold_start_origin=None):
    """One pass over a whole table: the flagged points and the centres after it."""
    clean = feature_engineering(observations)
    scored = materialise(scored_observations(clean, cold_start_origin), "scored")
    centres = centres or kmeans.random_centres()
    flagged = detect(scored, centres, threshold)
    return flagged, kmeans.step(flagged, centres, decay)


def run_stream(
    observations,
    out,
    model,
    checkpoint,
    centres=None,
    decay=1.0,
    threshold=kmeans.THRESHOLD,
    seconds=5,
    delay=windows.SHORT_DELAY,
):
    """The job over a stream.

    Each batch is flagged with the centres the batches before it left, then
    moves them. Centres are stored by batch, so a repeated batch starts from
    the same centres and gives the same result.
    """
    scored = windows.scored(feature_engineering(observations), delay)
    first = centres or kmeans.random_centres()

    def handle(batch, batch_id):
        spark = batch.sparkSession
        log, models = BatchStore(spark, out, "csv"), BatchStore(spark, model)
        current = load_centres(models, batch_id) or first
        # The flags read the batch twice, the sinks read the flags twice: each is computed once.
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        flagged = detect(batch, current, threshold).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            log.write(log_lines(flagged), batch_id)
            save_centres(spark, models, kmeans.step(flagged, current, decay), batch_id)
        finally:
            flagged.unpersist()
            batch.unpersist()

    return for_each_batch(scored, handle, checkpoint, seconds=seconds)
