"""The supervised job: score observations, train a classifier per batch, keep what it flags."""

from __future__ import annotations

from pyspark import StorageLevel

from obsflow.operators import svm
from obsflow.operators.clean import feature_engineering
from obsflow.operators.scoring import scored_observations
from obsflow.session import materialise
from obsflow.streaming import windows
from obsflow.streaming.sinks import for_each_batch
from obsflow.streaming.store import BatchStore


def detect(scored, store=None, batch_id=0, threshold=2.0):
    """Train and predict on one batch of scored rows; flagged rows go to the store once.

    ``threshold`` is the distance from the weekly mean, in deviations, that labels a row.

    Returns None when the batch is too small or has a single class.
    """
    found = svm.train_and_detect(scored, threshold=threshold)
    if found is not None and store is not None:
        store.write(found.predictions.where("prediction > 0"), batch_id)
    return found


def run_batch(observations, out=None, cold_start_origin=None):
    """The job over a whole table. Scores are written once, then read by each training pass."""
    clean = feature_engineering(observations)
    scored = materialise(scored_observations(clean, cold_start_origin), "scored")
    store = BatchStore(scored.sparkSession, out) if out else None
    return detect(scored, store)


def run_stream(observations, out, checkpoint, seconds=5, delay=windows.SHORT_DELAY):
    """The job over a stream of observations; flagged rows land in ``out``, a folder per batch."""
    scored = windows.scored(feature_engineering(observations), delay)

    def handle(batch, batch_id):
        # Several jobs read the batch; without this each would run the stream's plan again.
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            detect(batch, BatchStore(batch.sparkSession, out), batch_id)
        finally:
            batch.unpersist()

    return for_each_batch(scored, handle, checkpoint, seconds=seconds)
