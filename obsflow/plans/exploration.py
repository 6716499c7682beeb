"""Day, night and week statistics and the two-hour comparison, on tables and streams."""

from __future__ import annotations

from obsflow.functions.scalar import number
from obsflow.functions.time import DAY, WEEK
from obsflow.operators.filters import beyond, day_rows, night_rows
from obsflow.operators.scoring import range_compare, two_hour_rows
from obsflow.operators.windows import day_and_night, sliding_stats, window_stats
from obsflow.session import materialise
from obsflow.streaming import windows
from obsflow.streaming.sinks import for_each_batch, to_keyed_table
from obsflow.streaming.store import BatchStore, KeyedTable


def measured(observations):
    """Station, time and temperature as a number; rows without a readable time are dropped."""
    return observations.select("station", "valid", number("tmpf").alias("tmpf")).where("valid IS NOT NULL")


def weekly_day(observations, delay=None):
    """Weeks of day rows."""
    return _weekly(day_rows(observations), delay or windows.WEEKLY_DELAY)


def weekly_night(observations, delay=None):
    """Weeks of night rows."""
    return _weekly(night_rows(observations), delay or windows.SHORT_DELAY)


def _weekly(rows, delay):
    if rows.isStreaming:
        return windows.weekly(rows, delay=delay)
    return window_stats(rows, "valid", "tmpf", "station", WEEK)


def weekly_day_night(observations):
    """Both, told apart by a period column."""
    return day_and_night(weekly_day(observations), weekly_night(observations))


def sliding_week(observations, delay=windows.WEEKLY_DELAY):
    """Weeks that slide by a day; panes on a table, plain windows under a watermark on a stream."""
    if observations.isStreaming:
        return windows.weekly(observations, delay=delay, slide=DAY)
    return sliding_stats(observations, "valid", "tmpf", "station", WEEK, DAY)


def compare(observations, baselines):
    """Two-hour rows scored against the sliding weeks before them.

    Nothing here keeps state, so a stream of observations joins a static table
    of baselines row by row as it arrives.
    """
    return range_compare(two_hour_rows(observations), baselines)


def compare_anomalies(observations, baselines, threshold=2.0):
    """Compared rows with a finite score outside the threshold."""
    return beyond(compare(observations, baselines), threshold)


def compare_with_itself(observations):
    """A table against its own sliding weeks.

    The weeks are written first: the join is then planned on their real size,
    and the many two-hour rows shuffle only if the weeks are too big to broadcast.
    """
    return compare(observations, materialise(sliding_week(observations), "weeks"))


WEEK_KEYS = ("station", "window_start")


def run_baseline_stream(observations, weeks, checkpoint, seconds=10, delay=windows.WEEKLY_DELAY):
    """Keep the sliding weeks of a stream as a table by station and week.

    State holds the weeks that can still change, and a batch writes only the start days it
    has rows for. Rows more than ``delay`` behind the latest no longer change anything.
    """
    return to_keyed_table(
        sliding_week(observations, delay), weeks, checkpoint, WEEK_KEYS, "window_start", seconds
    )


def read_weeks(spark, weeks):
    """The table of sliding weeks; None before there is one."""
    return KeyedTable(spark, weeks, WEEK_KEYS, "window_start").read()


def run_compare_stream(observations, weeks, out, checkpoint, seconds=10, threshold=2.0):
    """Flag the rows of each batch against the table of baselines as it is then.

    Without a table the batch fails, so that a restart takes it again: no
    row passes by before there is something to compare it with.
    """

    def handle(batch, batch_id):
        spark = batch.sparkSession
        table = read_weeks(spark, weeks)
        if table is None:
            raise RuntimeError(f"no table of baselines in {weeks}; start the baselines job first")
        found = compare_anomalies(batch, table, threshold)
        BatchStore(spark, out).write(found, batch_id)

    return for_each_batch(observations, handle, checkpoint, seconds=seconds)
