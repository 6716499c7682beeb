"""Windows, joins and distinct rows on streams.

State is bounded by the watermark: a window leaves the state once the
watermark passes its end, and joins keep each side for about a window.

Overlapping windows are built from panes: a first aggregation reduces rows to one
partial result per key and pane, and a second one, over the closed panes,
makes the windows. A row thus updates one state row and not one per window. A
row that comes after its pane is closed is late for all of its windows.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from obsflow.functions.scalar import is_finite, outside, steady_round, z_score
from obsflow.functions.time import DAY, QUARTER_HOUR, TWO_HOURS, WEEK, day_number, interval_text, shift
from obsflow.operators.filters import aligned, finite_only
from obsflow.operators.scoring import BASELINE_DIGITS, MEASURES, SCORED, compare_dates, previous_week
from obsflow.operators.windows import (
    lists_of_counts,
    merge_all,
    moments_result,
    pane_moments,
    same_keys,
    window_stats,
)
from obsflow.streaming.sinks import for_each_batch
from obsflow.streaming.store import BatchStore

WEEKLY_DELAY = "7 days"
SHORT_DELAY = "15 minutes"
#: Parts that the rows of one window are dealt to where they meet its statistics.
SALTS = 16


def weekly(df, ts="valid", value="tmpf", keys=("station",), delay=WEEKLY_DELAY, slide=None):
    """Mean and deviation of tumbling or sliding weeks, final once the watermark passes."""
    return window_stats(df.withWatermark(ts, delay), ts, value, keys, WEEK, slide)


def short_term(df, ts="valid", keys=("station",), delay=SHORT_DELAY):
    """Two-hour trailing means at quarter hours, with one event-time column ``short_time``.

    Frames over ordered rows do not exist on streams, so each frame is a window
    of panes that ends one grid step after its time, and counts where a pane is its last.
    """
    marked = aligned(df, ts).withWatermark(ts, delay)
    parts = [x for c in MEASURES for x in (F.sum(c).alias(f"{c}_sum"), F.count(c).alias(f"{c}_n"))]
    panes = marked.groupBy(*keys, F.window(ts, interval_text(QUARTER_HOUR)).alias("pane")).agg(*parts)
    panes = panes.withColumn("pane_time", F.window_time("pane"))
    frame = F.window("pane_time", interval_text(TWO_HOURS + QUARTER_HOUR), interval_text(QUARTER_HOUR))
    means = [
        F.coalesce(F.sum(f"{c}_sum") / F.nullif(F.sum(f"{c}_n"), F.lit(0)), F.lit(0.0)).alias(f"{c}_avg") for c in MEASURES
    ]
    frames = panes.groupBy(*keys, frame).agg(F.max("pane.start").alias("latest"), *means)
    frames = frames.where(F.col("latest") == shift(F.col("window.end"), -QUARTER_HOUR))
    return previous_week(
        frames.select(
            *keys,
            F.col("latest").alias(ts),
            F.window_time("window").alias("short_time"),
            shift(F.col("latest"), -TWO_HOURS).alias("window_start"),
            F.col("tmpf_avg").alias("temp"),
            "relh_avg",
            "vsby_avg",
        ),
        ts,
    )


def baseline(df, ts="valid", value="tmpf", keys=("station",), delay=SHORT_DELAY, digits=BASELINE_DIGITS):
    """Sliding weeks of day panes, with one event-time column ``week_time``."""
    marked = df.withWatermark(ts, delay)
    panes = marked.groupBy(*keys, F.window(ts, interval_text(DAY)).alias("pane")).agg(pane_moments(value).alias("moments"))
    panes = panes.withColumn("pane_time", F.window_time("pane"))
    days = F.sort_array(F.collect_list(F.struct("pane_time", "moments")))
    weeks = panes.groupBy(*keys, F.window("pane_time", interval_text(WEEK), interval_text(DAY))).agg(days.alias("days"))
    total = weeks.withColumn("t", merge_all("days", "moments"))
    mean, deviation = moments_result("t.n", "t.mean", "t.m2", "t.lo", "t.hi")
    if digits is not None:
        mean, deviation = steady_round(mean, digits), steady_round(deviation, digits)
    return total.select(
        *keys,
        F.window_time("window").alias("week_time"),
        F.col("window.start").alias("baseline_start"),
        mean.alias("avg_temp"),
        deviation.alias("stddev_temp"),
    )


def scored(df, delay=SHORT_DELAY, digits=BASELINE_DIGITS):
    """Finite z-scores on a stream: each average against the week that ended the day it lies on.

    The day is part of the key, so a station's averages spread over tasks by day.
    ``week_time`` is the week's end and ``short_time`` a grid step after the
    observation, both less a microsecond, hence the bounds, which let state expire.
    """
    left = short_term(df, delay=delay).withColumn("day", day_number("valid")).alias("short")
    right = baseline(df, delay=delay, digits=digits)
    right = right.withColumn("day", day_number("baseline_start") + F.lit(WEEK // DAY)).alias("week")
    first = F.col("week_time") + F.expr(f"INTERVAL {QUARTER_HOUR} SECONDS")
    beyond = F.col("week_time") + F.expr(f"INTERVAL {DAY + QUARTER_HOUR} SECONDS")
    joined = left.join(
        right,
        (F.col("short.station") == F.col("week.station"))
        & (F.col("short.day") == F.col("week.day"))
        & (F.col("short_time") >= first)
        & (F.col("short_time") < beyond),
    )
    z = z_score(F.col("temp"), F.col("avg_temp"), F.col("stddev_temp"))
    columns = [F.col("short.station") if c == "station" else F.col(c) for c in SCORED if c != "z_score"]
    return finite_only(joined.select(*columns, z.alias("z_score")))


def with_window_stats(df, ts, columns, keys=(), seconds=10, delay=SHORT_DELAY, digits=None, salts=SALTS):
    """Rows with the mean and deviation of their own tumbling window, once the window is closed.

    A stream joined with its own aggregate. Both sides are bounded: a row waits until
    the watermark passes the end of its window, and the statistics leave with it. Rows of a
    window are dealt to ``salts`` parts, to each of which its one row of statistics is copied,
    so a crowded window is the state of many tasks. A null key is a group of its own; a row
    without a time is in no window and is left out.
    """
    keys, window = list(keys), F.window(ts, interval_text(seconds))
    marked = df.withWatermark(ts, delay)
    aggregates = []
    for c in columns:
        mean, deviation = F.avg(c), F.stddev_samp(c)
        if digits is not None:
            mean, deviation = steady_round(mean, digits), steady_round(deviation, digits)
        aggregates += [mean.alias(f"{c}_mean"), deviation.alias(f"{c}_stddev")]
    stats = marked.groupBy(*keys, window).agg(*aggregates).select(
        *keys,
        F.window_time("window").alias("closed"),
        F.col("window.start").alias("window_start"),
        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"),
        *[f"{c}_{x}" for c in columns for x in ("mean", "stddev")],
    )
    part = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(salts)).cast("int")
    rows = marked.withColumns({"window_start": window["start"], "salt": part})
    at = F.col(f"r.`{ts}`")
    joined = rows.alias("r").join(
        stats.alias("s"),
        same_keys("r", "s", [*keys, "window_start", "salt"])
        & (at <= F.col("closed"))
        & (at > F.col("closed") - F.expr(f"INTERVAL {int(seconds)} SECONDS")),
    )
    added = [F.col(f"s.{c}_{x}") for c in columns for x in ("mean", "stddev")]
    return joined.select("r.window_start", *[F.col(f"r.`{c}`") for c in df.columns], *added)


def window_outliers(df, ts, value, seconds=10, threshold=1.0, digits=4, delay=SHORT_DELAY):
    """Rows further than some deviations from the mean of their own closed window."""
    rows = df.select(F.col(ts).alias("ts"), F.col(value).alias("value"))
    found = with_window_stats(rows, "ts", ["value"], (), seconds, delay, digits)
    z = z_score(F.col("value"), F.col("value_mean"), F.col("value_stddev"))
    return found.withColumn("z_score", z).where(is_finite(F.col("z_score")) & outside(F.col("z_score"), threshold)).select(
        "window_start", F.col("value_mean").alias("avg"), F.col("value_stddev").alias("standard_dev"), "value", "z_score"
    )


def standardise(df, ts, columns, keys=(), seconds=10, delay=SHORT_DELAY):
    """Columns as z-scores within their own closed window; null where the deviation is zero or missing."""
    joined = with_window_stats(df, ts, columns, keys, seconds, delay)
    scores = {f"{c}_norm": z_score(F.col(c), F.col(f"{c}_mean"), F.col(f"{c}_stddev")) for c in columns}
    return joined.withColumns(scores).drop(*[f"{c}_{x}" for c in columns for x in ("mean", "stddev")])


def value_counts(df, ts="valid", value="tmpf", keys=("station",), seconds=TWO_HOURS, slide=3600, delay=SHORT_DELAY):
    """How often each value occurs in each closed window: a list as a multiset.

    State holds a row per window and distinct value, however often the value occurs. Null
    values are counted too, so a window without others is known.
    """
    window = F.window(ts, interval_text(seconds), interval_text(slide))
    counts = df.withWatermark(ts, delay).groupBy(*keys, window, F.col(value).alias("value")).agg(F.count("*").alias("n"))
    return counts.select(
        *keys, F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "value", "n"
    )


def two_hour_rows(df, ts="valid", value="tmpf", keys=("station",), delay=SHORT_DELAY):
    """Each value once per closed two-hour window, with its comparison dates: the multisets expanded."""
    counts = value_counts(df, ts, value, keys, delay=delay).where("value IS NOT NULL")
    rows = counts.withColumn("temperature", F.explode(F.array_repeat("value", F.col("n").cast("int"))))
    return rows.select(*keys, "window_start", "window_end", "temperature", *compare_dates("window_start"))


def to_lists(counts, path, checkpoint, group, page_rows, seconds=None):
    """Write the sorted lists of closed windows, in pages, a folder per batch."""

    def handle(batch, batch_id):
        BatchStore(batch.sparkSession, path).write(lists_of_counts(batch, group, page_rows), batch_id)

    return for_each_batch(counts, handle, checkpoint, seconds=seconds)


def distinct(df, ts, columns=None, delay=SHORT_DELAY):
    """Each row once, as long as its repeats come within the watermark's delay of it.

    State holds a key only until the watermark passes its time by that delay.
    """
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark(columns or df.columns)
