"""Short-term averages against the previous week, and the scores that follow."""

from __future__ import annotations

from pyspark.sql import functions as F

from obsflow.functions.scalar import z_score
from obsflow.functions.time import DAY, QUARTER_HOUR, TWO_HOURS, WEEK, day_number, shift
from obsflow.operators.filters import aligned, finite_only
from obsflow.operators.trailing import trailing_mean, trailing_mean_windows
from obsflow.operators.windows import sliding_stats, spread

# Fixed value: places the weekly mean and deviation are rounded to.
BASELINE_DIGITS = 4

MEASURES = ("tmpf", "relh", "vsby")

SCORED = [
    "station",
    "valid",
    "window_start",
    "temp",
    "prev_week_start",
    "prev_week_end",
    "baseline_start",
    "relh_avg",
    "vsby_avg",
    "avg_temp",
    "stddev_temp",
    "z_score",
]


def previous_week(df, ts="valid", cold_start_origin=None):
    """Bounds of the week an observation is compared with.

    With an origin, times in its first week look at the week that starts there,
    later rows included, so that setting is for batches only.
    """
    at = F.col(ts)
    start, end = shift(at, -WEEK), shift(at, -DAY)
    if cold_start_origin is not None:
        origin = F.lit(str(cold_start_origin)).cast("timestamp")
        start = F.when(at < shift(origin, WEEK), origin).otherwise(start)
        end = F.when(at < shift(origin, DAY), shift(at, -QUARTER_HOUR)).otherwise(end)
    return df.withColumns({"prev_week_start": start, "prev_week_end": end})


def short_term(df, ts="valid", keys="station", form="frames", cold_start_origin=None):
    """Two-hour trailing means at every quarter hour that has an observation.

    The alignment filter comes first: it decides which rows a frame holds.
    ``week_key`` names the baseline to compare with, by the day it ends on.
    """
    on_quarters = aligned(df, ts)
    if form == "frames":
        means = trailing_mean(on_quarters, ts, MEASURES, keys, bucket_column="week_key")
    else:
        means = trailing_mean_windows(on_quarters, ts, MEASURES, keys).withColumn("week_key", day_number(ts))
    out = previous_week(
        means.withColumnRenamed("tmpf_avg", "temp").withColumn("window_start", shift(F.col(ts), -TWO_HOURS)),
        ts,
        cold_start_origin,
    )
    if cold_start_origin is not None:
        out = out.withColumn("week_key", day_number("prev_week_start") + F.lit(WEEK // DAY))
    return out


def weekly_baseline(df, ts="valid", value="tmpf", keys="station", digits=BASELINE_DIGITS):
    """Mean and deviation of every seven-day window that starts on a day."""
    stats = sliding_stats(df, ts, value, keys, WEEK, DAY, digits)
    return stats.withColumnsRenamed({"window_start": "baseline_start", "window_end": "baseline_end"})


def score(short, baseline, keys=("station",)):
    """Join each average with the week starting on its previous-week date, and score it.

    Both sides are aggregates and the date is part of the key, so no station
    forms a product of its own rows and no key can be crowded. The key is the
    day the averages are already partitioned by; only the baseline moves.
    """
    right = baseline.withColumn("week_key", day_number("baseline_start") + F.lit(WEEK // DAY))
    joined = short.join(right, [*keys, "week_key"])
    z = z_score(F.col("temp"), F.col("avg_temp"), F.col("stddev_temp"))
    return joined.withColumn("z_score", z).select(*SCORED)


def scored_observations(df, cold_start_origin=None, digits=BASELINE_DIGITS, form="frames"):
    """Clean observations to finite z-scores, one per station and quarter hour."""
    short = short_term(df, form=form, cold_start_origin=cold_start_origin)
    return finite_only(score(short, weekly_baseline(df, digits=digits)))


def distinct_rows(df, columns=None):
    """Each row once; duplicates already collapse inside map tasks."""
    return df.dropDuplicates(columns) if columns else df.distinct()


def top_rows(df, order, n=10):
    """The first rows of a total order, kept as a bounded heap per task."""
    return df.orderBy(*order).limit(n)


def two_hour_rows(df, ts="valid", value="tmpf", keys=("station",)):
    """Each value once per two-hour window sliding by an hour, with its comparison dates."""
    rows = spread(df, ts, TWO_HOURS, 3600).where(F.col(value).isNotNull())
    return rows.select(
        *keys, "window_start", "window_end", F.col(value).alias("temperature"), *compare_dates("window_start")
    )


def compare_dates(start):
    """First and last date a comparison week may start on."""
    return [F.date_sub(start, 7).alias("prev_week_start"), F.date_sub(start, 1).alias("prev_week_end")]


def range_compare(rows, baselines, keys=("station",)):
    """Rows against every baseline starting between their comparison dates.

    The range always spans seven days, so each baseline is offered under the
    seven dates it can serve and the join is a plain equality. Only the small
    side is copied, and a crowded station and date is split by the join.
    """
    offered = baselines.select(
        *keys,
        F.col("window_start").alias("baseline_start"),
        F.col("window_end").alias("baseline_end"),
        "avg_temp",
        "stddev_temp",
        F.explode(
            F.sequence(F.date_add(F.to_date("window_start"), 1), F.date_add(F.to_date("window_start"), 7))
        ).alias("on_date"),
    )
    # A baseline starts at midnight, so its start lies in the range of dates
    # exactly when its date does.
    dated = rows.withColumn("on_date", F.date_add("prev_week_end", 1))
    z = z_score(F.col("temperature"), F.col("avg_temp"), F.col("stddev_temp"))
    return dated.join(offered, [*keys, "on_date"]).drop("on_date").withColumn("z_score", z)
