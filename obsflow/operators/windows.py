"""Event-time windows: counts, means, deviations and value lists.

Aggregates combine inside map tasks before they shuffle, so a key or window
that holds most of the rows costs one partial row per task, not one huge group.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from obsflow.functions.scalar import is_finite, outside, steady_round, z_score
from obsflow.functions.time import DAY, WEEK, epoch, interval_text
from obsflow.session import materialise

LIST_PAGE = 100_000
#: Value ranges that the ranks of a window of several pages are counted in.
RANGES = 256


def spread(df, ts, seconds, slide=None):
    """Every row once per window that holds it, with the window's start and end.

    No shuffle. Collecting the values of sliding windows into lists and
    exploding them again yields these same rows.
    """
    window = F.window(ts, interval_text(seconds), interval_text(slide or seconds))
    return df.withColumn("window", window).select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *[c for c in df.columns],
    )


def _bounds(df, rest):
    return df.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *rest
    )


def count_by(df, column, ordered=True):
    """Rows per value."""
    counts = df.groupBy(column).agg(F.count("*").alias("count"))
    return counts.orderBy(column) if ordered else counts


def window_count(df, ts, keys, seconds=10):
    """Rows per tumbling window and key."""
    keys = _names(keys)
    grouped = df.groupBy(F.window(ts, interval_text(seconds)), *keys).agg(F.count("*").alias("count"))
    return _bounds(grouped, [*keys, "count"])


def window_mean(df, ts, value, seconds=10):
    """Mean per tumbling window."""
    grouped = df.groupBy(F.window(ts, interval_text(seconds))).agg(F.avg(value).alias("moving_average"))
    return _bounds(grouped, ["moving_average"])


def window_stats(df, ts, value, keys=(), seconds=WEEK, slide=None, digits=None, names=("avg_temp", "stddev_temp")):
    """Mean and sample deviation per window in one aggregation; works on streams too."""
    keys = _names(keys)
    window = F.window(ts, interval_text(seconds), interval_text(slide or seconds))
    mean, deviation = F.avg(value), F.stddev_samp(value)
    if digits is not None:
        mean, deviation = steady_round(mean, digits), steady_round(deviation, digits)
    grouped = df.groupBy(*keys, window).agg(mean.alias(names[0]), deviation.alias(names[1]))
    return _bounds(grouped, [*keys, *names])


def pane_moments(value):
    """Count, mean, squared deviations and range of one pane, as one struct."""
    n = F.count(value).cast("double")
    return F.struct(
        n.alias("n"),
        F.avg(value).alias("mean"),
        (F.var_pop(value) * n).alias("m2"),
        F.min(value).alias("lo"),
        F.max(value).alias("hi"),
    )


def merge_moments(a, b):
    """Moments (count, mean, squared deviations, range) of two parts together."""
    n = a["n"] + b["n"]
    delta = b["mean"] - a["mean"]
    both = F.struct(
        n.alias("n"),
        (a["mean"] + delta * b["n"] / n).alias("mean"),
        (a["m2"] + b["m2"] + delta * delta * a["n"] * b["n"] / n).alias("m2"),
        F.least(a["lo"], b["lo"]).alias("lo"),
        F.greatest(a["hi"], b["hi"]).alias("hi"),
    )
    return F.when(b["n"] == 0, a).when(a["n"] == 0, b).otherwise(both)


def merge_all(parts, field=None):
    """Moments of all elements of an array, or of one field of each, folded once."""
    empty = F.struct(F.lit(0.0).alias("n"), *[F.lit(None).cast("double").alias(c) for c in ("mean", "m2", "lo", "hi")])
    return F.aggregate(parts, empty, lambda a, p: merge_moments(a, p[field] if field else p))


def sliding_stats(df, ts, value, keys=(), seconds=WEEK, slide=DAY, digits=None, names=("avg_temp", "stddev_temp")):
    """Mean and sample deviation of overlapping windows, built from panes.

    A row of a 7-day window sliding by a day belongs to seven windows. Instead
    of copying rows seven times, rows are first reduced to one partial result
    per key and slide (a pane); only panes are copied to their windows, and a
    window then merges at most ``seconds / slide`` of them.
    """
    if seconds % slide:
        raise ValueError("the slide must divide the window")
    keys = _names(keys)
    panes = (
        df.groupBy(*keys, F.window(ts, interval_text(slide)).alias("pane"))
        .agg(pane_moments(value).alias("moments"))
        .withColumn("pane_start", F.unix_seconds("pane.start"))
    )
    windows = panes.select(
        *keys,
        "pane_start",
        "moments",
        F.explode(F.sequence(F.col("pane_start") - F.lit(seconds - slide), F.col("pane_start"), F.lit(slide))).alias(
            "start"
        ),
    )
    parts = windows.groupBy(*keys, "start").agg(
        F.sort_array(F.collect_list(F.struct("pane_start", "moments"))).alias("parts")
    )
    total = parts.select(
        *keys,
        F.timestamp_seconds("start").alias("window_start"),
        F.timestamp_seconds(F.col("start") + F.lit(seconds)).alias("window_end"),
        merge_all("parts", "moments").alias("t"),
    )
    mean, deviation = moments_result("t.n", "t.mean", "t.m2", "t.lo", "t.hi")
    if digits is not None:
        mean, deviation = steady_round(mean, digits), steady_round(deviation, digits)
    return total.select(
        "window_start", "window_end", *keys, mean.alias(names[0]), deviation.alias(names[1])
    )


def moments_result(n, mean, m2, lo, hi):
    """Mean and sample deviation from merged moments.

    Equal values have exactly that mean and deviation zero, whatever rounding
    the merging left behind; fewer than two values have no deviation.
    """
    n, mean, m2, lo, hi = (F.col(c) if isinstance(c, str) else c for c in (n, mean, m2, lo, hi))
    same = lo == hi
    deviation = F.when(same, F.lit(0.0)).otherwise(F.sqrt(F.greatest(m2, F.lit(0.0)) / (n - F.lit(1.0))))
    return F.when(same, lo).otherwise(mean), F.when(n > 1, deviation)


def window_lists(df, ts, value, keys=(), seconds=7200, slide=3600, page_rows=LIST_PAGE, stats=()):
    """Values of each window as a sorted list, with optional statistics.

    Page p holds the elements p * ``page_rows`` to (p + 1) * ``page_rows`` - 1 of the
    sorted list, so the pages of a window in order are its list and a list within
    ``page_rows`` is page 0. Nothing is dropped and no task ever holds more than
    about a page.

    Equal values are counted before the shuffle and travel as one row, which
    is cut where a page ends. How many pages a window needs
    is settled first, in a table that names only the windows with more than one
    (or every window, when statistics are asked for).
    """
    keys = _names(keys)
    rows = spread(df, ts, seconds, slide).select("window_start", "window_end", *keys, F.col(value).alias("value"))
    group = ["window_start", "window_end", *keys]
    pages = F.greatest(F.ceil(F.count("value") / F.lit(page_rows)), F.lit(1))
    summary = rows.groupBy(*group).agg(pages.alias("pages"), *stats)
    extra = [c for c in summary.columns if c not in group and c != "pages"]
    settled = materialise(summary if stats else summary.where("pages > 1"), "windows")
    counted = rows.groupBy(*group, "value").agg(F.count("*").alias("n"))
    joined = (
        counted.alias("c")
        .join(settled.alias("s"), same_keys("c", "s", group), "left")
        .select(
            *[F.col(f"c.{c}").alias(c) for c in group],
            *[F.col(f"s.{c}").alias(c) for c in extra],
            F.coalesce("s.pages", F.lit(1)).alias("pages"),
            "c.value",
            "c.n",
        )
    )
    large = settled.where("pages > 1").select(*group)
    small = joined.where("pages = 1").withColumn("begin", F.lit(0).cast("long"))
    ranked = small if large.isEmpty() else small.unionByName(_ranked(joined.where("pages > 1"), group))
    return _paged(ranked, group, extra, page_rows)


def lists_of_counts(counted, group, page_rows=LIST_PAGE):
    """The same pages from windows whose values are counted already: columns of ``group``, ``value`` and ``n``.

    For windows a stream has closed: their state is one row per distinct value, and
    the lists exist only here, a page at a time.
    """
    counted = materialise(counted, "counted")
    held = F.coalesce(F.sum(F.when(F.col("value").isNotNull(), F.col("n"))), F.lit(0))
    summary = counted.groupBy(*group).agg(held.alias("held"))
    large = materialise(summary.where(F.col("held") > max(page_rows, LIST_PAGE)).select(*group), "windows")
    if large.isEmpty():
        return _near_pages(counted, group, page_rows)
    same = same_keys("c", "s", group)
    near = counted.alias("c").join(large.alias("s"), same, "left_anti")
    ranked = _ranked(counted.alias("c").join(large.alias("s"), same, "left_semi"), group)
    return _near_pages(near, group, page_rows).unionByName(_paged(ranked, group, [], page_rows))


def _near_pages(counted, group, page_rows):
    """Pages of windows of about ``LIST_PAGE`` values at most: one exchange brings a window together, which is
    ranked and cut where it is."""
    if page_rows >= LIST_PAGE:
        return _paged(counted.withColumn("begin", F.lit(0).cast("long")), group, [], page_rows)
    above = Window.partitionBy(*group).orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    before = F.sum(F.when(F.col("value").isNotNull(), F.col("n"))).over(above)
    return _paged(counted.withColumn("begin", F.coalesce(before, F.lit(0))), group, [], page_rows, dealt=True)


def _paged(ranked, group, extra, page_rows, dealt=False):
    """Counted values that know how many stand before them, as the pages of their window's sorted list.

    ``dealt``: the windows are small and lie whole in a partition each, so their pages need no exchange.
    """
    size, begin = F.lit(page_rows).cast("long"), F.col("begin")
    last = F.when(F.col("value").isNotNull(), F.floor((begin + F.col("n") - 1) / size)).otherwise(F.lit(0))
    copies = F.least(begin + F.col("n"), (F.col("page") + 1) * size) - F.greatest(begin, F.col("page") * size)
    # Missing values are in no list, but a window that has no others still has an empty one.
    paged = ranked.withColumn(
        "page", F.explode(F.sequence(F.when(F.col("value").isNotNull(), F.floor(begin / size)).otherwise(F.lit(0)), last))
    ).select(
        *group,
        *extra,
        "page",
        "value",
        F.when(F.col("value").isNotNull(), copies).otherwise(F.lit(0)).cast("int").alias("copies"),
    )
    # The exchange names the page too, so the pages of one window spread over tasks.
    lists = (
        (paged if dealt else paged.repartition(*group, "page"))
        .groupBy(*group, *extra, "page")
        .agg(F.flatten(F.collect_list(F.array_repeat("value", F.col("copies")))).alias("values"))
    )
    return lists.select(*group, *extra, "page", F.sort_array("values").alias("values"))


def _ranked(counted, group):
    """Counted values of windows with ``begin``, how many elements of the window's sorted list stand before.

    Values are cut into ranges at estimated quantiles: counts add up over the
    ranges of a window and within each range, so no task orders a whole window.
    The ranks are exact wherever the cuts lie.
    """
    counted = materialise(counted, "ranked")
    present = counted.where("value is not null")
    shares = [i / RANGES for i in range(1, RANGES)]
    cuts = present.groupBy(*group).agg(F.percentile_approx("value", shares).alias("cuts"))
    placed = present.alias("c").join(cuts.alias("s"), same_keys("c", "s", group)).select(
        *[F.col(f"c.`{c}`") for c in counted.columns],
        F.size(F.filter(F.col("s.cuts"), lambda x: x < F.col("c.value"))).alias("range"),
    )
    ranges = placed.groupBy(*group, "range").agg(F.sum("n").alias("held"))
    above = Window.partitionBy(*group).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("before", F.coalesce(F.sum("held").over(above), F.lit(0))).drop("held")
    inner = Window.partitionBy(*group, "range").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    inside = placed.withColumn("inside", F.coalesce(F.sum("n").over(inner), F.lit(0)))
    ranked = inside.alias("v").join(ranges.alias("r"), same_keys("v", "r", [*group, "range"])).select(
        *[F.col(f"v.`{c}`") for c in counted.columns], (F.col("r.before") + F.col("v.inside")).alias("begin")
    )
    return ranked.unionByName(counted.where("value is null").withColumn("begin", F.lit(0).cast("long")))


def window_summary(df, ts, value, keys=(), seconds=10, digits=4, page_rows=LIST_PAGE):
    """Rounded mean and deviation, row count and value list per tumbling window."""
    stats = [
        steady_round(F.avg("value"), digits).alias("avg"),
        steady_round(F.stddev_samp("value"), digits).alias("standard_dev"),
        F.count("*").alias("count"),
    ]
    return window_lists(df, ts, value, keys, seconds, seconds, page_rows, stats)


def with_window_stats(df, ts, columns, keys=(), seconds=10, digits=None):
    """Rows with the mean and deviation of their tumbling window for each column.

    Every row stays: a null key is a group of its own, and a row without a time has
    no window and no statistics. Statistics are aggregated and written first, so the join is planned on their
    real size: few windows are broadcast and the rows never shuffle; many are
    joined by key, where adaptive execution splits a crowded window.
    """
    keys = _names(keys)
    # F.window would drop rows without a time.
    at = epoch(F.col(ts).cast("timestamp"))
    start = F.timestamp_seconds(F.floor(at / F.lit(seconds)) * F.lit(seconds)).cast(df.schema[ts].dataType)
    rows = df.withColumn("window_start", start)
    aggregates = []
    for c in columns:
        mean, deviation = F.avg(c), F.stddev_samp(c)
        if digits is not None:
            mean, deviation = steady_round(mean, digits), steady_round(deviation, digits)
        aggregates += [mean.alias(f"{c}_mean"), deviation.alias(f"{c}_stddev")]
    timed = rows.where(F.col("window_start").isNotNull())
    stats = materialise(timed.groupBy(*keys, "window_start").agg(*aggregates), "window-stats")
    group = [*keys, "window_start"]
    joined = rows.alias("r").join(stats.alias("s"), same_keys("r", "s", group), "left")
    added = [F.col(f"s.`{c}`") for c in stats.columns if c not in group]
    return joined.select(*[F.col(f"r.`{c}`") for c in [*group, *[c for c in rows.columns if c not in group]]], *added)


def window_outliers(df, ts, value, seconds=10, threshold=1.0, digits=4):
    """Rows further than some deviations from the mean of their tumbling window."""
    rows = df.select(F.col(ts).alias("ts"), F.col(value).alias("value"))
    scored = with_window_stats(rows, "ts", ["value"], (), seconds, digits).withColumn(
        "z_score", z_score(F.col("value"), F.col("value_mean"), F.col("value_stddev"))
    )
    z = F.col("z_score")
    return scored.where(is_finite(z) & outside(z, threshold)).select(
        "window_start",
        F.col("value_mean").alias("avg"),
        F.col("value_stddev").alias("standard_dev"),
        "value",
        "z_score",
    )


def standardise(df, ts, columns, keys=(), seconds=10):
    """Columns as z-scores within their tumbling window; null where the deviation is zero or missing."""
    joined = with_window_stats(df, ts, columns, keys, seconds)
    scores = {
        f"{c}_norm": z_score(F.col(c), F.col(f"{c}_mean"), F.col(f"{c}_stddev")) for c in columns
    }
    return joined.withColumns(scores).drop(
        *[f"{c}_mean" for c in columns], *[f"{c}_stddev" for c in columns]
    )


def day_and_night(day, night):
    """Two aggregates as one, told apart by a period column."""
    return day.withColumn("period", F.lit("day")).unionByName(night.withColumn("period", F.lit("night")))


def same_keys(left, right, keys):
    """Equality of keys between two aliased frames; null is a group of its own, as in an aggregation."""
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys])


def _names(keys):
    return [keys] if isinstance(keys, str) else list(keys)
