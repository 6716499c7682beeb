"""Trailing frames: for every observation time, the rows of the last hours or days.

A window function partitioned by station alone would put a busy station into
one task. Here rows are first reduced to one partial result per station and
time (combining inside map tasks), and the frames then run over partitions of
one station and one time bucket, whose size the clock bounds.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from obsflow.functions.time import DAY, QUARTER_HOUR, TWO_HOURS, WEEK, epoch, interval_text, shift
from obsflow.operators.windows import _names, merge_all, moments_result, same_keys


def trailing_mean(df, ts, values, keys, seconds=TWO_HOURS, empty=0.0, bucket_column=None):
    """Mean of each column over the ``seconds`` up to and including each distinct time.

    Nulls are skipped; a frame without values gives ``empty``. A slot close to
    the end of its bucket is copied to the next one, where it only serves as
    history. The bucket number (the day, for frames up to a day) can be kept:
    rows are already partitioned by keys and bucket, so a join on both needs no
    further shuffle of this side.
    """
    keys = _names(keys)
    bucket = max(DAY, seconds)
    partials = []
    for v in values:
        partials += [F.sum(v).alias(f"{v}_sum"), F.count(v).alias(f"{v}_n")]
    slots = df.where(F.col(ts).isNotNull()).groupBy(*keys, ts).agg(*partials).withColumn("at", epoch(ts))
    own = F.floor(F.col("at") / F.lit(bucket))
    last = F.floor((F.col("at") + F.lit(seconds)) / F.lit(bucket))
    # Named before the exchange, so the partitioning is known by the kept name.
    name = bucket_column or "bucket"
    carried = slots.withColumn(name, F.explode(F.sequence(own, last)))
    frame = Window.partitionBy(*keys, name).orderBy("at").rangeBetween(-seconds, 0)
    means = [
        F.coalesce(
            F.sum(f"{v}_sum").over(frame) / F.nullif(F.sum(f"{v}_n").over(frame), F.lit(0)), F.lit(empty)
        ).alias(f"{v}_avg")
        for v in values
    ]
    framed = carried.select(*keys, ts, name, (F.col(name) == own).alias("own"), *means).where("own")
    return framed.drop("own") if bucket_column else framed.drop("own", name)


def trailing_mean_windows(df, ts, values, keys, seconds=TWO_HOURS, grid=QUARTER_HOUR, empty=0.0):
    """The same means for times on a grid, as sliding windows; this form also runs on a stream.

    A window reaching one grid step past a time holds exactly the slots of that
    time's trailing frame, and counts where a row sits on its last slot.
    """
    keys = _names(keys)
    window = F.window(ts, interval_text(seconds + grid), interval_text(grid))
    means = [F.coalesce(F.avg(v), F.lit(empty)).alias(f"{v}_avg") for v in values]
    grouped = df.groupBy(*keys, window).agg(F.max(ts).alias("latest"), *means)
    return grouped.where(F.col("latest") == shift(F.col("window.end"), -grid)).select(
        *keys, F.col("latest").alias(ts), "window", *[f"{v}_avg" for v in values]
    )


def trailing_stats(df, ts, value, keys, seconds=WEEK, pane=DAY, names=("avg_temp", "stddev_temp")):
    """Mean and sample deviation over the trailing days of each distinct time.

    A frame is the end of its first pane, the whole panes between, and its last
    pane up to the time itself. The two ends are running sums inside one pane
    and the middle comes from a small table of panes, so the work grows with
    the rows, not with rows times frame length. Sums are taken around the mean of
    their own key and pane, and parts are merged as count, mean and squared
    deviations, so no key suffers from the range of another. Times count in
    microseconds.
    """
    if seconds % pane:
        raise ValueError("the pane must divide the frame")
    keys = _names(keys)
    frame, width = int(seconds) * 1_000_000, int(pane) * 1_000_000
    n = F.count("v").cast("double")
    rows = df.where(F.col(ts).isNotNull()).select(*keys, F.unix_micros(ts).alias("at"), F.col(value).alias("v"))
    slots = rows.groupBy(*keys, "at").agg(
        n.alias("n"),
        F.avg("v").alias("mean"),
        (F.var_pop("v") * n).alias("m2"),
        F.min("v").alias("lo"),
        F.max("v").alias("hi"),
    )

    def pane_of(c):
        return F.floor(c / F.lit(width))

    # Each slot counts in its own pane, and a probe at its frame's start asks the
    # first pane for everything from there on.
    moments = ["n", "mean", "m2", "lo", "hi"]
    here = F.struct(F.col("at").alias("position"), F.lit(False).alias("probe"), *moments)
    there = F.struct(
        (F.col("at") - F.lit(frame)).alias("position"),
        F.lit(True).alias("probe"),
        F.lit(0.0).alias("n"),
        *[F.lit(None).cast("double").alias(c) for c in moments[1:]],
    )
    both = slots.select(*keys, "at", F.explode(F.array(here, there)).alias("e")).select(*keys, "at", "e.*")
    both = both.withColumn("pane", pane_of(F.col("position")))
    cell = Window.partitionBy(*keys, "pane")
    until = cell.orderBy("position").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    onward = cell.orderBy(F.col("position").desc()).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    whole = cell.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    centre = F.sum(F.col("mean") * F.col("n")).over(whole) / F.nullif(F.sum("n").over(whole), F.lit(0.0))
    off = F.col("mean") - F.col("centre")
    centred = both.withColumn("centre", centre).select(
        *keys, "at", "pane", "position", "probe", "n", "lo", "hi", "centre",
        F.coalesce(F.col("n") * off, F.lit(0.0)).alias("s"),
        F.coalesce(F.col("m2") + F.col("n") * off * off, F.lit(0.0)).alias("q"),
    )

    def running(function, c):
        return F.when(F.col("probe"), function(c).over(onward)).otherwise(function(c).over(until)).alias(c)

    shifted = F.col("s") / F.nullif(F.col("n"), F.lit(0.0))
    part = F.struct(
        "n",
        (F.col("centre") + shifted).alias("mean"),
        F.coalesce(F.col("q") - F.col("s") * shifted, F.lit(0.0)).alias("m2"),
        "lo",
        "hi",
    )
    ends = (
        centred.select(
            *keys, "at", "probe", "centre", *[running(F.sum, c) for c in ("n", "s", "q")], running(F.min, "lo"), running(F.max, "hi")
        )
        .groupBy(*keys, "at")
        .agg(F.sort_array(F.collect_list(F.struct("probe", part.alias("part")))).alias("parts"))
        .withColumn("pane", pane_of(F.col("at")))
    )

    # Whole panes between, counted towards each of the panes that follow them:
    # at most as many for a frame as it has panes.
    between = seconds // pane - 1
    off = F.col("mean") - F.col("centre")
    panes = (
        slots.withColumn("pane", pane_of(F.col("at")))
        .withColumn("centre", centre)
        .groupBy(*keys, "pane", "centre")
        .agg(
            F.sum("n").alias("n"),
            F.coalesce(F.sum(F.col("n") * off), F.lit(0.0)).alias("s"),
            F.coalesce(F.sum(F.col("m2") + F.col("n") * off * off), F.lit(0.0)).alias("q"),
            F.min("lo").alias("lo"),
            F.max("hi").alias("hi"),
        )
        .select(*keys, "pane", part.alias("part"))
    )
    ahead = F.explode(F.sequence(F.lit(1), F.lit(between))) if between else F.lit(1)
    middle = (
        panes.where(F.lit(between > 0))
        .withColumn("ahead", ahead)
        .groupBy(*keys, (F.col("pane") + F.col("ahead")).alias("pane"))
        .agg(F.sort_array(F.collect_list(F.struct("ahead", "part"))).alias("parts"))
    )
    joined = ends.alias("e").join(middle.alias("m"), same_keys("e", "m", [*keys, "pane"]), "left")
    # One fold over the parts of both sides: a merge of two folds would repeat each of them in every field.
    parts = [F.transform(c, lambda p: p["part"]) for c in ("e.parts", "m.parts")]
    parts = F.when(F.col("m.parts").isNull(), parts[0]).otherwise(F.concat(*parts))
    total = joined.select(*[F.col(f"e.{k}").alias(k) for k in keys], "at", parts.alias("parts"))
    total = total.withColumn("t", merge_all("parts"))
    mean, deviation = moments_result("t.n", "t.mean", "t.m2", "t.lo", "t.hi")
    kind = df.schema[ts].dataType.simpleString()
    at = F.timestamp_micros("at").cast(kind) if kind != "timestamp" else F.timestamp_micros("at")
    return total.select(*keys, at.alias(ts), mean.alias(names[0]), deviation.alias(names[1]))
