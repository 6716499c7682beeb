"""Streams joined with their own windows, windows built from panes, counted lists and distinct rows."""

from pyspark.sql import functions as F

from obsflow.functions.time import DAY, WEEK
from obsflow.operators import windows
from obsflow.operators.trailing import trailing_mean_windows
from obsflow.session import shared_folder
from obsflow.sources.files import stream_parquet
from obsflow.streaming import sinks
from obsflow.streaming import windows as live
from obsflow.streaming.store import BatchStore

SCHEMA = "station string, valid timestamp, tmpf double, relh double, vsby double"


def table(spark, rows):
    df = spark.createDataFrame([(s, t, v, 0.5, 0.1) for s, t, v in rows], SCHEMA.replace("timestamp", "string"))
    return df.withColumn("valid", F.col("valid").cast("timestamp"))


def feed(spark, batches, build):
    """Run a query over batches in the order given; its rows and the progress of every batch."""
    source, out, checkpoint = (shared_folder(spark, n) for n in ("in", "out", "checkpoint"))
    progress, schema = [], None
    for rows in batches:
        rows.coalesce(1).write.mode("append").parquet(source)
        with sinks.state_partitions(spark, 2):
            result = build(stream_parquet(spark, source, rows.schema))
            schema = result.schema
            query = sinks.to_files(result, out, checkpoint)
        query.awaitTermination()
        progress += query.recentProgress
    return spark.read.schema(schema).parquet(out), progress


def updated(progress):
    return sum(s["numRowsUpdated"] for p in progress for s in p["stateOperators"])


def held(progress):
    return sum(s["numRowsTotal"] for s in progress[-1]["stateOperators"])


def slots(spark, n):
    """Batches that all bring values for the same two quarter hours, within the delay, then one that closes them."""
    times = [f"2024-01-05 12:{m:02d}:00" for m in (0, 15)]
    same = [table(spark, [(s, t, b + i / 10) for s in "ab" for i, t in enumerate(times)]) for b in range(n)]
    return [*same, table(spark, [("a", "2024-01-16 00:00:00", 1.0)])]


def test_panes_update_less_state_than_windows(spark):
    def whole(stream):
        return trailing_mean_windows(stream.withWatermark("valid", "15 minutes"), "valid", ["tmpf", "relh", "vsby"], "station")

    batches = slots(spark, 6)
    direct, many = feed(spark, batches, whole)
    panes, few = feed(spark, batches, live.short_term)
    got = {(r.station, r.valid, round(r.temp, 9)) for r in panes.collect()}
    assert got == {(r.station, r.valid, round(r.tmpf_avg, 9)) for r in direct.collect()} and len(got) == 4
    assert updated(few) * 2 < updated(many)

    def weeks(stream):
        return windows.window_stats(stream.withWatermark("valid", "15 minutes"), "valid", "tmpf", ["station"], WEEK, DAY, 4)

    direct, many = feed(spark, batches, weeks)
    panes, few = feed(spark, batches, live.baseline)
    got = {(r.station, r.baseline_start, r.avg_temp, r.stddev_temp) for r in panes.collect()}
    assert got == {(r.station, r.window_start, r.avg_temp, r.stddev_temp) for r in direct.collect()} and len(got) == 14
    assert updated(few) * 2 < updated(many)


def test_join_of_scores_is_keyed_by_station_and_day(spark):
    source, out, checkpoint = (shared_folder(spark, n) for n in ("in", "out", "checkpoint"))
    rows = table(spark, [("a", "2024-01-05 12:00:00", 1.0)])
    rows.write.parquet(source)
    with sinks.state_partitions(spark, 2):
        query = sinks.to_files(live.scored(stream_parquet(spark, source, rows.schema)), out, checkpoint)
    query.awaitTermination()
    plan = query._jsq.streamingQuery().lastExecution().executedPlan().toString()
    join = next(line for line in plan.splitlines() if "StreamingSymmetricHashJoin" in line)
    assert join.count("station#") >= 2 and join.count("day#") >= 2


def test_rows_meet_the_closed_statistics_of_their_window(spark):
    first = table(spark, [("a", f"2024-01-05 12:00:0{i}", float(i % 3)) for i in range(9)] + [(None, "2024-01-05 12:00:01", 7.0), (None, "2024-01-05 12:00:02", 9.0)])
    second = table(spark, [("a", "2024-01-05 12:00:09", 50.0), ("a", "2024-01-05 13:00:00", 1.0), ("a", None, 1.0)])
    last = table(spark, [("a", "2024-01-05 14:00:00", 1.0)])
    rows, progress = feed(spark, [first, second, last], lambda s: live.with_window_stats(s, "valid", ["tmpf"], ["station"], 10))
    both = first.union(second).where("valid is not null")
    want = windows.with_window_stats(both, "valid", ["tmpf"], ["station"], 10)
    columns = ["station", "valid", "tmpf", F.round("tmpf_mean", 9), F.round("tmpf_stddev", 9)]
    assert sorted(map(str, rows.select(columns).collect())) == sorted(map(str, want.select(columns).collect()))
    assert held(progress) <= 40


def test_stream_outliers_and_scores_equal_batch(spark):
    rows = table(spark, [("a", f"2024-01-05 12:{i % 60:02d}:00", float(i * i % 17)) for i in range(200)])
    last = table(spark, [("a", "2024-01-06 12:00:00", 1.0)])
    found, _ = feed(spark, [rows, last], lambda s: live.window_outliers(s, "valid", "tmpf", 3600))
    want = windows.window_outliers(rows, "valid", "tmpf", 3600)
    assert sorted(map(str, found.collect())) == sorted(map(str, want.collect())) and want.count() > 10
    scores, _ = feed(spark, [rows, last], lambda s: live.standardise(s, "valid", ["tmpf", "relh"], ["station"], 3600))
    want = windows.standardise(rows, "valid", ["tmpf", "relh"], ["station"], 3600)
    columns = ["valid", "tmpf", F.round("tmpf_norm", 9), "relh_norm"]
    assert sorted(map(str, scores.select(columns).collect())) == sorted(map(str, want.select(columns).collect()))


def test_a_list_is_held_as_counts_of_its_values(spark):
    """Thousands of rows of three values are three state rows in each of two windows."""
    rows = table(spark, [("a", f"2024-01-05 12:{i % 60:02d}:00", float(i % 3)) for i in range(3000)])
    rows = rows.union(table(spark, [("b", "2024-01-05 12:00:00", None)]))
    source, out, checkpoint = (shared_folder(spark, n) for n in ("in", "out", "checkpoint"))
    group = ["station", "window_start", "window_end"]
    most = []
    for part in (rows, table(spark, [("c", "2024-01-06 12:00:00", 1.0)])):
        part.write.mode("append").parquet(source)
        with sinks.state_partitions(spark, 2):
            counts = live.value_counts(stream_parquet(spark, source, rows.schema))
            query = live.to_lists(counts, out, checkpoint, group, 700)
        query.awaitTermination()
        most += [s["numRowsTotal"] for p in query.recentProgress for s in p["stateOperators"]]
    assert max(most) == 2 * 3 + 2 + 2
    pages = BatchStore(spark, out).read().where("station = 'a'").orderBy("window_start", "page").collect()
    assert [(r.page, len(r["values"])) for r in pages] == [(p, 700 if p < 4 else 200) for p in range(5)] * 2
    assert sum((r["values"] for r in pages[:5]), []) == [0.0] * 1000 + [1.0] * 1000 + [2.0] * 1000
    empty = BatchStore(spark, out).read().where("station = 'b'").collect()
    assert [(r.page, r["values"]) for r in empty] == [(0, []), (0, [])]


def test_repeats_in_later_batches_are_dropped_and_forgotten(spark):
    rows = table(spark, [("a", f"2024-01-05 12:{m:02d}:00", 1.0) for m in range(10)])
    later = table(spark, [("a", "2024-01-05 15:00:00", 1.0)])
    found, progress = feed(spark, [rows, rows.limit(4), rows, later], lambda s: live.distinct(s, "valid", delay="30 minutes"))
    assert found.count() == found.distinct().count() == 11
    assert held(progress) == 1
