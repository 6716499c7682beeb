from datetime import datetime

import pytest
from pyspark.sql import functions as F

from obsflow.operators import kmeans, scoring, windows
from obsflow.operators.clean import feature_engineering, observations, to_messages, with_valid
from obsflow.plans import exploration, supervised, unsupervised
from obsflow.session import shared_folder
from obsflow.sources.events import observations_from_events
from obsflow.sources.files import stream_messages, stream_parquet
from obsflow.streaming import sinks
from obsflow.streaming import windows as live
from obsflow.streaming.replay import await_rows, paced, replay, replayed, time_slices
from obsflow.streaming.store import BatchStore, KeyedTable

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def clean(spark):
    raw = observations_from_events(spark.read.parquet(f"{SF}/events.parquet"))
    return feature_engineering(with_valid(raw)).select("station", "valid", "tmpf", "relh", "vsby")


def keyed(df, *columns):
    return {tuple(r) for r in df.select(*columns).collect()}


def folders(spark):
    return shared_folder(spark, "out"), shared_folder(spark, "checkpoint")


def rounded(df, *columns):
    return df.select("station", "valid", *[F.round(c, 9).alias(c) for c in columns])


@pytest.mark.parametrize("slices", [1, 3])
def test_trailing_means_equal_batch_however_rows_arrive(clean, slices):
    stream = rounded(replayed(clean, "valid", live.short_term, slices), "temp", "relh_avg", "vsby_avg")
    batch = rounded(scoring.short_term(clean), "temp", "relh_avg", "vsby_avg")
    got, expected = set(stream.collect()), set(batch.collect())
    assert got <= expected and len(got) >= len(expected) - 4


def test_scores_equal_batch_on_closed_windows(clean):
    stream = rounded(replayed(clean, "valid", live.scored, 2), "temp", "avg_temp", "stddev_temp", "z_score")
    batch = rounded(scoring.scored_observations(clean), "temp", "avg_temp", "stddev_temp", "z_score")
    got, expected = set(stream.collect()), set(batch.collect())
    assert got <= expected and len(got) >= len(expected) - 4 and len(got) > 300


def test_weekly_stream_equals_batch(clean):
    stream = replayed(clean, "valid", lambda s: exploration.weekly_day(s, "15 minutes"), 2)
    batch = exploration.weekly_day(clean)
    columns = ["station", "window_start", "window_end", F.round("avg_temp", 9), F.round("stddev_temp", 9)]
    got, expected = keyed(stream, *columns), keyed(batch, *columns)
    last = max(r[2] for r in expected)
    assert got == {r for r in expected if r[2] < last}


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    schema = "station string, valid timestamp, tmpf double"
    source, (out, checkpoint) = str(tmp_path / "in"), folders(spark)

    def feed(rows):
        df = spark.createDataFrame(rows, "station string, valid string, tmpf double")
        df.withColumn("valid", F.col("valid").cast("timestamp")).coalesce(1).write.mode("append").parquet(source)
        query = sinks.to_files(live.weekly(stream_parquet(spark, source, schema), delay="15 minutes"), out, checkpoint)
        query.awaitTermination()
        return sum(o["numRowsDroppedByWatermark"] for p in query.recentProgress for o in p["stateOperators"])

    assert feed([("a", "2024-01-04 00:00", 1.0), ("a", "2024-01-05 00:00", 3.0)]) == 0
    assert feed([("a", "2024-01-12 00:00", 9.0)]) == 0
    assert feed([("a", "2024-01-05 12:00", 100.0), ("a", "2024-01-19 00:00", 9.0)]) == 1
    got = spark.read.parquet(out).orderBy("window_start").collect()
    assert [(r["window_start"], r["avg_temp"]) for r in got] == [
        (datetime(2024, 1, 4), 2.0), (datetime(2024, 1, 11), 9.0)
    ]


def test_late_rows_are_counted_over_the_whole_run(spark):
    """The count comes from every batch's progress, also of queries that ended long ago."""
    source, (out, checkpoint) = shared_folder(spark, "in"), folders(spark)
    schema = "station string, valid timestamp, tmpf double"
    days = ["2024-01-19", "2024-01-05", "2024-01-06", "2024-02-19", "2024-01-20"]
    with sinks.late_counter(spark) as late:
        for day in days:
            rows = spark.createDataFrame([("a", day, 1.0)], "station string, valid string, tmpf double")
            rows.withColumn("valid", F.col("valid").cast("timestamp")).coalesce(1).write.mode("append").parquet(source)
            stream = live.weekly(stream_parquet(spark, source, schema), delay="15 minutes")
            sinks.to_files(stream, out, checkpoint).awaitTermination()
    assert late.rows == 3


def test_paced_replay_gives_every_row_once(spark, clean):
    out, checkpoint = folders(spark)
    stream = paced(clean.repartition(3), 300)
    query = sinks.to_batches(stream, out, checkpoint, seconds=1)
    await_rows(query, clean.count())
    store = BatchStore(spark, out)
    got = store.read().drop("batch_id")
    assert got.count() == clean.count() and got.exceptAll(clean).count() == 0
    assert max(store.read(n).count() for n in store.batches()) == 300


def test_output_modes_and_memory_sink(spark, clean):
    folder = shared_folder(spark, "in")
    clean.write.parquet(folder)
    stream = stream_parquet(spark, folder, clean.schema)
    counts = windows.count_by(stream, "station")
    sinks.to_memory(counts, "by_station", "complete").awaitTermination()
    assert spark.table("by_station").collect() == windows.count_by(clean, "station").collect()
    updates = windows.count_by(stream, "station", ordered=False)
    sinks.to_memory(updates, "updates", "update").awaitTermination()
    assert spark.table("updates").count() == 11
    query = sinks.to_console(stream.where("false"), seconds=1)
    query.processAllAvailable()
    query.stop()


def test_snapshot_of_an_aggregate(spark, clean):
    folder, (snapshots, checkpoint) = shared_folder(spark, "in"), folders(spark)
    clean.write.parquet(folder)
    counts = windows.count_by(stream_parquet(spark, folder, clean.schema), "station")
    sinks.to_snapshots(counts, snapshots, checkpoint).awaitTermination()
    assert set(sinks.read_snapshot(spark, snapshots).collect()) == set(windows.count_by(clean, "station").collect())


def test_table_of_weeks_and_stream_against_it(spark, clean):
    folder, (weeks, checkpoint) = shared_folder(spark, "in"), folders(spark)
    clean.write.parquet(folder)
    stream = stream_parquet(spark, folder, clean.schema)
    with pytest.raises(Exception, match="no table of baselines"):
        exploration.run_compare_stream(stream, weeks, *folders(spark), seconds=None).awaitTermination()
    exploration.run_baseline_stream(stream, weeks, checkpoint, seconds=None).awaitTermination()
    columns = ["station", "window_start", F.round("avg_temp", 9)]
    table = exploration.read_weeks(spark, weeks)
    assert keyed(table, *columns) == keyed(exploration.sliding_week(clean), *columns)

    out, again = folders(spark)
    exploration.run_compare_stream(stream, weeks, out, again, seconds=None, threshold=1.0).awaitTermination()
    expected = exploration.compare_anomalies(clean, exploration.sliding_week(clean), 1.0)
    columns = ["station", "window_start", "temperature", "baseline_start", F.round("z_score", 6)]
    assert keyed(spark.read.parquet(out), *columns) == keyed(expected, *columns)


def test_ten_weeks_keep_the_state_of_a_few(spark):
    """State holds weeks that can still change, and a batch writes only the days it changed."""
    rows = spark.range(10 * 7 * 4).selectExpr(
        "'a' AS station", "timestamp '2024-01-01' + make_interval(0, 0, 0, 0, cast(id * 6 as int)) AS valid", "cast(id as double) AS tmpf"
    )
    weeks, checkpoint = folders(spark)
    held, written = [], []

    def run(stream):
        query = exploration.run_baseline_stream(stream, weeks, checkpoint, seconds=None)
        query.awaitTermination()
        held.append(max(s["numRowsTotal"] for p in query.recentProgress for s in p["stateOperators"]))
        folders_now = exploration.KeyedTable(spark, weeks, exploration.WEEK_KEYS, "window_start").manifest()["folders"]
        last = max(int(f.split("/")[0].split("=")[1]) for f in folders_now.values())
        written.append(sum(f.startswith(f"batch={last}/") for f in folders_now.values()))
        return query

    replay(rows, "valid", run, 5)
    assert max(held) <= 45 and max(written) <= 25
    columns = ["station", "window_start", F.round("avg_temp", 9), F.round("stddev_temp", 9)]
    assert keyed(exploration.read_weeks(spark, weeks), *columns) == keyed(exploration.sliding_week(rows), *columns)


def test_keyed_table_replaces_rows_and_repeats_no_batch(spark):
    table = KeyedTable(spark, shared_folder(spark, "keyed"), ["k"], "day", keep=1)
    assert table.read() is None

    def rows(*items):
        return spark.createDataFrame(items, "k string, day string, v int")

    table.update(rows(("a", "x y/z", 1), ("b", "x y/z", 1), (None, None, 1)), 0)
    table.update(rows(("a", "x y/z", 2), ("c", "d2", 2)), 1)
    table.update(rows(("a", "x y/z", 9)), 1)
    table.update(rows(), 2)
    table.update(rows((None, None, 3)), 3)
    got = {tuple(r) for r in table.read().collect()}
    assert got == {("a", "x y/z", 2), ("b", "x y/z", 1), ("c", "d2", 2), (None, None, 3)}
    assert table.manifest()["batch_id"] == 3


def test_only_the_last_snapshots_stay(spark):
    store = BatchStore(spark, shared_folder(spark, "store"))
    assert store.batches() == [] and store.latest() is None
    for n in range(5):
        store.write(spark.range(n), n)
    store.write(spark.range(9), 4)
    assert store.read(4).count() == 9 and store.latest() == 4 and store.latest(before=4) == 3
    store.forget(2)
    assert store.batches() == [3, 4]


def test_rows_without_a_batch_twice(spark, clean):
    out, checkpoint = folders(spark)

    def run(stream):
        return sinks.to_batches(stream, out, checkpoint)

    replay(clean, "valid", run, 3)
    assert spark.read.parquet(out).count() == clean.count()
    assert BatchStore(spark, out).batches() == [0, 1, 2]


def test_slices_cover_the_time_span(clean):
    bounds = time_slices(clean, "valid", 4)
    assert len(bounds) == 4 and all(a[1] == b[0] for a, b in zip(bounds, bounds[1:]))
    assert time_slices(clean.where("false"), "valid", 4) == []


def test_messages_to_supervised_detections(spark, clean):
    """JSON messages through cleaning, scoring and training, batch by batch."""
    raw = observations_from_events(spark.read.parquet(f"{SF}/events.parquet"))
    folder, (out, checkpoint) = shared_folder(spark, "messages"), folders(spark)
    for low, high in (("2024-01-01", "2024-01-20"), ("2024-01-20", "2024-02-01")):
        part = raw.where((F.col("valid") >= low) & (F.col("valid") < high))
        to_messages(part).write.mode("append").text(folder)
        stream = observations(stream_messages(spark, folder))
        supervised.run_stream(stream, out, checkpoint, seconds=None).awaitTermination()
    found = BatchStore(spark, out)
    for number in found.batches():
        assert found.read(number).where("prediction <= 0").count() == 0


def test_unsupervised_stream_moves_its_centres(spark, clean):
    raw = with_valid(observations_from_events(spark.read.parquet(f"{SF}/events.parquet")))
    out, checkpoint = folders(spark)
    model = shared_folder(spark, "model")
    first = kmeans.Centres([[0.2, 0.02, -1.0], [0.5, 0.05, 0.0], [0.8, 0.08, 2.0]])

    def run(stream):
        return unsupervised.run_stream(stream, out, model, checkpoint, first, decay=0.9, seconds=None)

    replay(raw, "valid", run, 2)
    models, log = BatchStore(spark, model), BatchStore(spark, out, "csv")
    rows = log.read()
    assert set(rows.columns) == {"station", "valid", *kmeans.FEATURES, "prediction", "batch_id"}
    assert rows.where("prediction = 'true'").count() > 0
    current = first
    for number in models.batches():
        assert unsupervised.load_centres(models, number) == (current if number else None)
        batch = log.read(number).select("station", "valid", *[F.col(c).cast("double") for c in kmeans.FEATURES])
        current = kmeans.step(kmeans.assign(batch, current), current, 0.9)
        saved = unsupervised.load_centres(models, number + 1)
        assert saved.weights == pytest.approx(current.weights)
        for a, b in zip(saved.points, current.points):
            assert a == pytest.approx(b)
        current = saved


def test_batch_jobs(spark, clean):
    raw = with_valid(observations_from_events(spark.read.parquet(f"{SF}/events.parquet")))
    flagged, moved = unsupervised.run_batch(raw)
    assert flagged.count() == scoring.scored_observations(clean).count() and len(moved.points) == 3
    found = supervised.run_batch(raw, shared_folder(spark, "flagged"))
    assert found is None or 0.0 <= found.auroc <= 1.0
