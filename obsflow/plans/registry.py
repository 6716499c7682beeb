"""Every operator as a named query over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from obsflow.functions.scalar import anomaly_label, steady_round
from obsflow.functions.time import TWO_HOURS, VALID_FORMAT, WEEK, parse_valid, reformat_valid, wall_clock
from obsflow.operators import clean, filters, kmeans, scaling, scoring, svm, trailing, windows
from obsflow.plans import exploration, supervised, unsupervised
from obsflow.schema import DIVISORS, FIELDS, MESSAGE_KEY
from obsflow.session import materialise, prepare, shared_folder, write_shared
from obsflow.sources import access_log
from obsflow.sources.events import log_lines_from_events, observations_from_events, read_events
from obsflow.sources.files import read_csv, stream_parquet, write_csv
from obsflow.streaming import windows as stream_windows
from obsflow.streaming.replay import await_rows, paced, replay, replayed
from obsflow.streaming.sinks import for_each_batch, read_snapshot, state_partitions, to_batches, to_snapshots
from obsflow.streaming.store import BatchStore

# Places that results are shown with, so both engines agree on the last bits.
PLACES = 6

# Fixed example model for the queries with given weights and centres.
EXAMPLE_WEIGHTS = [0.9, -0.4, 0.3, -0.7, 0.2]
# The last one is too far off to win a point.
EXAMPLE_CENTRES = kmeans.Centres(
    [[0.2, 0.02, -0.5], [0.5, 0.05, 0.5], [0.8, 0.08, 2.0], [90.0, -90.0, 900.0]], [100.0, 50.0, 10.0, 20.0]
)

COLD_START = "2024-01-01"
LOG_THRESHOLD = 0.5


def _events(spark, folder):
    return read_events(prepare(spark), folder)


def _raw(spark, folder):
    return observations_from_events(_events(spark, folder))


def _timed(spark, folder):
    """Raw text fields, ``valid`` as a timestamp."""
    return clean.with_valid(_raw(spark, folder))


def _clean(spark, folder):
    """Cleaned, encoded and scaled observations."""
    return clean.feature_engineering(_timed(spark, folder))


def _show(df, places=PLACES):
    """Doubles rounded and timestamps as the wall clock, for output only."""
    rounded = [
        steady_round(F.col(c), places).alias(c) if kind == "double" else F.col(c) for c, kind in df.dtypes
    ]
    return wall_clock(df.select(*rounded))


def _listed(column):
    """A list of two-decimal values as text."""
    return F.array_join(
        F.transform(F.col(column), lambda v: F.round(v * 100).cast("long").cast("string")), ","
    ).alias("list")


def _scored(spark, folder, **options):
    return scoring.scored_observations(_clean(spark, folder), **options)


def flagship_zscore(spark, folder):
    return _show(_scored(spark, folder))


def zscore_anomalies(spark, folder):
    return _show(filters.beyond(_scored(spark, folder), 2.0).withColumn("label", anomaly_label(F.col("z_score"))))


def zscore_cold_start(spark, folder):
    return _show(_scored(spark, folder, cold_start_origin=COLD_START))


def json_roundtrip(spark, folder):
    messages = clean.to_messages(_raw(spark, folder), key=MESSAGE_KEY)
    sent = messages.select(F.col("key").cast("binary"), F.col("value").cast("binary"))
    parsed = clean.observations(sent)
    numbers = [c for c in FIELDS if c in {"tmpf", "dwpf", "relh", "feel", "drct", "sped", "alti", "vsby"}]
    return wall_clock(
        parsed.withColumn("valid_text", F.date_format("valid", "yyyy-MM-dd HH:mm:ss"))
        .withColumns({c: F.col(c).try_cast("double") for c in numbers})
    )


def pattern_valid(spark, folder):
    return wall_clock(clean.with_valid(_raw(spark, folder), pattern=VALID_FORMAT).select("event_id", "valid"))


def reformatted_valid(spark, folder):
    raw = _raw(spark, folder)
    text = raw.select("event_id", reformat_valid("valid").alias("valid_text"), F.col("tmpf").try_cast("double").alias("tmpf"))
    return wall_clock(text.withColumn("valid", parse_valid("valid_text")))


def csv_roundtrip(spark, folder):
    path = shared_folder(prepare(spark), "csv")
    write_csv(_raw(spark, folder).select(*FIELDS), path)
    rows = read_csv(spark, path)
    return rows.withColumns({c: F.col(c).try_cast("double") for c in DIVISORS if c not in ("mslp", "skyl1")})


def impute_sentinels(spark, folder):
    return clean.impute(_raw(spark, folder)).select(
        "event_id", "mslp", "skyl1", "wxcodes", "ice_acceretion_1hr", "skyc1"
    )


def encode_sky(spark, folder):
    return clean.encode_sky(_raw(spark, folder)).select("event_id", "skyc1")


def encode_station(spark, folder):
    return clean.encode_station(_raw(spark, folder)).select("event_id", "station")


def scale_measurements(spark, folder):
    return _show(clean.scale(_raw(spark, folder)).select("event_id", *DIVISORS))


def feature_engineering(spark, folder):
    return _show(_clean(spark, folder))


def day_rows(spark, folder):
    return filters.day_rows(_events(spark, folder), "ts")


def night_rows(spark, folder):
    return filters.night_rows(_events(spark, folder), "ts")


def recent_week(spark, folder):
    return filters.recent(_events(spark, folder), "ts")


def aligned_rows(spark, folder):
    return wall_clock(filters.aligned(_timed(spark, folder)).select("event_id", "station", "valid"))


def count_by_topic_sorted(spark, folder):
    return windows.count_by(_events(spark, folder), "event_type")


def window_count(spark, folder):
    return windows.window_count(_events(spark, folder), "ts", "event_type")


def window_mean(spark, folder):
    return _show(windows.window_mean(_events(spark, folder), "ts", "value"))


def window_stats(spark, folder):
    pages = windows.window_summary(_events(spark, folder), "ts", "value")
    return pages.select("window_start", "window_end", "avg", "standard_dev", "count", "page", _listed("values"))


def window_outliers_1sigma(spark, folder):
    return _show(windows.window_outliers(_events(spark, folder), "ts", "value", seconds=6 * 3600))


def weekly_day(spark, folder):
    return _show(exploration.weekly_day(_clean(spark, folder)))


def weekly_night(spark, folder):
    return _show(exploration.weekly_night(_clean(spark, folder)))


def weekly_day_night(spark, folder):
    return _show(exploration.weekly_day_night(_clean(spark, folder)))


def sliding_week(spark, folder):
    return _show(exploration.sliding_week(_clean(spark, folder)))


def trailing_week(spark, folder):
    return _show(trailing.trailing_stats(_clean(spark, folder), "valid", "tmpf", "station", WEEK))


def trailing_week_events(spark, folder):
    """The same over times of microseconds, a third of the rows under one key, values around a level of their key's own."""
    kind, hot = F.col("event_type"), F.col("event_id") % 3 == 0
    rows = _events(spark, folder).select(
        F.when(hot, F.lit("hot")).otherwise(kind).alias("kind"),
        F.col("ts").cast("timestamp").alias("ts"),
        (F.col("value") + 10 * F.when(hot, F.lit(0)).otherwise(F.length(kind))).alias("value"),
    )
    return _show(trailing.trailing_stats(rows, "ts", "value", "kind", WEEK))


def two_hour_lists(spark, folder):
    rows = _timed(spark, folder).withColumn("tmpf", F.col("tmpf").try_cast("double"))
    lists = windows.window_lists(rows, "valid", "tmpf", "station", TWO_HOURS, 3600)
    return wall_clock(lists.select("station", "window_start", "window_end", "page", _listed("values")))


def two_hour_exploded(spark, folder):
    return _show(scoring.two_hour_rows(_clean(spark, folder)))


def range_join_compare(spark, folder):
    return _show(exploration.compare_with_itself(_clean(spark, folder)))


def range_join_anomalies(spark, folder):
    return _show(filters.beyond(exploration.compare_with_itself(_clean(spark, folder)), 2.0))


def _trailing(spark, folder, form):
    columns = ["station", "valid", "window_start", "temp", "relh_avg", "vsby_avg"]
    return _show(scoring.short_term(_clean(spark, folder), form=form).select(*columns))


def trailing_mean_range(spark, folder):
    return _trailing(spark, folder, "frames")


def trailing_mean_window(spark, folder):
    return _trailing(spark, folder, "windows")


MEASURED = ["tmpf", "dwpf", "relh", "feel", "drct", "sped", "mslp", "vsby", "skyl1"]


def window_standardise(spark, folder):
    rows = _clean(spark, folder).select("event_id", "valid", *MEASURED)
    scores = windows.standardise(rows, "valid", MEASURED, seconds=6 * 3600)
    return _show(scores.select("event_id", "window_start", *[f"{c}_norm" for c in MEASURED]))


def standard_scale(spark, folder):
    return _show(scaling.standard_scale(_raw(spark, folder), "tmpf").select("event_id", "tmpf_norm"))


def mean_impute(spark, folder):
    rows = clean.impute_mean(_raw(spark, folder), "mslp", marker=-1)
    return _show(rows.select("event_id", "mslp"))


def svm_features(spark, folder):
    rows = svm.labelled(_scored(spark, folder))
    return _show(rows.select("station", "valid", "label", *svm.FEATURES))


def hash_split(spark, folder):
    return wall_clock(svm.hash_split(_scored(spark, folder)).select("station", "valid", "is_train"))


def linear_score_fixed(spark, folder):
    rows = svm.linear_score(_scored(spark, folder), EXAMPLE_WEIGHTS)
    return _show(rows.where("prediction > 0").select("station", "valid", "score", "prediction"))


def auroc_hard(spark, folder):
    rows = svm.linear_score(svm.labelled(_scored(spark, folder)), EXAMPLE_WEIGHTS)
    return _show(svm.hard_auroc(rows))


def train_gate(spark, folder):
    return svm.train_gate(svm.labelled(_scored(spark, folder)))


def svm_fit_predict(spark, folder):
    columns = ["station", "valid", "label", "score", "prediction"]
    found = supervised.run_batch(_timed(spark, folder))
    if found is None:
        nothing = svm.linear_score(svm.labelled(_scored(spark, folder)), EXAMPLE_WEIGHTS)
        return _show(nothing.where(F.lit(False)).select(*columns))
    return _show(found.predictions.select(*columns))


def kmeans_assign(spark, folder):
    return _show(kmeans.assign(kmeans.feature_rows(_scored(spark, folder)), EXAMPLE_CENTRES))


def kmeans_distance_anomaly(spark, folder):
    # Read twice, for the moments and for the flags, so scored only once.
    scored = materialise(_scored(spark, folder), "scored")
    rows = kmeans.assign(kmeans.feature_rows(scored), EXAMPLE_CENTRES)
    return _show(kmeans.distance_anomalies(rows).select("station", "valid", "distance", "distance_z", "anomaly"))


def kmeans_distance_stats(spark, folder):
    rows = kmeans.assign(kmeans.feature_rows(_scored(spark, folder)), EXAMPLE_CENTRES)
    return _show(kmeans.distance_stats(rows))


def kmeans_step(spark, folder):
    rows = kmeans.assign(kmeans.feature_rows(_scored(spark, folder)), EXAMPLE_CENTRES)
    return _show(kmeans.updated_centres(rows, EXAMPLE_CENTRES, decay=0.5))


def top_anomalies(spark, folder):
    rows = filters.beyond(_scored(spark, folder), 2.0)
    order = [F.abs(steady_round(F.col("z_score"), PLACES)).desc(), F.col("station"), F.col("valid")]
    return _show(scoring.top_rows(rows, order).select("station", "valid", "temp", "avg_temp", "stddev_temp", "z_score"))


def access_log_parse(spark, folder):
    return wall_clock(access_log.parse_lines(log_lines_from_events(_events(spark, folder))))


STREAM_COLUMNS = ["station", "valid", "tmpf", "relh", "vsby"]


def _replayed(spark, folder, build, slices=2):
    return replayed(_clean(spark, folder).select(*STREAM_COLUMNS), "valid", build, slices)


def stream_weekly(spark, folder):
    return _show(_replayed(spark, folder, lambda s: stream_windows.weekly(s, delay="15 minutes")))


def stream_trailing_mean(spark, folder):
    columns = ["station", "valid", "window_start", "temp", "relh_avg", "vsby_avg"]
    return _show(_replayed(spark, folder, stream_windows.short_term).select(*columns))


def stream_zscore_join(spark, folder):
    return _show(_replayed(spark, folder, stream_windows.scored))


def stream_window_outliers(spark, folder):
    """Rows joined with the closed aggregate of their own window."""
    events = _events(spark, folder).select("event_id", F.col("ts").cast("timestamp").alias("ts"), "value")
    found = replayed(events, "ts", lambda s: stream_windows.window_outliers(s, "ts", "value", 6 * 3600), 3)
    return _show(found)


def stream_window_standardise(spark, folder):
    rows = _clean(spark, folder).select("event_id", "valid", *MEASURED)
    found = replayed(rows, "valid", lambda s: stream_windows.standardise(s, "valid", MEASURED, seconds=6 * 3600), 2)
    return _show(found.select("event_id", "window_start", *[f"{c}_norm" for c in MEASURED]))


def _temperatures(spark, folder):
    return _timed(spark, folder).select("station", "valid", F.col("tmpf").try_cast("double").alias("tmpf"))


def stream_two_hour_lists(spark, folder):
    """Lists of closed windows, from a state of counted values."""
    return _stream_lists(spark, folder, windows.LIST_PAGE)


def stream_two_hour_list_pages(spark, folder):
    """The same lists in pages of two, so that most windows have several."""
    return _stream_lists(spark, folder, 2)


def _stream_lists(spark, folder, page_rows):
    out, checkpoint = shared_folder(spark, "lists"), shared_folder(spark, "checkpoint")

    def run(stream):
        group = ["station", "window_start", "window_end"]
        return stream_windows.to_lists(stream_windows.value_counts(stream), out, checkpoint, group, page_rows)

    replay(_temperatures(spark, folder), "valid", run, 2)
    lists = BatchStore(spark, out).read()
    return wall_clock(lists.select("station", "window_start", "window_end", "page", _listed("values")))


def stream_two_hour_exploded(spark, folder):
    """The same windows expanded to rows with their comparison dates."""
    rows = _clean(spark, folder).select("station", "valid", "tmpf")
    return _show(replayed(rows, "valid", stream_windows.two_hour_rows, 2))


def stream_distinct(spark, folder):
    """A table that holds every row twice, taken from a stream once."""
    events = _events(spark, folder).withColumn("ts", F.col("ts").cast("timestamp"))
    return wall_clock(replayed(events.union(events), "ts", lambda s: stream_windows.distinct(s, "ts"), 3))


def stream_paced(spark, folder):
    """A table sent at a set pace, batch by batch; the union of the batches is the table."""
    raw = _raw(spark, folder)
    rows = raw.count()
    out, checkpoint = shared_folder(spark, "paced"), shared_folder(spark, "checkpoint")
    with state_partitions(spark):
        await_rows(to_batches(paced(raw, max(1, rows // 4)), out, checkpoint, seconds=1), rows)
    numbers = ["tmpf", "dwpf", "relh", "feel", "drct", "sped", "alti", "vsby"]
    sent = BatchStore(spark, out).read().select("event_id", *FIELDS)
    return wall_clock(sent.withColumn("valid", parse_valid("valid")).withColumns({c: F.col(c).try_cast("double") for c in numbers}))


def stream_count_sorted(spark, folder):
    """Complete mode: an ordered aggregate rewritten per batch, read from its last snapshot."""
    events = _events(spark, folder).select("event_id", "event_type")
    stream = stream_parquet(spark, write_shared(events, "in"), events.schema)
    out, checkpoint = shared_folder(spark, "snapshots"), shared_folder(spark, "checkpoint")
    with state_partitions(spark):
        query = to_snapshots(windows.count_by(stream, "event_type"), out, checkpoint)
    query.awaitTermination()
    return read_snapshot(spark, out)


def stream_range_join(spark, folder):
    """Sliding weeks of a stream kept as a table by key, and the stream compared with it."""
    rows = _clean(spark, folder).select(*STREAM_COLUMNS)
    source = write_shared(rows, "in")
    weeks, out = shared_folder(spark, "weeks"), shared_folder(spark, "out")
    for run, target in ((exploration.run_baseline_stream, [weeks]), (exploration.run_compare_stream, [weeks, out])):
        stream = stream_parquet(spark, source, rows.schema)
        with state_partitions(spark):
            query = run(stream, *target, shared_folder(spark, "checkpoint"), seconds=None)
        query.awaitTermination()
    return _show(BatchStore(spark, out).read().drop("batch_id"))


def anomaly_log(spark, folder):
    """Flags appended batch by batch as text with a header; the log is the union of its batches."""
    scored = _scored(spark, folder)
    stream = stream_parquet(spark, write_shared(scored, "in"), scored.schema)
    out, checkpoint = shared_folder(spark, "log"), shared_folder(spark, "checkpoint")

    def handle(batch, batch_id):
        flagged = unsupervised.detect(batch, EXAMPLE_CENTRES)
        BatchStore(batch.sparkSession, out, "csv").write(unsupervised.log_lines(flagged), batch_id)

    for_each_batch(stream, handle, checkpoint).awaitTermination()
    log = BatchStore(spark, out, "csv").read()
    values = [F.col(c).cast("double").alias(c) for c in kmeans.FEATURES]
    return _show(log.select("station", F.col("valid").cast("timestamp"), *values, F.col("prediction").cast("boolean")))


def supervised_log(spark, folder):
    """Rows the classifier flags in a batch of a stream, written by batch and read back.

    Half a deviation labels a row here: with two, so few rows are positive that none is flagged.
    """
    scored = _scored(spark, folder)
    stream = stream_parquet(spark, write_shared(scored, "in"), scored.schema)
    out, checkpoint = shared_folder(spark, "flagged"), shared_folder(spark, "checkpoint")

    def handle(batch, batch_id):
        supervised.detect(batch, BatchStore(batch.sparkSession, out), batch_id, LOG_THRESHOLD)

    for_each_batch(stream, handle, checkpoint).awaitTermination()
    columns = ["station", "valid", "label", "score", "prediction"]
    store = BatchStore(spark, out)
    if not store.batches():
        nothing = svm.linear_score(svm.labelled(scored, LOG_THRESHOLD), EXAMPLE_WEIGHTS).where(F.lit(False))
        return _show(nothing.select(*columns))
    return _show(store.read().select(*columns))


def stream_kmeans(spark, folder):
    """The whole unsupervised job over a replay; its centres move with each batch of closed windows."""
    raw = _timed(spark, folder)
    out, model = shared_folder(spark, "log"), shared_folder(spark, "model")
    checkpoint = shared_folder(spark, "checkpoint")

    def run(stream):
        return unsupervised.run_stream(stream, out, model, checkpoint, EXAMPLE_CENTRES, decay=0.9, seconds=None)

    replay(raw.drop("event_id"), "valid", run, 2)
    log = BatchStore(spark, out, "csv").read()
    values = [F.col(c).cast("double").alias(c) for c in kmeans.FEATURES]
    return _show(log.select("station", F.col("valid").cast("timestamp"), *values, F.col("prediction").cast("boolean")))


QUERIES = {
    f.__name__: f
    for f in [
        flagship_zscore,
        zscore_anomalies,
        zscore_cold_start,
        json_roundtrip,
        pattern_valid,
        reformatted_valid,
        csv_roundtrip,
        impute_sentinels,
        encode_sky,
        encode_station,
        scale_measurements,
        feature_engineering,
        day_rows,
        night_rows,
        recent_week,
        aligned_rows,
        count_by_topic_sorted,
        window_count,
        window_mean,
        window_stats,
        window_outliers_1sigma,
        weekly_day,
        weekly_night,
        weekly_day_night,
        sliding_week,
        trailing_week,
        trailing_week_events,
        two_hour_lists,
        two_hour_exploded,
        range_join_compare,
        range_join_anomalies,
        trailing_mean_range,
        trailing_mean_window,
        window_standardise,
        standard_scale,
        mean_impute,
        svm_features,
        hash_split,
        linear_score_fixed,
        auroc_hard,
        train_gate,
        svm_fit_predict,
        kmeans_assign,
        kmeans_distance_anomaly,
        kmeans_distance_stats,
        kmeans_step,
        top_anomalies,
        access_log_parse,
        stream_weekly,
        stream_trailing_mean,
        stream_zscore_join,
        stream_window_outliers,
        stream_window_standardise,
        stream_two_hour_lists,
        stream_two_hour_list_pages,
        stream_two_hour_exploded,
        stream_distinct,
        stream_paced,
        stream_count_sorted,
        stream_range_join,
        anomaly_log,
        supervised_log,
        stream_kmeans,
    ]
}
