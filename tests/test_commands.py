import time

import pytest

from obsflow import __main__ as commands
from obsflow import session
from obsflow.operators.clean import to_messages
from obsflow.plans import exploration
from obsflow.session import shared_folder
from obsflow.sources.events import observations_from_events
from obsflow.streaming.sinks import late_counter
from obsflow.streaming.store import BatchStore

SF = "/root/testdata/sf0.001"


def test_arguments():
    args = commands.parser().parse_args(["publish", "--csv", "a.csv", "--servers", "h:1"])
    assert (args.job, args.topic) == ("publish", "topic_test1")
    with pytest.raises(SystemExit):
        commands.parser().parse_args(["supervised", "--out", "o", "--checkpoint", "c"])


def test_baselines_then_compare_from_messages(spark):
    raw = observations_from_events(spark.read.parquet(f"{SF}/events.parquet"))
    source, weeks, out = (shared_folder(spark, n) for n in ("messages", "weeks", "out"))
    to_messages(raw).write.text(source)

    def run(job, *more):
        line = [job, "--json", source, "--weeks", weeks, "--checkpoint", shared_folder(spark, "checkpoint"), *more]
        commands.start(spark, commands.parser().parse_args(line)).awaitTermination()

    run("baselines")
    run("compare", "--out", out)
    rows = exploration.measured(commands.with_valid(raw))
    table = exploration.read_weeks(spark, weeks)
    assert table.count() == exploration.sliding_week(rows).count()
    assert spark.read.parquet(out).count() == exploration.compare_anomalies(rows, table).count() > 0


@pytest.mark.parametrize("job, more", [("supervised", []), ("unsupervised", ["--model"])])
def test_detection_jobs_run_from_csv(spark, job, more):
    raw = observations_from_events(spark.read.parquet(f"{SF}/events.parquet")).drop("event_id")
    source, out = shared_folder(spark, "csv"), shared_folder(spark, "out")
    raw.write.option("header", True).csv(source)
    line = [job, "--csv", source, "--out", out, "--checkpoint", shared_folder(spark, "checkpoint")]
    line += [*more, shared_folder(spark, "model")] if more else []
    query = commands.start(spark, commands.parser().parse_args(line))
    query.awaitTermination()
    assert query.exception() is None


def test_compare_waits_for_baselines(spark):
    """Without baselines a batch fails and is taken again later: no row is lost."""
    raw = observations_from_events(spark.read.parquet(f"{SF}/events.parquet"))
    source, weeks, out, checkpoint = (shared_folder(spark, n) for n in ("messages", "weeks", "out", "checkpoint"))
    to_messages(raw).write.text(source)

    def run(job, checkpoint, *more):
        line = [job, "--json", source, "--weeks", weeks, "--checkpoint", checkpoint, *more]
        commands.start(spark, commands.parser().parse_args(line)).awaitTermination()

    with pytest.raises(Exception, match="no table"):
        run("compare", checkpoint, "--out", out)
    run("baselines", shared_folder(spark, "checkpoint"))
    run("compare", checkpoint, "--out", out)
    rows = exploration.measured(commands.with_valid(raw))
    assert spark.read.parquet(out).count() == exploration.compare_anomalies(rows, exploration.read_weeks(spark, weeks)).count() > 0


def test_files_in_reverse_order_give_the_same_rows(spark, tmp_path):
    """The newest period lies in the oldest file: nothing falls behind the watermark."""
    raw = observations_from_events(spark.read.parquet(f"{SF}/events.parquet")).drop("event_id")
    days = sorted(r[0] for r in raw.selectExpr("substr(valid, 1, 10) d").distinct().collect())
    half = days[len(days) // 2]
    found = []
    for order in (("<", ">="), (">=", "<")):
        source = str(tmp_path / f"csv{len(found)}")
        for sign in order:
            raw.where(f"substr(valid, 1, 10) {sign} '{half}'").coalesce(1).write.mode("append").option("header", True).csv(source)
            time.sleep(1.1)
        out = shared_folder(spark, "out")
        line = ["unsupervised", "--csv", source, "--out", out, "--model", shared_folder(spark, "model")]
        with late_counter(spark) as late:
            commands.start(spark, commands.parser().parse_args([*line, "--checkpoint", shared_folder(spark, "checkpoint")])).awaitTermination()
        assert late.rows == 0
        found.append(sorted(tuple(r) for r in BatchStore(spark, out, "csv").read().drop("batch_id").collect()))
    assert found[0] == found[1] and len(found[0]) > 300


@pytest.mark.parametrize("job", ["supervised", "unsupervised"])
def test_detection_jobs_run_over_whole_files(spark, tmp_path, job):
    """Results stay, tables written on the way do not, and a stream needs a checkpoint."""
    raw = observations_from_events(spark.read.parquet(f"{SF}/events.parquet")).drop("event_id")
    source, out, model = (str(tmp_path / n) for n in ("csv", "out", "model"))
    raw.write.option("header", True).csv(source)
    line = [job, "--csv", source, "--out", out, "--batch", *(["--model", model] if job == "unsupervised" else [])]
    made = len(session._intermediate)
    before = {k: spark.conf.get(k, None) for k in session.sizing(0, 1)}
    try:
        found = commands.run_table(spark, commands.parser().parse_args(line))
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    assert len(session._intermediate) == made
    if job == "unsupervised":
        store = BatchStore(spark, out, "csv")
        assert store.read().count() > 300
        assert [r.point for r in BatchStore(spark, model).read(0).orderBy("cluster").collect()] == found.points
    with pytest.raises(SystemExit):
        commands.main([x for x in line if x != "--batch"])
