"""The jobs from the command line: ``python -m obsflow JOB ...``, or through spark-submit."""

from __future__ import annotations

import argparse
import logging

from obsflow.operators.clean import observations, with_valid
from obsflow.plans import exploration, supervised, unsupervised
from obsflow.session import build_session, tidy, tune
from obsflow.sources import files, kafka
from obsflow.streaming.sinks import late_counter
from obsflow.streaming.store import BatchStore


def parser():
    """The commands and their options."""
    top = argparse.ArgumentParser(prog="obsflow")
    jobs = top.add_subparsers(dest="job", required=True)

    send = jobs.add_parser("publish", help="send a CSV file's observations to Kafka as JSON")
    send.add_argument("--csv", required=True)
    send.add_argument("--servers", required=True)
    send.add_argument("--topic", default=kafka.TOPIC)

    for name, text in (
        ("supervised", "score a stream and flag rows with a classifier trained per batch"),
        ("unsupervised", "score a stream and flag rows far from moving centres"),
        ("baselines", "keep the sliding weeks of a stream as a table"),
        ("compare", "flag two-hour rows against that table"),
    ):
        job = jobs.add_parser(name, help=text)
        source = job.add_mutually_exclusive_group(required=True)
        source.add_argument("--servers", help="Kafka servers")
        source.add_argument("--json", help="folder of JSON messages, one a line")
        source.add_argument("--csv", help="folder of CSV files")
        job.add_argument("--topic", default=kafka.TOPIC)
        job.add_argument("--group", help="Kafka consumer group; without it, Spark names one per query")
        job.add_argument("--per-trigger", type=int, help="at most so many Kafka offsets in a batch")
        job.add_argument(
            "--files-per-trigger",
            type=int,
            help="at most so many files in a batch, oldest file first; rows of a later batch that are behind the watermark are dropped",
        )
        job.add_argument("--checkpoint", help="folder of the stream's progress; needed unless --batch")
        job.add_argument("--seconds", type=int, help="trigger; without it, take what there is and stop")
        if name != "baselines":
            job.add_argument("--out", required=True)
        if name in ("supervised", "unsupervised"):
            job.add_argument("--delay", default="15 minutes", help="how late rows may come")
            job.add_argument("--batch", action="store_true", help="take the files as one table, without a stream")
        if name == "unsupervised":
            job.add_argument("--model", required=True, help="folder of the centres")
            job.add_argument("--decay", type=float, default=1.0)
        if name in ("baselines", "compare"):
            job.add_argument("--weeks", required=True, help="folder of the sliding weeks")
    return top


def source(spark, args):
    """The stream of observations a command names."""
    if args.csv:
        return with_valid(files.stream_csv(spark, args.csv, files_per_trigger=args.files_per_trigger))
    if args.json:
        return observations(files.stream_messages(spark, args.json, args.files_per_trigger))
    return observations(kafka.read_kafka(spark, args.servers, args.topic, args.group, per_trigger=args.per_trigger))


def start(spark, args):
    """Start the command's query."""
    rows = source(spark, args)
    if args.job == "supervised":
        return supervised.run_stream(rows, args.out, args.checkpoint, args.seconds, args.delay)
    if args.job == "unsupervised":
        return unsupervised.run_stream(
            rows, args.out, args.model, args.checkpoint, decay=args.decay, seconds=args.seconds, delay=args.delay
        )
    measured = exploration.measured(rows)
    if args.job == "baselines":
        return exploration.run_baseline_stream(measured, args.weeks, args.checkpoint, args.seconds)
    return exploration.run_compare_stream(measured, args.weeks, args.out, args.checkpoint, args.seconds)


def run_table(spark, args):
    """A detection job over whole files: flagged rows, and the moved centres, as batch 0 of their folders.

    Split and shuffle sizes follow the bytes of the files, and tables written on the way are deleted.
    """
    tune(spark, args.csv or args.json)
    rows = with_valid(files.read_csv(spark, args.csv)) if args.csv else observations(files.read_messages(spark, args.json))
    with tidy(spark):
        if args.job == "supervised":
            return supervised.run_batch(rows, args.out)
        flagged, centres = unsupervised.run_batch(rows, decay=args.decay)
        BatchStore(spark, args.out, "csv").write(unsupervised.log_lines(flagged), 0)
        unsupervised.save_centres(spark, BatchStore(spark, args.model), centres, 0)
        return centres


def main(argv=None):
    """Run one command to its end."""
    top = parser()
    args = top.parse_args(argv)
    batch = getattr(args, "batch", False)
    if batch and args.servers:
        top.error("--batch takes files")
    if args.job != "publish" and not batch and not args.checkpoint:
        top.error("--checkpoint is needed")
    spark = build_session(f"obsflow-{args.job}")
    if args.job == "publish":
        kafka.publish(files.read_csv(spark, args.csv), args.servers, args.topic)
    elif batch:
        run_table(spark, args)
    else:
        with late_counter(spark) as late:
            start(spark, args).awaitTermination()
        if late.rows:
            logging.getLogger("obsflow").warning("%d rows came behind the watermark and were dropped", late.rows)


if __name__ == "__main__":
    main()
