from datetime import datetime

import pytest
from pyspark.sql import functions as F

from obsflow.operators.clean import to_messages
from obsflow.schema import FIELDS, RAW_SCHEMA
from obsflow.session import MIB, shared_folder, sizing
from obsflow.sources import access_log, files, kafka
from obsflow.sources.events import log_lines_from_events, observations_from_events

# Invented lines, with addresses reserved for documentation.
LINES = [
    '192.0.2.17 - - [03/Mar/2021:23:10:05 +0330] "POST /basket/add?item=7 HTTP/1.1" 200 512 "https://shop.example/list" "Browser/1.0 (Desk)" "-"',
    '192.0.2.99 - - [03/Mar/2021:08:01:44 +0000] "GET /search/tea|green a,b HTTP/1.1" 304 - "-" "Crawler/2.5" "-"',
    '2001:db8::5 - - [04/Mar/2021:00:00:00 +0000] "GET /s?q=\\"x\\" HTTP/1.1" 200 171 "-" "say \\"hi\\"" "-"',
]
BROKEN = [
    "not a log line",
    None,
    'garbage "a" "b" "c" "d" "e" f',
    '192.0.2.17 - - [31/Foo/2021:23:10:05 +0330] "GET / HTTP/1.1" 200 5 "-" "x" "-"',
    '192.0.2.17 - - [03/Mar/2021:23:10:05 +0330] "GET / HTTP/1.1" ok 5 "-" "x" "-"',
    "\u0001".join(["192.0.2.17", "03/Mar/2021:23:10:05 +0330", "GET / HTTP/1.1", "200", "5", "-", "x"]),
]


def test_access_log_lines(spark):
    df = spark.createDataFrame([(line,) for line in LINES + BROKEN], "value string")
    first, second, third, *broken = access_log.parse_lines(df).collect()
    assert tuple(first) == (
        "192.0.2.17", datetime(2021, 3, 3, 19, 40, 5), "POST", "/basket/add?item=7", 200, 512,
        "https://shop.example/list", "Browser/1.0 (Desk)",
    )
    assert second["path"] == "/search/tea|green a,b" and second["response_size"] is None and second["status"] == 304
    assert second["ts"] == datetime(2021, 3, 3, 8, 1, 44)
    assert (third["ip"], third["path"], third["status"], third["response_size"]) == ("2001:db8::5", '/s?q=\\"x\\"', 200, 171)
    assert third["agent"] == 'say \\"hi\\"' and third["referer"] == "-"
    assert len(broken) == len(BROKEN) and all(v is None for row in broken for v in row)


def test_separator_inside_a_line_is_data(spark):
    paths = ["item=\u00017", "\u0002a\u0001\u0002\u0002b", "\u0002", '\\\u0001\\"']
    lines = [(LINES[0].replace("item=7", path),) for path in paths]
    rows = access_log.parse_lines(spark.createDataFrame(lines, "value string")).collect()
    assert [(r["ip"], r["path"], r["status"]) for r in rows] == [("192.0.2.17", f"/basket/add?{path}", 200) for path in paths]


def test_access_log_files(spark, tmp_path):
    (tmp_path / "a.log").write_text("\n".join([*LINES[:2], BROKEN[0]]))
    assert access_log.read_access_log(spark, str(tmp_path)).where("ip is not null").count() == 2
    assert access_log.stream_access_log(spark, str(tmp_path)).isStreaming


def test_csv_by_position(spark, tmp_path):
    (tmp_path / "in.csv").write_text(
        ",".join(f"c{i}" for i in range(16)) + "\nXYZ,2021-05-06 07:08,50.5,40.0,60.00,50.10,90.0,3.2,30.01,-1.0,0.00,9.0,FEW,2100.0,M,M\n"
    )
    row = files.read_csv(spark, str(tmp_path)).first()
    assert row["station"] == "XYZ" and row["mslp"] == "-1.0" and row["ice_acceretion_1hr"] == "M"
    assert files.stream_csv(spark, str(tmp_path)).schema == RAW_SCHEMA


def test_messages_on_disk(spark):
    df = spark.createDataFrame([[f if f != "valid" else "2021-05-06 07:08" for f in FIELDS]], RAW_SCHEMA)
    path = shared_folder(spark, "messages")
    to_messages(df).write.text(path)
    assert files.read_messages(spark, path).count() == 1
    assert files.stream_messages(spark, path, 1).isStreaming


def test_kafka_options():
    source = kafka.source_options("h:1", group="g", per_trigger=500)
    assert source == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "topic_test1", "startingOffsets": "latest", "kafka.group.id": "g",
        "maxOffsetsPerTrigger": "500",
    }
    assert kafka.sink_options("h:1", "t") == {"kafka.bootstrap.servers": "h:1", "topic": "t"}


def test_event_adapters(spark):
    events = spark.createDataFrame(
        [(69, "2024-01-01 00:07:31", 14, "view", 6.55, '{"k": 60}')],
        "event_id long, ts string, user_id long, event_type string, value double, props string",
    ).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    row = observations_from_events(events).first()
    assert tuple(row[f] for f in FIELDS) == (
        "MVL", "2024-01-01 00:05", "6.55", "40", "60", "65", "140", "0", "29", "-1.0", "0.00", "5", "M", "M", "M", "0.01",
    )
    log = access_log.parse_lines(log_lines_from_events(events)).first()
    assert (log["ip"], log["request_type"], log["response_size"]) == ("10.0.0.14", "POST", 655)


def test_shared_folder_needs_a_setting_on_a_cluster(spark):
    class Elsewhere:
        class conf:
            @staticmethod
            def get(key, default=None):
                return default

        class sparkContext:
            master = "yarn"

    with pytest.raises(ValueError):
        shared_folder(Elsewhere, "x")
    assert shared_folder(spark, "x") != shared_folder(spark, "x")


def test_sizing_follows_the_data():
    small = sizing(10 * MIB, 8)
    assert small["spark.sql.files.maxPartitionBytes"] == str(128 * MIB)
    assert small["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] == "8"
    large = sizing(100 * MIB * MIB, 4000)
    assert large["spark.sql.files.maxPartitionBytes"] == str(1024 * MIB)
    assert large["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] == str(100 * MIB * MIB // (256 * MIB))
