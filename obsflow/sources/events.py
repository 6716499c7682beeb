"""Observations and log lines derived from the event table, row by row."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from obsflow.functions.time import VALID_FORMAT
from obsflow.schema import FIELDS, MISSING_TEXT, SKY_CODES, STATION_CODES

FIVE_MINUTES = 300


def read_events(spark, folder):
    """The event table."""
    return spark.read.parquet(os.path.join(folder, "events.parquet"))


def pick(labels, position):
    """A label by its position in a constant list."""
    return F.element_at(F.array(*[F.lit(x) for x in labels]), (position + 1).cast("int"))


def observations_from_events(events):
    """The 16 text fields of an observation, each a plain function of its event."""
    k = F.get_json_object("props", "$.k").cast("long")
    at = F.unix_seconds(F.col("ts").cast("timestamp"))
    floored = F.timestamp_seconds(at - F.pmod(at, F.lit(FIVE_MINUTES)))
    fields = {
        "station": pick(STATION_CODES, F.col("user_id") % len(STATION_CODES)),
        "valid": F.date_format(floored, VALID_FORMAT),
        "tmpf": F.col("value"),
        "dwpf": k - 20,
        "relh": k,
        "feel": k + 5,
        "drct": (F.col("user_id") * 10) % 360,
        "sped": k % 30,
        "alti": F.lit(29),
        "mslp": F.when(k % 4 == 0, F.lit("-1.0")).otherwise((k % 40 + 1000).cast("string")),
        "p01m": F.lit("0.00"),
        "vsby": k % 11,
        "skyc1": pick([*SKY_CODES, MISSING_TEXT], F.col("event_id") % (len(SKY_CODES) + 1)),
        "skyl1": F.when(k % 5 == 0, F.lit(MISSING_TEXT)).otherwise((k * 100).cast("string")),
        "wxcodes": F.when(k % 3 == 0, F.lit(MISSING_TEXT)).otherwise(k.cast("string")),
        "ice_acceretion_1hr": F.when(F.col("event_id") % 10 < 9, F.lit(MISSING_TEXT)).otherwise(F.lit("0.01")),
    }
    return events.select("event_id", *[fields[f].cast("string").alias(f) for f in FIELDS])


def log_lines_from_events(events):
    """One access-log line per event, in a column ``value``.

    Some agents hold escaped quotes, some paths the character U+0001, and some lines are no
    log lines: their status is a word, or they are fields with U+0001 between.
    """
    user, number, size = F.col("user_id"), F.col("event_id"), F.floor(F.col("value") * 100)
    at = F.date_format(F.col("ts").cast("timestamp"), "dd/MMM/yyyy:HH:mm:ss")
    address = F.concat(F.lit("10.0."), F.floor(user / 256), F.lit("."), user % 256)
    agent = F.when(number % 11 == 3, F.concat(F.lit('say \\"'), user % 7, F.lit('\\"'))).otherwise(
        F.concat(F.lit("agent/"), user % 7)
    )
    line = F.concat(
        address, F.lit(" - - ["), at, F.lit(" +0330] \""),
        pick(["GET", "POST", "HEAD", "OPTIONS"], number % 4),
        F.lit(" /"), F.col("event_type"), F.when(number % 17 == 4, F.lit("\u0001")).otherwise(F.lit("?")),
        F.lit("id="), number, F.lit(" HTTP/1.1\" "),
        F.when(number % 13 == 5, F.lit("ok")).otherwise(pick(["200", "404"], number % 2)),
        F.lit(" "), size, F.lit(" \"-\" \""), agent, F.lit("\" \"-\""),
    )
    fields = F.concat_ws("\u0001", address, F.concat(at, F.lit(" +0330")), F.lit("GET / HTTP/1.1"), F.lit("200"), size, F.lit("-"), F.lit("x"))
    return events.select(F.when(number % 19 == 6, fields).otherwise(line).alias("value"))
