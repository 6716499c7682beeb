"""Timestamp expressions. Sessions run in UTC, so days start at multiples of 86,400 s."""

from __future__ import annotations

from pyspark.sql import functions as F

DAY = 86400
WEEK = 7 * DAY
TWO_HOURS = 7200
QUARTER_HOUR = 900

VALID_FORMAT = "yyyy-MM-dd HH:mm"
VALID_FORMAT_SECONDS = "yyyy-MM-dd HH:mm:ss"


def parse_valid(column="valid", pattern=None):
    """Observation time from text; null where it is none.

    Without a pattern the text is cast, with or without seconds: several times
    faster than matching a pattern, which also refuses dates without a time.
    """
    c = F.col(column) if isinstance(column, str) else column
    return F.try_to_timestamp(c, F.lit(pattern)) if pattern else c.try_cast("timestamp")


def reformat_valid(column="valid"):
    """Observation time rewritten with seconds."""
    return F.date_format(parse_valid(column), VALID_FORMAT_SECONDS)


def epoch(column):
    """Whole seconds since 1970."""
    return F.unix_seconds(F.col(column) if isinstance(column, str) else column)


def day_number(column):
    """Days since 1970."""
    return F.floor(epoch(column) / F.lit(DAY))


def shift(column, seconds):
    """The timestamp moved by a constant number of seconds."""
    return column + F.expr(f"INTERVAL {int(seconds)} SECONDS")


def on_grid(column, seconds=QUARTER_HOUR):
    """True where the time is a whole multiple of the grid."""
    return epoch(column) % F.lit(seconds) == 0


def interval_text(seconds):
    """A window duration as Spark reads it."""
    return f"{int(seconds)} seconds"


def wall_clock(df):
    """Show every date and timestamp as the UTC wall clock, without a zone."""
    kinds = ("timestamp", "date")
    return df.select(
        *[F.col(name).cast("timestamp_ntz").alias(name) if kind in kinds else F.col(name) for name, kind in df.dtypes]
    )
