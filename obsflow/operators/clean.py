"""From messages to clean, encoded and scaled observations."""

from __future__ import annotations

from pyspark.sql import functions as F

from obsflow.functions.scalar import encode, number, replace_missing, replace_missing_pressure
from obsflow.functions.time import parse_valid
from obsflow.schema import DIVISORS, FIELDS, RAW_SCHEMA, REPLACEMENTS, SKY_CODES, STATION_CODES

ENVELOPE = {"key": "event_key", "topic": "event_topic", "timestamp": "event_timestamp"}


def bytes_to_string(df, columns=("key", "value")):
    """Kafka's binary key and value as text."""
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


def parse_json(df, column="value", schema=RAW_SCHEMA):
    """The JSON text as a struct; a malformed message becomes a struct of nulls."""
    return df.withColumn(column, F.from_json(F.col(column), schema))


def flatten(df, column="value", envelope=True):
    """One column per field, the message envelope in front of them where there is one."""
    head = [F.col(c).alias(name) for c, name in ENVELOPE.items() if envelope and c in df.columns]
    return df.select(*head, *[F.col(f"{column}.{f}").alias(f) for f in FIELDS])


def observations(df):
    """Parsed observations from a frame of messages, ``valid`` as a timestamp."""
    return with_valid(flatten(parse_json(bytes_to_string(df, [c for c in ("key", "value") if c in df.columns]))))


def with_valid(df, column="valid", pattern=None):
    """The observation time as a timestamp, by cast or by a pattern."""
    return df.withColumn(column, parse_valid(column, pattern))


def to_messages(df, key=None, topic=None):
    """Observations as JSON messages, ready for a Kafka sink."""
    fields = [F.col(f) for f in FIELDS if f in df.columns]
    out = [F.to_json(F.struct(*fields)).alias("value")]
    if key is not None:
        out.insert(0, F.lit(key).alias("key"))
    if topic is not None:
        out.append(F.lit(topic).alias("topic"))
    return df.select(*out)


def imputed(name, replacements=REPLACEMENTS):
    """A field with its sentinel replaced."""
    if name not in replacements:
        return F.col(name)
    rule = replace_missing_pressure if name == "mslp" else replace_missing
    return rule(name, replacements[name])


def impute(df, replacements=None):
    """Replace sentinels; only columns the frame has are touched."""
    wanted = {**REPLACEMENTS, **(replacements or {})}
    return df.withColumns({c: imputed(c, wanted) for c in df.columns if c in wanted})


def encode_sky(df, column="skyc1", codes=SKY_CODES):
    """Sky cover labels as codes."""
    return df.withColumn(column, encode(column, codes))


def encode_station(df, column="station", codes=STATION_CODES):
    """Station labels as codes."""
    return df.withColumn(column, encode(column, codes))


def scale(df, divisors=DIVISORS):
    """Measured columns as doubles over their divisor."""
    return df.withColumns({c: number(c) / F.lit(float(divisors[c])) for c in df.columns if c in divisors})


def feature_engineering(df, replacements=None, sky_codes=SKY_CODES, station_codes=STATION_CODES, divisors=DIVISORS):
    """Impute, encode and scale in one projection; columns nothing reads are pruned from it."""
    wanted = {**REPLACEMENTS, **(replacements or {})}
    codes = {"skyc1": sky_codes, "station": station_codes}
    out = []
    for name in df.columns:
        c = imputed(name, wanted)
        if name in codes:
            c = encode(c, codes[name])
        if name in divisors:
            c = number(c) / F.lit(float(divisors[name]))
        out.append(c.alias(name))
    return df.select(*out)


def impute_mean(df, column, marker=None):
    """Replace readings that are no number, or equal the marker, by the column mean.

    The mean is one value, read as a scalar subquery.
    """
    value = number(column)
    if marker is not None:
        value = F.when(value != F.lit(float(marker)), value)
    mean = df.agg(F.avg(value).alias("mean")).scalar()
    return df.withColumn(column, F.coalesce(value, mean))
