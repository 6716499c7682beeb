"""Kafka in and out. Needs Spark's Kafka connector on the class path."""

from __future__ import annotations

from obsflow.operators.clean import to_messages
from obsflow.schema import MESSAGE_KEY

# Fixed value: the topic of the jobs.
TOPIC = "topic_test1"


def source_options(servers, topic=TOPIC, group=None, starting="latest", per_trigger=None, extra=None):
    """Options of a Kafka source. Offsets live in the query's checkpoint, never in the group."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting}
    if group:
        options["kafka.group.id"] = group
    if per_trigger:
        options["maxOffsetsPerTrigger"] = str(per_trigger)
    options.update(extra or {})
    return options


def sink_options(servers, topic=None, extra=None):
    """Options of a Kafka sink."""
    options = {"kafka.bootstrap.servers": servers}
    if topic:
        options["topic"] = topic
    options.update(extra or {})
    return options


def read_kafka(spark, servers, topic=TOPIC, group=None, starting="latest", per_trigger=None, extra=None):
    """A stream of Kafka rows: binary key and value, topic and timestamp among them."""
    options = source_options(servers, topic, group, starting, per_trigger, extra)
    return spark.readStream.format("kafka").options(**options).load()


def read_kafka_batch(spark, servers, topic=TOPIC, starting="earliest", extra=None):
    """What a topic holds now, as a batch."""
    return spark.read.format("kafka").options(**source_options(servers, topic, starting=starting, extra=extra)).load()


def publish(df, servers, topic=TOPIC, key=MESSAGE_KEY, checkpoint=None):
    """Send observations as JSON messages: a batch at once, a stream as it comes.

    Returns the streaming query for a stream.
    """
    messages = to_messages(df, key)
    options = sink_options(servers, topic)
    if df.isStreaming:
        return (
            messages.writeStream.format("kafka").options(**options).option("checkpointLocation", checkpoint).start()
        )
    messages.write.format("kafka").options(**options).save()
    return None
