"""Raw message archive: text lines below ``run=/batch_id=/topic=/day=``.

Batches and streams write the same layout. A batch owns its folder and replaces
it as a whole, so a repeated batch changes nothing, whatever days it meets.
"""

import uuid

from pyspark.sql import functions as F

from flowtally.functions import numbers, timekeys
from flowtally.operators.decode import decode
from flowtally.schemas import RTMP_TOPIC

# Lines and the folders they lie in.
LINES = "value string, run string, batch_id bigint, topic string, day int"

_WHOLE_SECONDS = r"^ *[+]?[0-9]{1,11} *$"
_FLOAT_SECONDS = r"^[0-9](\.[0-9]*)?[eE][+]?([0-9]|10)$|^[0-9]{1,11}\.[0-9]*$"

# The field that holds the event time, by feed.
_HLS_TIME, _RTMP_TIME = "unix_time", "EndTime"


def _timed(frame):
    """Messages with the text of their event time."""
    decoded = decode(frame, {_HLS_TIME: "string", _RTMP_TIME: "string"})
    is_rtmp = F.coalesce("topic", "key") == RTMP_TOPIC
    return decoded.withColumn(
        "_time", F.when(is_rtmp, F.col(_RTMP_TIME)).otherwise(F.col(_HLS_TIME)))


def _written_as(start):
    """Whether the value of the time field starts like this in the message."""
    return F.col("value").rlike(rf'"({_HLS_TIME}|{_RTMP_TIME})"\s*:\s*{start}')


def _placeable():
    """The message text is searched only for the rare missing or fractional times."""
    time = F.col("_time")
    return ~F.col("malformed") & (
        F.when(time.isNull(), ~_written_as("null"))
        .when(time.rlike(_WHOLE_SECONDS), True)
        .otherwise(time.rlike(_FLOAT_SECONDS) & ~_written_as('"'))
    )


def _event_day(tz):
    seconds = F.coalesce(numbers.epoch_seconds(F.col("_time")), F.unix_timestamp())
    day = timekeys.day_of(timekeys.hour_key(F.col("_local"))).cast("int")
    return timekeys.local_seconds(seconds, tz).alias("_local"), day.alias("day")


def with_event_day(frame, tz=timekeys.DEFAULT_TZ):
    """Add ``day`` from the event time of each message.

    A message without the field gets today's day. ``day`` is NULL where the
    value is not one JSON object or its time is not whole seconds; a fraction
    is cut off a JSON number but makes JSON text unusable, and so does null.
    """
    local, day = _event_day(tz)
    usable_local = F.when(_placeable(), local).alias("_local")
    return _timed(frame).select(*frame.columns, usable_local).select(*frame.columns, day)


def rejects(frame):
    """Messages the archive cannot place."""
    return _timed(frame).filter(~_placeable()).select(
        *frame.columns, F.lit("no_event_day").alias("reject"))


def _lines(frame, tz):
    """Archivable lines; line breaks between JSON tokens become blanks.

    The filter looks at the parsed text alone, so that the day is not worked
    out twice.
    """
    local, day = _event_day(tz)
    placed = _timed(frame).filter(_placeable()).select(
        "value", F.coalesce("topic", "key").alias("topic"), local)
    return placed.select(F.translate("value", "\r\n", "  ").alias("value"), "topic", day)


def positioned_lines(frame, tz=timekeys.DEFAULT_TZ):
    """Archivable lines with their place in the queue: value, partition, offset, timestamp, topic, day."""
    local, day = _event_day(tz)
    place = ["partition", "offset", "timestamp"]
    placed = _timed(frame).filter(_placeable()).select("value", *place, F.coalesce("topic", "key").alias("topic"), local)
    return placed.select("value", *place, "topic", day)


def _folder(path, run, batch_id):
    return f"{path}/run={run}/batch_id={batch_id}"


def write(frame, path, tz=timekeys.DEFAULT_TZ, gather=True, run=None, batch_id=0):
    """Archive a batch of messages, replacing an earlier attempt at the same run and batch.

    Lines are gathered by topic and day into few files; a large day is split.
    ``gather=False`` lets tasks write their own rows without a shuffle, where
    each of them meets few days. Without ``run`` the batch gets a name of its own.
    """
    lines = _lines(frame, tz)
    if gather:
        lines = lines.hint("rebalance", "topic", "day")
    (
        lines.write.mode("overwrite").option("partitionOverwriteMode", "static")
        .partitionBy("topic", "day").text(_folder(path, run or uuid.uuid4().hex, batch_id))
    )


def write_stream(frame, path, checkpoint, run, rejects_path=None, tz=timekeys.DEFAULT_TZ, **trigger):
    """Archive a stream in the layout of :func:`write`; unplaceable messages go to ``rejects_path``.

    ``run`` names the life of one checkpoint, as batch numbers restart with a new one.
    """
    def store(batch, batch_id):
        write(batch, path, tz, run=run, batch_id=batch_id)
        if rejects_path is not None:
            rejects(batch).write.mode("overwrite").parquet(_folder(rejects_path, run, batch_id))

    return (
        frame.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "300 seconds"})).start()
    )


def read(spark, path):
    """All archived lines with topic and day."""
    return spark.read.schema(LINES).text(path)


def replay(spark, path, topic, day):
    """One archived day of a topic as a common frame; only its folder is read."""
    lines = read(spark, path).filter((F.col("topic") == topic) & (F.col("day") == day))
    return lines.select(
        F.col("topic").alias("key"), "value", "topic",
        F.lit(None).cast("int").alias("partition"), F.lit(None).cast("bigint").alias("offset"),
        F.lit(None).cast("timestamp").alias("timestamp"),
    )


def replay_stream(spark, path, topic, day, max_files=None, max_bytes=4 * 2**30):
    """One archived day of a topic as a stream of the common frame, so much per micro-batch.

    Only folders of that topic and day are listed; files of attempts that did
    not end lie outside them.
    """
    reader = spark.readStream.schema(LINES).option("basePath", path)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    else:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    lines = reader.text(f"{path}/run=*/batch_id=*/topic={topic}/day={day}")
    return lines.select(
        F.lit(topic).alias("key"), "value", F.lit(topic).alias("topic"),
        F.lit(None).cast("int").alias("partition"), F.lit(None).cast("bigint").alias("offset"),
        F.lit(None).cast("timestamp").alias("timestamp"),
    )
