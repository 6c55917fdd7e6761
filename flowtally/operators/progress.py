"""Queue reading progress: lag per partition and the event day it has reached."""

from pyspark.sql import functions as F

from flowtally.functions import timekeys
from flowtally.sources import archive

# Rows an offset table may have to be sent to every executor.
BROADCAST_PARTITIONS = 100_000


def lag(offsets):
    """Reading position moved up to the first kept message, and the backlog after it."""
    position = F.greatest("offset", "startOffset")
    return offsets.select(
        "partition", "startOffset", "lastOffset",
        position.alias("offset"),
        (F.col("offset") < F.col("startOffset")).alias("clamped"),
        F.greatest(F.col("lastOffset") - position, F.lit(0)).alias("backlog"),
        (position < F.col("lastOffset")).alias("has_new"),
    )


def reached(messages, offsets):
    """Per partition the message at the committed offset, or the next one still kept.

    Two passes over ``messages``: the first reads partition and offset only,
    the second picks one message per partition. Whatever is derived from the
    message text afterwards is derived for these few.
    """
    committed = offsets.select("partition", F.col("offset").alias("committed"))
    small = committed.count() <= BROADCAST_PARTITIONS

    def few(table):
        return F.broadcast(table) if small else table

    ahead = messages.select("partition", "offset").join(few(committed), "partition").filter(
        "offset >= committed")
    wanted = ahead.groupBy("partition", "committed").agg(F.min("offset").alias("offset"))
    return messages.join(few(wanted), ["partition", "offset"])


def reached_day(messages, offsets, tz=timekeys.DEFAULT_TZ):
    """Per partition the event day of the message at the committed offset."""
    dated = archive.with_event_day(reached(messages, offsets), tz)
    return dated.select("partition", "committed", "offset", F.col("day").cast("bigint").alias("day"))
