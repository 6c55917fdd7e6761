"""Message archive that keeps arrival order: lines with queue partition and offset, a part per topic and day.

Every batch commits its lines in a log (:mod:`flowtally.streaming.ledger`), so a
repeated batch takes its own place. Once a day is closed, :func:`seal` merges
its parts into files that are cut and sorted by (partition, offset), by one commit.

Next to the lines lie zones: per file and queue partition the lowest and highest
offset, worked out when the file is written. They tell which file holds the
message at an offset, so that it is found without reading the others.
"""

from pyspark.sql import functions as F

from flowtally.functions import timekeys
from flowtally.sources import archive
from flowtally.streaming import ledger

LINES, ZONES = "lines", "zones"
_WHERE = "run string, batch_id bigint, attempt string, topic string, day int"
_LINES = f"value string, partition int, offset bigint, timestamp timestamp, {_WHERE}"
_ZONES = f"folder string, file string, partition int, low bigint, high bigint, {_WHERE}"


def write(log, frame, run, batch_id, tz=timekeys.DEFAULT_TZ):
    """Write a batch of messages; gives the parts of lines and zones, still to be committed."""
    lines = log.write(archive.positioned_lines(frame, tz), LINES, run, batch_id, "topic", "day")
    return lines + _write_zones(log, lines, run, batch_id)


def _write_zones(log, lines, run, batch_id):
    if not lines:
        return []
    where = log.spark.createDataFrame(
        [(part["keys"]["topic"], int(part["keys"]["day"]), part["folder"]) for part in lines],
        "topic string, day int, folder string")
    # The narrow columns of the files just written; the few folders are named by topic and day.
    zones = log.read(lines, LINES, _LINES).select(
        "topic", "day", "partition", "offset", F.col("_metadata.file_name").alias("file"))
    zones = zones.groupBy("topic", "day", "file", "partition").agg(
        F.min("offset").alias("low"), F.max("offset").alias("high")).join(where, ["topic", "day"])
    return log.write(zones.select("folder", "file", "partition", "low", "high", "topic", "day"), ZONES, run, batch_id, "topic", "day")


def keep(frame, path, run, batch_id=0, tz=timekeys.DEFAULT_TZ):
    """Archive a batch of messages in the place of an earlier attempt at it."""
    log = ledger.Ledger(frame.sparkSession, path)
    return log.commit("batch", ledger.replacing(write(log, frame, run, batch_id, tz), [LINES, ZONES], run, batch_id))


def seal(spark, path, topic, day):
    """Merge a day's parts into files in the order of (partition, offset), by one commit.

    Gives its version, or None where the day is sealed already or one of its
    batches was written anew meanwhile.
    """
    log = ledger.Ledger(spark, path)
    parts = log.state()[1]
    old = ledger.of_table(parts, LINES, topic=topic, day=day)
    zones = ledger.of_table(parts, ZONES, topic=topic, day=day)
    if not old or len(old) == 1 and old[0]["run"] == ledger.MERGED:
        return None
    rows = log.read(old, LINES, _LINES).select("value", "partition", "offset", "timestamp", "topic", "day")
    order = ["partition", "offset"]
    merged = log.write(rows.repartitionByRange(*order).sortWithinPartitions("topic", "day", *order),
                       LINES, ledger.MERGED, 0, "topic", "day", gather=False)
    return log.commit("seal", ledger.merging(old + zones, merged + _write_zones(log, merged, ledger.MERGED, 0)))


def replay(spark, path, topic, day, ordered=True):
    """One archived day of a topic as a common frame; only its folders are listed, whole days by their path."""
    log = ledger.Ledger(spark, path)
    lines = log.read(ledger.of_table(log.state()[1], LINES, topic=topic, day=day), LINES, _LINES)
    frame = lines.select(
        F.lit(topic).alias("key"), "value", F.lit(topic).alias("topic"), "partition", "offset", "timestamp")
    return frame.orderBy("partition", "offset") if ordered else frame


def files_at(spark, path, topic, offsets):
    """Files that may hold the first message at or after the offset of each queue partition.

    Of files whose offsets begin later only the nearest counts, and only where
    it begins before the end of every file around the offset.
    """
    log = ledger.Ledger(spark, path)
    zones = log.read(ledger.of_table(log.state()[1], ZONES, topic=topic), ZONES, _ZONES)
    near = zones.join(offsets.select("partition", F.col("offset").alias("committed")), "partition").filter("high >= committed")
    around = F.col("low") <= F.col("committed")
    bounds = near.groupBy("partition").agg(
        F.min(F.when(around, F.col("high"))).alias("end"), F.min(F.when(~around, F.col("low"))).alias("next"))
    wanted = near.join(bounds, "partition").filter(
        around | (F.col("low") == F.col("next")) & (F.col("end").isNull() | (F.col("next") < F.col("end"))))
    # A few files per queue partition.
    return sorted(f"{log.path}/{row['folder']}/{row['file']}" for row in wanted.select("folder", "file").distinct().collect())


def reached_day(spark, path, topic, offsets):
    """Per queue partition the event day of the message at the committed offset, or the next one still kept."""
    files = files_at(spark, path, topic, offsets)
    committed = offsets.select("partition", F.col("offset").alias("committed"))
    if not files:
        rows = spark.createDataFrame([], _LINES)
    else:
        rows = spark.read.schema(_LINES).option("basePath", f"{path.rstrip('/')}/data/{LINES}").parquet(*files)
    ahead = rows.select("partition", "offset", "day").join(committed, "partition").filter("offset >= committed")
    return ahead.groupBy("partition", "committed").agg(F.min(F.struct("offset", "day")).alias("first")).select(
        "partition", "committed", "first.offset", F.col("first.day").cast("bigint").alias("day"))
