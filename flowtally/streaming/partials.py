"""Continuous accounting: micro-batches of messages into partial-sum tables.

Each micro-batch writes its sums to a folder of its own, a part for each day, and
commits them in a log (:mod:`flowtally.streaming.ledger`). A new attempt at a
batch takes the place of all that an earlier one committed, whatever its input
or days were, so nothing is counted twice and readers learn which days lost rows.
There is no watermark and no state: a message of any age lands in the part
of its own day.
"""

from pyspark import StorageLevel
from pyspark.sql import functions as F

from flowtally.functions import timekeys
from flowtally.operators import hls, rtmp
from flowtally.plans.base import COUNTERS, KEYS, base
from flowtally.schemas import HLS_TOPIC, RTMP_TOPIC, partials_schema
from flowtally.streaming import ledger

OPERATORS = {"hls": hls, "rtmp": rtmp}
TOPICS = {"hls": HLS_TOPIC, "rtmp": RTMP_TOPIC}
PARTITIONS = ["day", "run", "batch_id"]
SUMS = "sums"


def batch_folder(path, run, batch_id):
    return f"{path}/run={run}/batch_id={batch_id}"


def _with_day(sums):
    return sums.withColumn("day", timekeys.day_of(F.col("timestamp_hour")).cast("int"))


def write_parts(log, sums, run, batch_id, table=SUMS):
    """Write one batch of partial sums; gives the parts, still to be committed."""
    return log.write(_with_day(sums), table, run, batch_id, "day")


def write_partials(sums, path, run, batch_id, table=SUMS):
    """Write and commit one batch of partial sums, in the place of an earlier attempt at the same batch."""
    log = ledger.Ledger(sums.sparkSession, path)
    parts = write_parts(log, sums, run, batch_id, table)
    return log.commit("batch", ledger.replacing(parts, [table], run, batch_id))


def write_rejects(rejects, path, run, batch_id):
    rejects.write.mode("overwrite").parquet(batch_folder(path, run, batch_id))


def account_batch(batch, batch_id, feed, path, run, rejects_path=None, tz=timekeys.DEFAULT_TZ):
    """Account one micro-batch: sums to ``path``, unusable messages to ``rejects_path``.

    With a reject table two writes need the decoded messages. They are kept
    for both, with the text of rejected messages only, and spill to disk when
    memory is short.
    """
    operators = OPERATORS[feed]
    decoded = operators.read(batch)
    if rejects_path is not None:
        text = F.when(operators.reject_reason().isNotNull(), F.col("value"))
        decoded = decoded.withColumn("value", text).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        rows = operators.derive(operators.accept(decoded), tz)
        if rejects_path is not None:
            write_rejects(operators.rejects(decoded), rejects_path, run, batch_id)
        write_partials(base(rows, feed), path, run, batch_id)
    finally:
        if rejects_path is not None:
            decoded.unpersist()


def start_partials(frame, feed, path, checkpoint, run, rejects_path=None,
                   tz=timekeys.DEFAULT_TZ, **trigger):
    """Start the accounting of one feed over a streaming common frame.

    ``run`` names the life of one checkpoint: batch numbers restart with a new
    checkpoint, so a new one needs a new name. Each feed is a query of its
    own; start one per topic to account several feeds from one source. The
    default trigger is every 300 seconds.
    """
    def write(batch, batch_id):
        account_batch(batch, batch_id, feed, path, run, rejects_path, tz)

    return (
        frame.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "300 seconds"})).start()
    )


def start_feeds(open_frame, root, run, tz=timekeys.DEFAULT_TZ, **trigger):
    """Start the accounting of both feeds, one query each: feed -> query.

    ``open_frame(topic)`` gives the streaming common frame of one topic, so
    that no query reads messages of the other.
    """
    return {
        feed: start_partials(
            open_frame(topic), feed, f"{root}/partials/{feed}", f"{root}/checkpoints/{run}/{feed}",
            run, f"{root}/rejects/{feed}", tz, **trigger)
        for feed, topic in TOPICS.items()
    }


def _schema(feed):
    return partials_schema(KEYS[feed], COUNTERS[feed]) + ", attempt string"


def read_parts(log, feed, parts, table=SUMS):
    """Partial sums of some parts."""
    return log.read(parts, table, _schema(feed)).drop("attempt")


def read_partials(spark, path, feed, days=None, version=None, table=SUMS):
    """The partial-sum table of a feed as of a commit, the last one by default; only folders of ``days``, if given, are listed."""
    log = ledger.Ledger(spark, path)
    parts = ledger.of_table(log.state(version)[1], table)
    if days is not None:
        parts = [part for part in parts if int(part["keys"]["day"]) in set(days)]
    return read_parts(log, feed, parts, table)


def scattered_days(spark, path, before, table=SUMS):
    """Days before a day key whose sums lie in more than one part."""
    parts, count = ledger.of_table(ledger.Ledger(spark, path).state()[1], table), {}
    for part in parts:
        day = int(part["keys"]["day"])
        count[day] = count.get(day, 0) + 1
    return sorted(day for day, n in count.items() if n > 1 and day < before)


def compact(spark, feed, path, days, table=SUMS):
    """Merge the parts of some days into one part for each day, by one commit.

    Readers see the old parts or the merged ones. Batches that come meanwhile
    or later lie beside the merged part. Where a merged batch was written anew
    or its day was purged in the meantime, nothing is changed. Gives the version of the commit, or None.
    """
    log = ledger.Ledger(spark, path)
    wanted = set(days)
    old = [part for part in ledger.of_table(log.state()[1], table) if int(part["keys"]["day"]) in wanted]
    if not old:
        return None
    sums = base(read_parts(log, feed, old, table), feed, "day")
    merged = log.write(sums, table, ledger.MERGED, 0, "day")
    return log.commit("compact", ledger.merging(old, merged))


def purge(spark, path, day, table=SUMS):
    """Remove the partial sums of one day that are there now, by one commit; later batches count again."""
    return ledger.Ledger(spark, path).commit("purge", ledger.forgetting(table, day=day))
