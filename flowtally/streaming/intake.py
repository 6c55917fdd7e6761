"""Intake: both feeds in one pass, and pages of the upstream queue by their own positions.

A commit of the log below ``root`` covers all tables that a batch writes, so a
stop between any two writes leaves nothing visible, and a repeated batch takes
the place of its earlier attempt in every table.
"""

from pyspark import StorageLevel
from pyspark.sql import functions as F

from flowtally.functions import timekeys
from flowtally.plans.base import base
from flowtally.sources import archive, mq, sealed
from flowtally.streaming import ledger, partials

REJECTS = "rejects"
PULLED = "pulled"
_REJECTS = """key string, value string, topic string, partition int, offset bigint, timestamp timestamp, reject string,
 run string, batch_id bigint, attempt string, feed string"""
_PULLED = "partition int, offset bigint, body string, run string, batch_id bigint, attempt string"


def sums_table(feed):
    """Table of a feed's partial sums, for :func:`partials.read_partials` and :func:`served.follow`."""
    return f"sums-{feed}"


def account_both(batch, batch_id, root, run, tz=timekeys.DEFAULT_TZ):
    """Account one micro-batch of both topics: sums and rejects of either feed and archived lines, one commit.

    The messages are read from the source once and kept, on disk where memory is short, for all writes; so are the
    decoded ones of a feed, with the text of rejected messages only, for its two.
    """
    log = ledger.Ledger(batch.sparkSession, root)
    batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        parts = sealed.write(log, batch, run, batch_id, tz)
        parts += log.write(archive.rejects(batch).withColumn("feed", F.lit("archive")), REJECTS, run, batch_id, "feed")
        for feed, operators in partials.OPERATORS.items():
            text = F.when(operators.reject_reason().isNotNull(), F.col("value"))
            decoded = operators.read(batch).withColumn("value", text).persist(StorageLevel.MEMORY_AND_DISK)
            try:
                sums = base(operators.derive(operators.accept(decoded), tz), feed)
                parts += partials.write_parts(log, sums, run, batch_id, sums_table(feed))
                rejects = operators.rejects(decoded).withColumn("feed", F.lit(feed))
                parts += log.write(rejects, REJECTS, run, batch_id, "feed")
            finally:
                decoded.unpersist()
    finally:
        batch.unpersist()
    tables = [sealed.LINES, sealed.ZONES, REJECTS, *map(sums_table, partials.OPERATORS)]
    return log.commit("intake", ledger.replacing(parts, tables, run, batch_id))


def start(frame, root, checkpoint, run, tz=timekeys.DEFAULT_TZ, **trigger):
    """Account and archive both topics of a streaming common frame with one query."""
    return (
        frame.writeStream.foreachBatch(lambda batch, batch_id: account_both(batch, batch_id, root, run, tz))
        .option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "300 seconds"})).start()
    )


def read_rejects(spark, root):
    log = ledger.Ledger(spark, root)
    return log.read(ledger.of_table(log.state()[1], REJECTS), REJECTS, _REJECTS).drop("run", "batch_id", "attempt")


# --- pages by position --------------------------------------------------------


def positions(spark, root):
    """Next offset of each queue partition pulled so far."""
    return {int(k): v for k, v in ledger.Ledger(spark, root).state()[2].get("positions", {}).items()}


def pull(pages, offsets, root, run, limit):
    """Take the next messages of every queue partition out of landed pages; gives how many partitions moved on.

    A partition begins at its committed offset, moved up to the first one still
    kept (``offsets``: partition, startOffset, offset), and goes on at its own
    position. A step takes at most ``limit`` offsets of each partition and ends
    where a page within them says the next one starts; messages and
    positions appear by one commit. Positions are a number per queue partition.
    """
    spark = pages.sparkSession
    log = ledger.Ledger(spark, root)
    version, _, note = log.state()
    known = {int(k): v for k, v in note.get("positions", {}).items()}
    begin = offsets.select("partition", F.greatest("startOffset", "offset").alias("at"), "startOffset")
    at = {row["partition"]: max(known.get(row["partition"], row["at"]), row["startOffset"]) for row in begin.collect()}
    if not at:
        return 0
    reach = spark.createDataFrame([(p, a) for p, a in sorted(at.items())], "partition int, at bigint")
    read = mq.read_pages(pages).join(F.broadcast(reach), "partition").filter("nextOffset > at")
    ends = {row["partition"]: row["end"] for row in read.groupBy("partition").agg(
        F.coalesce(F.max(F.when(F.col("nextOffset") <= F.col("at") + limit, F.col("nextOffset"))),
                   F.least(F.min("nextOffset"), F.max("at") + limit)).alias("end")).collect()}
    if not ends:
        return 0
    spans = spark.createDataFrame([(p, at[p], e) for p, e in sorted(ends.items())], "partition int, at bigint, end bigint")
    messages = mq.explode_pages(pages).join(F.broadcast(spans), "partition").filter("offset >= at and offset < end")
    # Pages may be landed twice or overlap: a message counts once.
    once = messages.groupBy("partition", "offset").agg(F.min("body").alias("body"))
    parts = log.write(once.withColumn("queue", F.col("partition")), PULLED, run, version, "queue")

    def change(_, current):
        if current.get("positions", {}) != note.get("positions", {}):
            return None
        return parts, [], {"positions": {str(p): n for p, n in {**known, **ends}.items()}}

    return len(ends) if log.commit("pull", change) else 0


def pulled(spark, root):
    """All messages pulled: partition, offset, body."""
    log = ledger.Ledger(spark, root)
    return log.read(ledger.of_table(log.state()[1], PULLED), PULLED, _PULLED + ", queue int").select("partition", "offset", "body")
