"""Kafka in and out. Thin option builders over Spark's own connector.

The connector package (``spark-sql-kafka``) has to be on the class path of the
cluster; nothing else here depends on it.
"""

from pyspark.sql import functions as F

from flowtally.schemas import HLS_TOPIC, RTMP_TOPIC


def read_options(brokers, topics=(HLS_TOPIC, RTMP_TOPIC), starting="latest", max_offsets=None,
                 min_partitions=None):
    """Reader options for one or more topics.

    ``max_offsets`` caps one micro-batch, see :func:`offsets_per_trigger`.
    ``min_partitions`` splits large topic partitions over more tasks.
    """
    options = {
        "kafka.bootstrap.servers": brokers,
        "subscribe": ",".join(topics),
        "startingOffsets": starting,
    }
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    return options


def offsets_per_trigger(records_per_second, partitions, trigger_seconds):
    """A rate per second and topic partition as the total per micro-batch."""
    return records_per_second * partitions * trigger_seconds


def to_frame(raw):
    """Connector rows -> common frame."""
    return raw.select(
        F.col("key").cast("string"), F.col("value").cast("string"),
        "topic", "partition", "offset", "timestamp",
    )


def read_stream(spark, brokers, **options):
    return to_frame(spark.readStream.format("kafka").options(**read_options(brokers, **options)).load())


def read_batch(spark, brokers, topics=(HLS_TOPIC, RTMP_TOPIC)):
    """Everything the topics hold now."""
    options = read_options(brokers, topics, starting="earliest")
    return to_frame(spark.read.format("kafka").options(**options).load())


def publish_frame(messages, topic, key="topic"):
    """Rows a Kafka writer takes: topic, key, value.

    ``key="topic"`` keeps the agreed message key. With a hashing partitioner
    that sends a whole topic to one partition; ``key=None`` spreads it.
    """
    if key not in ("topic", None):
        raise ValueError("key is 'topic' or None")
    key_column = F.lit(topic) if key else F.lit(None)
    return messages.select(
        F.lit(topic).alias("topic"), key_column.cast("string").alias("key"), "value"
    )


def publish(messages, brokers, topic, key="topic"):
    rows = publish_frame(messages, topic, key)
    rows.write.format("kafka").option("kafka.bootstrap.servers", brokers).save()


def publish_stream(messages, brokers, topic, checkpoint, key="topic"):
    rows = publish_frame(messages, topic, key)
    return (
        rows.writeStream.format("kafka").option("kafka.bootstrap.servers", brokers)
        .option("checkpointLocation", checkpoint).start()
    )
