"""Session settings and the shared scratch location."""

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the plans rely on. Partition counts are left to the cluster: AQE
# coalesces from whatever spark.sql.shuffle.partitions starts with.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
    # Repeated keys in a queue message keep the last value instead of being rejected.
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def build_session(app_name="flowtally", master=None, **settings):
    """A session with SETTINGS; keyword settings use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    for name, value in settings.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def work_dir(spark, purpose):
    """A new folder path below the cluster's shared ``spark.checkpoint.dir``.

    Only a local master may fall back to a machine-local folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="flowtally-")
    return f"{root.rstrip('/')}/flowtally/{purpose}-{uuid.uuid4().hex}"
