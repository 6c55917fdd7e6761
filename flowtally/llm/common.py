"""Small helpers the operators of this package share."""

import os
import shutil
import string
import tempfile

from pyspark.sql import functions as F

from flowtally.session import work_dir

UPPER, LOWER = string.ascii_uppercase, string.ascii_lowercase


def ship(spark):
    """Send this package to the Python workers, once per context, so that they can import it anywhere."""
    context = spark.sparkContext
    if not getattr(context, "_flowtally_shipped", False):
        root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        archive = os.path.join(tempfile.mkdtemp(prefix="flowtally-code-"), "flowtally_code")
        context.addPyFile(shutil.make_archive(archive, "zip", root, "flowtally"))
        context._flowtally_shipped = True


def table(spark, sf_dir, name):
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cut(frame, purpose):
    """Write a frame to the shared scratch folder and read it back.

    Later stages then start from files every executor can read, so a lost
    executor costs a re-read and not a recomputation.
    """
    spark = frame.sparkSession
    path = work_dir(spark, purpose)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def cut_and_sweep(frame, purpose):
    """As :func:`cut`, and what was shuffled for it is removed from the executors' disks at once."""
    conf, key = frame.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key)
    conf.set(key, "true")
    try:
        return cut(frame, purpose)
    finally:
        conf.set(key, before)


def lower_ascii(column):
    """A-Z to a-z, every other character as it is."""
    return F.translate(column, UPPER, LOWER)


def text_bytes(text):
    """UTF-8 bytes of a text, None as empty; lone surrogates become question marks."""
    return text.encode("utf-8", "replace") if text else b""


def words_of(text):
    """Lower-cased (A-Z) words between blanks and the controls 9 to 13, as bytes."""
    return text_bytes(text).lower().split()


def is_held_out(folds):
    """Whether crc32 of the document's number as text is divisible by ``folds``; NULL counts as ''."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % folds == 0
