"""Base partial sums and the increment-or-insert fold.

Everything is a keyed sum. Spark sums inside each task before the shuffle, so
a key that holds a third of all rows reaches its reducer as one row per task.
"""

from pyspark.sql import functions as F

from flowtally.schemas import (
    FRACTION_SUM_TYPE, FRACTIONAL, HLS_DIMS, HLS_METRICS, RTMP_DIMS, RTMP_METRICS, WIDE,
    WIDE_SUM_TYPE,
)
from flowtally.session import work_dir

KEYS = {"hls": HLS_DIMS, "rtmp": RTMP_DIMS}
COUNTERS = {"hls": HLS_METRICS, "rtmp": RTMP_METRICS}


def total(column, metric, kind):
    """Sum of a counter of type ``kind``, in the type that holds any number of partial sums.

    Bigints of a wide counter are summed in two halves of 32 bits, which no
    number of rows in a task can overflow, and put together after the sum: as
    fast as bigints, exact as decimals.
    """
    if metric in FRACTIONAL:
        return F.sum(column).cast(FRACTION_SUM_TYPE)
    if metric not in WIDE:
        return F.sum(column)
    if kind != "bigint":
        return F.sum(column).cast(WIDE_SUM_TYPE)
    high = F.sum(F.shiftright(column, 32)).cast("decimal(20,0)")
    low = F.sum(column.bitwiseAND(F.lit(0xFFFFFFFF))).cast("decimal(20,0)")
    return (high * F.lit(1 << 32).cast("decimal(10,0)") + low).cast(WIDE_SUM_TYPE)


def base(rows, feed, *extra_keys):
    """Partial sums at the finest key of a feed, from row-level counters."""
    kinds = dict(rows.dtypes)
    return rows.groupBy(*extra_keys, *KEYS[feed]).agg(
        *[total(F.col(m), m, kinds[m]).alias(m) for m in COUNTERS[feed]])


def fold(partials, feed):
    """Running totals from any number of partial sums."""
    return base(partials, feed)


def increment_or_insert(existing, delta, keys):
    """Add the counters of ``delta`` to rows with the same key, insert the others."""
    counters = [c for c in existing.columns if c not in keys]
    both = existing.unionByName(delta.select(existing.columns))
    kinds = dict(existing.dtypes)
    return both.groupBy(*keys).agg(*[F.sum(c).cast(kinds[c]).alias(c) for c in counters])


def shown(sums, beyond=()):
    """Totals as readers expect them: fractional ones as doubles, wide ones as bigints.

    A wide total beyond the bigint range is an error here, never a wrong number; columns
    named in ``beyond`` stay decimals.
    """
    kinds = dict(sums.dtypes)
    shown_as = {c: "double" for c in sums.columns if c in FRACTIONAL}
    shown_as.update({c: "bigint" for c in sums.columns if kinds[c] == WIDE_SUM_TYPE and c not in beyond})
    return sums.withColumns({c: F.col(c).cast(kind) for c, kind in shown_as.items()})


def shown_whole(sums):
    """As :func:`shown`, but a column with a total beyond the bigint range is shown as decimals.

    The totals decide on their type, so they are written first and worked out once.
    """
    spark, path = sums.sparkSession, work_dir(sums.sparkSession, "totals")
    sums.write.parquet(path)
    kept = spark.read.schema(sums.schema).parquet(path)
    wide = [c for c, kind in kept.dtypes if kind == WIDE_SUM_TYPE]
    over = kept.agg(*[F.count_if(F.col(c).isNotNull() & F.col(c).try_cast("bigint").isNull()).alias(c) for c in wide]).first()
    return shown(kept, [c for c in wide if over[c]])
