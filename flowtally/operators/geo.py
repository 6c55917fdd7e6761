"""IPv4 range lookup: an address belongs to the first range whose end is not below it.

Input ranges are rows (ip_end bigint, location string). Only their ends are
known; a range starts after the end before it.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from flowtally.functions.addresses import octets, octets_number

NOT_FOUND = "N/A"

# Bounds for sending the range table to every executor: rows of the cut table,
# bytes of their locations, and rows an address may have to be compared with.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 * 2**20
BROADCAST_CANDIDATES = 1_024

# Half of an address. Ends fall into at most 65,536 such blocks, which bounds
# every one-row-per-block table and, with distinct addresses, every block.
_BLOCK = 65_536

# Parts a busy address is dealt into.
_SALTS = 16


def _div(column, width):
    return F.call_function("div", column, F.lit(width))


def _distinct_ends(ranges):
    """One row per end; of equal ends the first location by name counts."""
    ends = ranges.filter(F.col("ip_end").between(0, 2**32 - 1)).groupBy("ip_end").agg(
        F.min("location").alias("location"))
    return ends.withColumn("block", _div(F.col("ip_end"), _BLOCK))


def closed_ranges(ranges):
    """Rows (ip_start, ip_end, location) from ends alone.

    The previous end is looked up inside a block; only for the first range of
    a block it comes from a table with one row per block.
    """
    ends = _distinct_ends(ranges)
    tails = ends.groupBy("block").agg(F.max("ip_end").alias("tail"))
    carried = tails.select(
        "block", F.lag("tail").over(Window.orderBy("block")).alias("carried"))
    inside = F.lag("ip_end").over(Window.partitionBy("block").orderBy("ip_end"))
    return ends.withColumn("before", inside).join(carried, "block").select(
        (F.coalesce("before", "carried", F.lit(-1)) + 1).alias("ip_start"), "ip_end", "location")


def cut_ranges(ranges, prefix_bits):
    """Closed ranges cut at address prefixes: one row per range and prefix it touches."""
    width = 2 ** (32 - prefix_bits)
    prefixes = F.sequence(_div(F.col("ip_start"), width), _div(F.col("ip_end"), width))
    return closed_ranges(ranges).select("*", F.explode(prefixes).alias("prefix"))


def _fits_broadcast(cut):
    """One look at the range table, never at the addresses."""
    sizes = cut.groupBy("prefix").agg(
        F.count("*").alias("candidates"), F.sum(F.octet_length("location")).alias("bytes")
    ).agg(F.sum("candidates"), F.sum("bytes"), F.max("candidates")).first()
    bounds = (BROADCAST_ROWS, BROADCAST_BYTES, BROADCAST_CANDIDATES)
    return all((size or 0) <= bound for size, bound in zip(sizes, bounds))


def _broadcast_lookup(addressed, cut, prefix_bits):
    width = 2 ** (32 - prefix_bits)
    hit = (
        (_div(F.col("_ip"), width) == F.col("prefix"))
        & F.col("_ip").between(F.col("ip_start"), F.col("ip_end"))
    )
    return addressed.join(F.broadcast(cut), hit, "left")


def _shuffled_lookup(addressed, ranges):
    """For range tables too large or too dense to broadcast.

    Works on distinct addresses, so a frequent address costs one row. A block
    then holds at most 65,536 addresses and as many ends. Each address takes
    the nearest end at or above it in its block, or else the first end of the
    next block that has one. For the join back every located address is
    repeated ``_SALTS`` times and the raw addresses are dealt over the repeats, so
    a busy address, or the NULL of all unusable ones, is many tasks' work.
    """
    ends = _distinct_ends(ranges)
    wanted = addressed.select("_ip").where("_ip is not null").distinct()
    points = ends.select("block", F.col("ip_end").alias("at"), F.lit(0).alias("wanted"),
                         F.struct("location").alias("found"))
    probes = wanted.select(_div(F.col("_ip"), _BLOCK).alias("block"), F.col("_ip").alias("at"),
                           F.lit(1).alias("wanted"),
                           F.lit(None).cast("struct<location: string>").alias("found"))
    downwards = Window.partitionBy("block").orderBy(F.desc("at"), F.asc("wanted")).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    near = points.unionByName(probes).withColumn(
        "found", F.last("found", ignorenulls=True).over(downwards)).filter("wanted = 1")
    heads = ends.groupBy("block").agg(
        F.min_by(F.struct("location"), "ip_end").alias("head")).withColumnRenamed("block", "start")
    # One row per block with ends: the first head above every block.
    spans = heads.select(
        F.coalesce(F.lag("start").over(Window.orderBy("start")), F.lit(-1)).alias("below"),
        "start", "head")
    first_block = F.greatest("below", F.lit(0))
    next_head = spans.filter(F.col("start") > first_block).select(
        F.explode(F.sequence(first_block, F.col("start") - 1)).alias("block"), "head")
    located = near.join(next_head, "block", "left").select(
        F.col("at").alias("_ip"), F.coalesce("found", "head")["location"].alias("location"))
    salts = F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("_salt")
    dealt = addressed.withColumn(
        "_salt", F.pmod(F.monotonically_increasing_id(), F.lit(_SALTS)).cast("int"))
    # A NULL address matches nothing: its rows need no exchange by address.
    known = dealt.where("_ip is not null").join(located.select("*", salts), ["_ip", "_salt"], "left")
    unknown = dealt.where("_ip is null").withColumn("location", F.lit(None).cast("string"))
    return known.unionByName(unknown).drop("_salt")


def lookup(probes, ranges, ip_column="ip", prefix_bits=16, strategy="auto"):
    """Add ``location`` to ``probes``; ``N/A`` where no range holds the address.

    ``ip_column`` holds dotted quads or numbers; anything else is ``N/A``.
    ``prefix_bits`` is the index granularity: 8 (first octet) or 16 (first
    two). The result does not depend on it, nor on ``strategy``. ``auto``
    broadcasts the range table if its size allows, at 16 bits where the wanted
    index is too dense; ``shuffle`` never broadcasts.
    """
    if prefix_bits not in (8, 16):
        raise ValueError("prefix_bits is 8 or 16")
    if strategy not in ("auto", "shuffle"):
        raise ValueError("strategy is 'auto' or 'shuffle'")
    if dict(probes.dtypes)[ip_column] == "string":
        parts = probes.withColumn("_octets", octets(F.col(ip_column)))
        addressed = parts.withColumn("_ip", octets_number(F.col("_octets"))).drop("_octets")
    else:
        addressed = probes.withColumn("_ip", F.col(ip_column).cast("bigint"))
    joined = None
    for bits in sorted({prefix_bits, 16}) if strategy == "auto" else []:
        cut = cut_ranges(ranges, bits)
        if _fits_broadcast(cut):
            joined = _broadcast_lookup(addressed, cut, bits)
            break
    if joined is None:
        joined = _shuffled_lookup(addressed, ranges)
    return joined.select(
        *probes.columns, F.coalesce("location", F.lit(NOT_FOUND)).alias("location"))
