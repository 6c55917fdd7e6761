"""Histogram sort: shards of near-equal size along one exact order of the documents.

Documents are ordered by (hash of the text, doc_id). A slim table of keys and
sizes is written once; each round then counts exact bytes below up to 4,096
candidate boundaries per open splitter, across all partitions, and refines the
probes between the two that enclose the wanted size until every splitter meets
the tolerance. A round returns at most 4,096 sums per splitter to the driver,
whatever the input. Equal texts are neighbours in the order, and a splitter
falls inside a group of them only if no boundary beside it meets the tolerance.

Rows are then exchanged once. Numbers within a shard come from exact counts of
fine bins (shard, leading key byte, hash slice of the document numbers), at most
(256 + shards) x 16 of them, and a sort within each bin, so that no task holds
a whole shard and a hot group of copies is dealt over 16 slices.

Defined cases: a NULL text has size 1 and a checksum of 0; a NULL doc_id sorts
first; rows equal in text and doc_id stay together; an empty table gives no
rows; columns with names of the result are replaced, others are kept.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from flowtally.llm.common import cut

DIGITS = 12
LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1
SLICES = 16


class _Open:
    """Part of the order in which splitters still have to be found: a range of keys, or of numbers of one key."""

    def __init__(self, low, high, below, number=False, key=None):
        self.low, self.high, self.below, self.number, self.key = low, high, below, number, key
        self.shift = max(0, (low ^ high).bit_length() - DIGITS) if (low < 0) == (high < 0) else 64 - DIGITS

    def test(self):
        if self.number:
            return (F.col("_k") == self.key) & F.col("_n").between(self.low, self.high)
        return F.col("_k").between(self.low, self.high)

    def digit(self):
        return F.shiftright("_n" if self.number else "_k", self.shift)


def splitters(slim, shards, tolerance):
    """Boundaries (key, number): a row belongs to the right of each one it is not below."""
    total, low, high = slim.agg(F.sum("_size"), F.min("_k"), F.max("_k")).first()
    if total is None:
        return []
    allowed = tolerance * total / shards
    found = {}
    waiting = {_Open(low, high, 0): [total * i / shards for i in range(1, shards)]}
    while waiting:
        parts = list(waiting)
        which, digit = F.lit(None).cast("int"), F.lit(None).cast("bigint")
        for i, part in enumerate(parts):
            which = F.when(part.test(), F.lit(i)).otherwise(which)
            digit = F.when(part.test(), part.digit()).otherwise(digit)
        sums = (slim.select(which.alias("part"), digit.alias("digit"), "_k", "_n", "_size")
                .where("part is not null").groupBy("part", "digit")
                .agg(F.sum("_size").alias("size"), F.min("_k").alias("k0"), F.max("_k").alias("k1"),
                     F.min("_n").alias("n0"), F.max("_n").alias("n1")).collect())
        bins = {i: [] for i in range(len(parts))}
        for row in sorted(sums, key=lambda r: (r["part"], r["digit"])):
            bins[row["part"]].append(row)
        following = {}
        for i, part in enumerate(parts):
            targets, below = sorted(waiting[part]), part.below
            for row in bins[i]:
                above = below + row["size"]
                inside = [t for t in targets if below < t <= above]
                targets = [t for t in targets if t > above]
                start = (row["k0"], row["n0"] if part.number else LOWEST)
                end = (row["k1"], row["n1"] + 1) if part.number else (row["k1"] + 1, LOWEST)
                single = row["k0"] == row["k1"]
                stuck = single and row["n0"] == row["n1"]
                for t in inside:
                    left, right = t - below, above - t
                    if stuck or min(left, right) <= allowed:
                        found[t] = start if left <= right or max(end) > HIGHEST else end
                        continue
                    if single:
                        inner = (row["n0"], row["n1"], below, True, row["k0"])
                    else:
                        inner = (row["k0"], row["k1"], below, False, None)
                    following.setdefault(inner, []).append(t)
                below = above
        waiting = {_Open(*inner): targets for inner, targets in following.items()}
    return [found[t] for t in sorted(found)]


def shard_by_size(docs, shards=16, tolerance=0.001):
    """Documents with size, text_crc32, shard and slot (gapless from 0 within the shard)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = (docs.withColumn("size", F.octet_length(text).cast("bigint") + 1)
            .withColumn("text_crc32", F.crc32(text.cast("binary")))
            .withColumn("_k", F.xxhash64("text"))
            .withColumn("_n", F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LOWEST))))
    slim = cut(rows.select("_k", "_n", F.col("size").alias("_size")), "sharding")
    bounds = splitters(slim, shards, tolerance)

    def placed(frame):
        shard = F.lit(0)
        for k, n in bounds:
            right = (F.col("_k") > k) | ((F.col("_k") == k) & (F.col("_n") >= F.lit(n)))
            shard = shard + F.when(right, 1).otherwise(0)
        return (frame.withColumn("shard", shard.cast("int"))
                .withColumn("_bin", F.shiftright("_k", 56).cast("int"))
                .withColumn("_slice", F.pmod(F.xxhash64("_n"), F.lit(SLICES)).cast("int")))

    bins = placed(slim).groupBy("shard", "_bin", "_slice").agg(F.count("*").alias("_rows"))
    running = Window.partitionBy("shard").orderBy("_bin", "_slice")
    first = bins.select("shard", "_bin", "_slice", (F.sum("_rows").over(running) - F.col("_rows")).alias("_first"))
    order = Window.partitionBy("shard", "_bin", "_slice").orderBy("_k", "_n")
    return (placed(rows).join(F.broadcast(first), ["shard", "_bin", "_slice"])
            .withColumn("slot", F.col("_first") + F.row_number().over(order) - 1)
            .drop("_bin", "_slice", "_first", "_k", "_n"))
