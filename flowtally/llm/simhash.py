"""SimHash near-duplicates by meet-in-the-middle ball hashing.

A fingerprint bit is set where it is set in over half of the hashes of a text's
word shingles. Two fingerprints of up to three differing bits have a 32-bit
half with at most one: half the radius. So each distinct fingerprint emits, for
both halves, the half itself and its 32 variants of one flipped bit; the
variants are shuffled, and a fingerprint meets every one whose own half equals
one of its variants. (Variants of all 64 bits would have to reach two flips on
one side to find three differing bits, 2,081 rows a fingerprint instead of 66.)

Pairs that meet are verified on all 64 bits. What leaves a bucket is a spanning
forest of its verified links, fewer rows than the bucket has members, never all
pairs. Components are found by alternating large and small stars over these
links, each round written to shared storage. Exact copies are one fingerprint
from the start and are never compared.

Defined cases: NULL and empty texts have fingerprint 0, linked like any other;
a text of fewer words than a shingle is one shingle; NULL numbers of documents
never name a component unless it has no other; repeated rows keep one row each;
other columns are ignored, whatever their names; an empty table gives no rows.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from flowtally.llm.common import cut, words_of

HALF = 32
RADIUS = 3
SALTS = 8


def fingerprint(words, size):
    """Signed 64-bit SimHash of a list of words (bytes)."""
    if not words:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[:-1].tolist()]
    stops = (ends[size - 1:] - 1).tolist() or [len(joined)]
    hashes = np.array([digest(joined[a:b], 42) for a, b in zip(starts, stops)], dtype=">u8")
    counts = np.zeros(64, dtype=np.int64)
    for block in range(0, len(hashes), 65536):
        part = hashes[block:block + 65536].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(hashes)).tobytes(), "big", signed=True)


def fingerprints(docs, shingle=3):
    """doc_id and fp (64 bits as a signed number) of every whole text."""
    def run(batches):
        for batch in batches:
            texts = batch.column(1)
            fps = [fingerprint(words_of(texts[i].as_py()), shingle) for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64())], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, "doc_id long, fp long")


def _forest(fps):
    """Links that span the verified pairs of one bucket."""
    bits, waiting, links = fps.view(np.uint64), np.arange(len(fps)), []
    while len(waiting):
        reached, waiting = [waiting[0]], waiting[1:]
        while reached and len(waiting):
            at = reached.pop()
            near = np.bitwise_count(bits[waiting] ^ bits[at]) <= RADIUS
            found, waiting = waiting[near], waiting[~near]
            links += [(int(fps[at]), int(fps[f])) for f in found]
            reached += found.tolist()
    return links


def _links(key, fp, own):
    """Verified links of whole buckets, as one record batch; rows are sorted by key."""
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, dtype=np.int64)
    stops = np.r_[starts[1:], len(key)]
    owners = np.add.reduceat(own.astype(np.int64), starts) if len(key) else starts
    links = []
    for a, b in zip(starts[(owners > 0) & (stops - starts > 1)], stops[(owners > 0) & (stops - starts > 1)]):
        links += _forest(fp[a:b])
    a, b = zip(*links) if links else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _bucket_links(batches):
    """Links of rows (key, fp, own) sorted by key; a bucket may run over several batches."""
    kept = [np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=bool)]
    for batch in batches:
        if batch.num_rows:
            rows = [np.concatenate([k, c.to_numpy(zero_copy_only=False)]) for k, c in zip(kept, batch.columns)]
            last = int(np.searchsorted(rows[0], rows[0][-1]))
            kept = [x[last:] for x in rows]
            yield _links(*(x[:last] for x in rows))
    yield _links(*kept)


def links(fps):
    """Links (a, b) between distinct fingerprints (column fp) whose closure is that of all verified pairs."""
    flips = [0, *(1 << b for b in range(HALF))]
    halves = F.array(
        F.struct(F.lit(0).alias("side"), F.shiftrightunsigned("fp", HALF).alias("half")),
        F.struct(F.lit(1).alias("side"), F.col("fp").bitwiseAND(F.lit((1 << HALF) - 1)).alias("half")))
    variants = (fps.select("fp", F.inline(halves))
                .select("fp", "side", "half", F.explode(F.array(*(F.lit(f) for f in flips))).alias("flip"))
                .select((F.col("half").bitwiseXOR(F.col("flip")) * 2 + F.col("side")).alias("key"), "fp",
                        (F.col("flip") == 0).alias("own")))
    return (variants.repartition("key").sortWithinPartitions("key")
            .mapInArrow(_bucket_links, "a long, b long").distinct())


def components(edges, rounds=60):
    """node and root (the smallest node reachable) of all nodes that have a link."""
    edges = cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), "links")

    def state(frame):
        return frame.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    before = state(edges)
    for _ in range(rounds):
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("low")).withColumn("low", F.least("a", "low"))
        large = (both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")))
        large = large.where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(least, "a").select(F.explode(F.array(
            F.struct(F.col("b").alias("a"), F.col("low").alias("b")),
            F.struct(F.col("a"), F.col("low").alias("b")))).alias("e")).select("e.*")
        edges = cut(small.where("a <> b").distinct(), "links")
        after = state(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def near_duplicates(docs, shingle=3):
    """doc_id, fp and component_id (the smallest doc_id reachable) of every document."""
    prints = cut(fingerprints(docs, shingle), "fingerprints")
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = components(links(distinct.select("fp")))
    named = (distinct.join(roots, distinct.fp == roots.node, "left")
             .select("fp", "first", F.coalesce("root", "fp").alias("root")))
    named = cut(named, "roots")
    lowest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    named = named.join(lowest, "root").select("fp", "component_id")
    # A frequent fingerprint is dealt over several tasks.
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    return (prints.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
            .join(named.select("*", salts), ["fp", "salt"])
            .select("doc_id", "fp", "component_id"))


def drop_near_duplicates(docs, shingle=3):
    """Documents, one of each component: the row that has its component's number.

    Rows that share this number count as one document; one of them stays.
    """
    def numbered(frame):
        return frame.withColumn("_id", F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(1 << 63))))

    named = near_duplicates(docs, shingle)
    keep = numbered(named.where(F.col("doc_id").eqNullSafe(F.col("component_id")))).select("_id").distinct()
    return numbered(docs).join(keep, "_id", "left_semi").dropDuplicates(["_id"]).drop("_id")
