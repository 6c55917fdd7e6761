"""Line dedup by content-defined chunks of lines.

A rolling hash over the hashes of the last two lines ends a chunk where it is
divisible by ``MODULUS``, so boundaries depend on the lines beside them only
and repeat wherever a passage repeats, however it is shifted. A line of at least
``LONG_WORDS`` words is a passage of its own: it starts and ends a chunk.
Chunks of two or more lines, and long lines, that occur more than once in the
corpus are removed but for their first occurrence (smallest doc_id, then
position).

Chunks are found per row. Occurrences are grouped by hash and by the chunk's
bytes, with sums before the shuffle, so a passage of thousands of copies is one
row per task and repetition means equal bytes. Hashes that stand for
two different chunks are never removed by hash. The verdicts are joined back
to narrow occurrences (a frequent one is split by adaptive execution) and the
documents are exchanged once to be rewritten.

All of it is DataFrame functions. Defined cases: a NULL text stays NULL and an
empty one empty; chunks of blank lines stay; rows that agree in doc_id count as
one document, so a chunk at the same position of several stays in each; a text that loses all its chunks becomes
empty, its row stays; other columns are kept; an empty table gives no rows.

``dedup_passages`` also removes what chunks miss: lines of every run of at least
``LONG_WORDS`` words that occurs earlier, however short its lines are. The shortest
runs of so many words from each line on, and up to each line, cover every longer
run to its edges; they are compared by MD5 (128 bits), not byte by byte. Words of
a line are its blanks plus one, so such a run has at most ``LONG_WORDS`` lines.
"""

from pyspark.sql import functions as F

MODULUS = 4
LONG_WORDS = 50
LOWEST = -(1 << 63)


def place():
    """Order of occurrences as one number, which hash aggregation can hold: doc_id, then position."""
    return F.expr("cast(_id as decimal(20, 0)) * cast(10000000000 as decimal(11, 0)) + k")


def words_in(line):
    """Blanks of a line plus one; bytes are as good as letters here and need no counting."""
    return F.octet_length(line) - F.octet_length(F.replace(line, F.lit(" "))) + 1


def is_blank(body):
    """Whether lines hold nothing but blanks; looks no further than the first letter."""
    return F.ltrim(body, F.lit(" \n")) == ""


def keyed(docs):
    """The documents with _id and _hash, which name a row."""
    return (docs.withColumn("_id", F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LOWEST)))
            .withColumn("_hash", F.xxhash64("text")))


def with_chunks(docs):
    """The documents with _chunks: array of (k, start, lines, eligible, body)."""
    lines = F.split(F.col("text"), "\n")

    def line(x):
        return F.struct(
            F.conv(F.substring(F.md5(x.cast("binary")), 1, 8), 16, 10).cast("bigint").alias("h"),
            (words_in(x) >= LONG_WORDS).alias("long"))

    def starts_chunk(i):
        last, current = F.get("_hashes", i - 1), F.get("_hashes", i)
        earlier = F.when(i > 1, F.get("_hashes", i - 2)["h"]).otherwise(0)
        return (i == 0) | last["long"] | current["long"] | ((earlier * 31 + last["h"]) % MODULUS == 0)

    def chunk(start, k):
        count = F.coalesce(F.get("_starts", k + 1), F.size("_lines")) - start
        body = F.array_join(F.slice("_lines", start + 1, count), "\n")
        eligible = ((count > 1) | F.get("_hashes", start)["long"]) & ~is_blank(body)
        return F.struct(k.alias("k"), start.alias("start"), count.alias("lines"), eligible.alias("eligible"),
                        body.alias("body"))

    return (docs.withColumn("_lines", lines)
            .withColumn("_hashes", F.transform("_lines", line))
            .withColumn("_starts", F.filter(F.sequence(F.lit(0), F.size("_lines") - 1), starts_chunk))
            .withColumn("_chunks", F.transform("_starts", chunk))
            .drop("_lines", "_hashes", "_starts"))


def repeated_chunks(docs):
    """Occurrences to remove: _id, _hash, k of every repeated chunk but the first of each."""
    # inline_outer: from inline, the optimiser would copy the whole chunk expression into a filter.
    found = (with_chunks(keyed(docs.select("doc_id", "text"))).select("_id", "_hash", F.inline_outer("_chunks"))
             .where("eligible")
             .select("_id", "_hash", "k", "body", F.xxhash64("body").alias("h"),
                     F.crc32(F.col("body").cast("binary")).alias("c")))
    groups = found.groupBy("h", "c", "body").agg(F.min(place()).alias("first"), F.max(place()).alias("last"))
    verdicts = groups.groupBy("h", "c").agg(
        F.count("*").alias("bodies"), F.min("first").alias("first"), F.max("last").alias("last"))
    verdicts = verdicts.where("bodies = 1 and first <> last").select("h", "c", "first")
    return (found.drop("body").join(verdicts, ["h", "c"])
            .where(place() != F.col("first")).select("_id", "_hash", "k"))


def dedup_lines(docs, report=True):
    """The documents, text without repeated chunks, with n_lines, removed_lines and removed_chunks.

    Without ``report`` the documents keep exactly their columns.
    """
    removed = repeated_chunks(docs).groupBy("_id", "_hash").agg(F.collect_set("k").alias("_gone"))
    # Chunks are cut again after the exchange, which then carries every text once.
    joined = with_chunks(keyed(docs).join(removed, ["_id", "_hash"], "left"))
    gone = F.coalesce("_gone", F.array().cast("array<int>"))
    kept = F.filter("_chunks", lambda c: ~F.array_contains(gone, c["k"]))

    def lines(chunks):
        return F.coalesce(F.aggregate(chunks, F.lit(0), lambda n, c: n + c["lines"]), F.lit(0))

    text = F.when(F.col("_gone").isNull(), F.col("text")).otherwise(
        F.array_join(F.transform("_kept", lambda c: c["body"]), "\n"))
    joined = joined.withColumn("_kept", kept).withColumn("text", text)
    if not report:
        return joined.select(*docs.columns)
    return (joined
            .withColumn("n_lines", lines(F.col("_chunks")).cast("bigint"))
            .withColumn("removed_lines", F.col("n_lines") - lines(F.col("_kept")))
            .withColumn("removed_chunks", F.size(gone).cast("bigint"))
            .drop("_id", "_hash", "_chunks", "_gone", "_kept"))


def with_runs(docs):
    """The documents with _runs: array of (k, lines, body_hash), the shortest runs of LONG_WORDS words from and to each line."""
    def length(counts):
        """How many of the counts it takes to have LONG_WORDS words; NULL if all are too few."""
        return F.aggregate(
            counts, F.struct(F.lit(0).alias("sum"), F.lit(0).alias("n")),
            lambda so, x: F.when(so["sum"] >= LONG_WORDS, so).otherwise(
                F.struct((so["sum"] + x).alias("sum"), (so["n"] + 1).alias("n"))),
            lambda so: F.when(so["sum"] >= LONG_WORDS, so["n"]))

    def count_lines(count, i, step, rest):
        """As length of the counts from line i on; the first three lines without a loop."""
        total, n = count, F.when(count >= LONG_WORDS, 1)
        for k in (2, 3):
            total = total + F.get("_words", i + step * (k - 1))
            n = n.when(total >= LONG_WORDS, k)
        return n.otherwise(length(rest))

    # A run is one number: first line times 64, plus lines.
    def from_line(count, i):
        return i.cast("bigint") * 64 + count_lines(count, i, 1, F.slice("_words", i + 1, LONG_WORDS))

    def to_line(count, i):
        first = F.greatest(i + 1 - LONG_WORDS, F.lit(0))
        return (i + 1).cast("bigint") * 64 - 63 * count_lines(count, i, -1, F.reverse(F.slice("_words", first + 1, i + 1 - first)))

    def hashed(run):
        k, n = F.shiftright(run, 6).cast("int"), (run % 64).cast("int")
        body = F.array_join(F.slice("_lines", k + 1, n), "\n")
        return F.struct(k.alias("k"), n.alias("lines"),
                        F.when(~is_blank(body), F.unhex(F.md5(body.cast("binary")))).alias("body_hash"))

    return (docs.withColumn("_lines", F.split(F.col("text"), "\n"))
            .withColumn("_words", F.transform("_lines", words_in))
            .withColumn("_places", F.array_union(F.transform("_words", from_line), F.transform("_words", to_line)))
            .withColumn("_runs", F.transform(F.filter("_places", lambda x: x.isNotNull()), hashed))
            .drop("_lines", "_words", "_places"))


def repeated_runs(docs):
    """Lines to remove: _id, _hash, line of every repeated run but the first of each; a line may come several times."""
    found = (with_runs(keyed(docs.select("doc_id", "text"))).select("_id", "_hash", F.inline_outer("_runs"))
             .where("body_hash is not null"))
    verdicts = found.groupBy("body_hash").agg(F.min(place()).alias("first"), F.max(place()).alias("last"))
    return (found.join(verdicts.where("first <> last").select("body_hash", "first"), "body_hash")
            .where(place() != F.col("first"))
            .select("_id", "_hash", F.explode(F.sequence("k", F.col("k") + F.col("lines") - 1)).alias("line")))


def dedup_passages(docs):
    """The documents, text without repeated chunks and runs, with n_lines, removed_lines and removed_chunks.

    removed_chunks counts the chunks that lose lines.
    """
    gone = (repeated_chunks(docs).withColumn("line", F.lit(None).cast("int"))
            .unionByName(repeated_runs(docs).withColumn("k", F.lit(None).cast("int")))
            .groupBy("_id", "_hash").agg(F.collect_set("k").alias("_gone"), F.collect_set("line").alias("_covered")))
    joined = with_chunks(keyed(docs).join(gone, ["_id", "_hash"], "left"))

    def places(chunk):
        return F.sequence(chunk["start"], chunk["start"] + chunk["lines"] - 1)

    whole = F.flatten(F.transform(F.filter("_chunks", lambda c: F.array_contains("_gone", c["k"])), places))
    joined = joined.withColumn("_lost", F.array_union("_covered", whole)).withColumn("_split", F.split("text", "\n"))
    kept = F.array_except(F.sequence(F.lit(0), F.size("_split") - 1), "_lost")
    cut_text = F.array_join(F.transform(kept, lambda i: F.get("_split", i)), "\n")
    touched = F.filter("_chunks", lambda c: F.exists(places(c), lambda i: F.array_contains("_lost", i)))
    lost = F.col("_lost").isNotNull()
    return (joined.withColumn("text", F.when(lost, cut_text).otherwise(F.col("text")))
            .withColumn("n_lines", F.coalesce(F.greatest(F.size("_split"), F.lit(0)), F.lit(0)).cast("bigint"))
            .withColumn("removed_lines", F.when(lost, F.size("_lost")).otherwise(0).cast("bigint"))
            .withColumn("removed_chunks", F.when(lost, F.size(touched)).otherwise(0).cast("bigint"))
            .drop("_id", "_hash", "_chunks", "_gone", "_covered", "_lost", "_split"))


def drop_passages(docs):
    """The documents with exactly their columns, text as ``dedup_passages`` leaves it."""
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    # Kept apart, other columns can bear any name.
    packed = docs.select("doc_id", "text", F.struct(*others).alias("others")) if others else docs
    return dedup_passages(packed).select(*(F.col(f"others.`{c}`") if c in others else F.col(c) for c in docs.columns))
