"""SpotSigs fingerprints: content words that follow common words.

Every occurrence of a common word (an anchor) starts a chain of the next
``CHAIN`` content words, taken ``DISTANCE`` apart; the set of hashed chains is
the text's fingerprint, and the likeness of two texts is the Jaccard similarity
of their sets. A text without a complete chain has one signature made of all
its words, so that only texts of the same words are alike.

``near_duplicates`` partitions sets by length, so that sets that cannot reach
the threshold because of their lengths never meet, looks up the rarest
signatures of each set only (as many as are needed so that similar sets share
one), and skips a pair by its lengths before its sets are compared. Documents
of equal sets form one class; classes are compared, not copies.

All of it is DataFrame functions. Defined cases: a NULL text counts as empty;
all empty texts are alike; a NULL doc_id sorts before all others; rows of equal
doc_id are taken in order of their text's hash; a single document is its own
successor; other columns are ignored, whatever their names; an empty table
gives no rows.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from flowtally.llm.common import cut

# Common words of English, French, German and Spanish.
ANCHORS = (
    "a an and are as at be but by for from had has have he her his i in is it its not of on or she that the "
    "their they this to was were which will with you "
    "au aux avec ce dans de des du elle en est et il la le les mais ne ou par pas pour qui que se sur un une "
    "als am auf aus bei das dem den der die ein eine er es im ist mit nicht sich sie und von zu zum "
    "como con del el los las lo más mi no para pero por si sin su sus una y"
).split()
CHAIN = 2
DISTANCE = 1
LOWEST = -(1 << 63)


def with_signatures(frame, text, name, chain=CHAIN, distance=DISTANCE):
    """The frame with column ``name``: the sorted set of signatures (bigint) of column ``text``."""
    w, a, c = (f"_{name}_{part}" for part in ("words", "anchors", "content"))
    frame = frame.withColumn(w, F.split(F.lower(F.col(text)), r"[^\p{L}\p{N}]+"))
    anchors = F.transform(w, lambda word, i: F.when(word.isin(ANCHORS), i))
    frame = (frame.withColumn(a, F.filter(anchors, lambda i: i.isNotNull()))
             .withColumn(c, F.filter(w, lambda word: ~word.isin(ANCHORS) & (word != ""))))
    blank = F.when(F.get(w, F.lit(0)) == "", 1).otherwise(0)
    reach = (chain - 1) * distance

    def signature(i, k):
        first = i - k - blank
        words = [F.get(c, first + j * distance) for j in range(chain)]
        return F.when(first + reach < F.size(c), F.xxhash64(F.get(w, i), *words))

    chains = F.array_distinct(F.filter(F.transform(a, signature), lambda s: s.isNotNull()))
    frame = frame.withColumn(name, F.sort_array(chains))
    whole = F.array(F.xxhash64(F.array_join(F.filter(w, lambda word: word != ""), " ")))
    return frame.withColumn(name, F.when(F.size(name) > 0, F.col(name)).otherwise(whole)).drop(w, a, c)


def likeness(left, right):
    """Jaccard similarity of two signature sets."""
    common = F.size(F.array_intersect(left, right))
    return common / (F.size(left) + F.size(right) - common)


def digest(signatures):
    """A signature set as 32 hexadecimal digits; equal for equal sets."""
    return F.md5(F.array_join(F.transform(signatures, lambda s: s.cast("string")), ",").cast("binary"))


def with_next_text(docs, rows_per_range=1000, ranges=256):
    """doc_id, text and next_text: the text of the next document by doc_id, the first one's after the last.

    Documents are exchanged once, by ranges of doc_id; the first rows of each
    range are also sent to the range before, where they end the window.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"),
                       F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LOWEST)).alias("_n"))
    rows = docs.count()
    if not rows:
        return docs.select("doc_id", "text", F.col("text").alias("next_text"))
    parts = max(1, min(ranges, rows // rows_per_range))
    cuts = docs.agg(F.percentile_approx("_n", [i / parts for i in range(1, parts)] or [0.5], 10_000)).first()[0]
    cuts = sorted(set(cuts)) if parts > 1 else []

    def placed(frame):
        below = F.lit(0) if not cuts else F.size(F.filter(
            F.array(*(F.lit(c) for c in cuts)), lambda b: b <= F.col("_n")))
        return frame.withColumn("_range", below)

    firsts = placed(docs.select("_n")).groupBy("_range").agg(F.min("_n").alias("low")).orderBy("_range").collect()
    before = F.lit(None).cast("int")
    for i, row in enumerate(firsts):
        before = F.when((F.col("_range") == row["_range"]) & (F.col("_n") == row["low"]),
                        F.lit(firsts[i - 1]["_range"])).otherwise(before)
    places = F.array(F.struct(F.col("_range").alias("_at"), F.lit(0).alias("_extra")),
                     F.struct(before.alias("_at"), F.lit(1).alias("_extra")))
    order = Window.partitionBy("_at").orderBy("_extra", "_n", F.xxhash64("text"))
    return (placed(docs).select("doc_id", "text", "_n", F.inline(places)).where("_at is not null")
            .withColumn("next_text", F.lead("text").over(order))
            .where("_extra = 0").select("doc_id", "text", "next_text"))


def with_edited_text(frame):
    """The frame with n_chars and edited_text: the second half replaced by the start of next_text."""
    half = F.floor(F.col("n_chars") / 2).cast("int")
    return (frame.withColumn("n_chars", F.char_length("text").cast("bigint"))
            .withColumn("edited_text", F.concat(
                F.substring(F.col("text"), F.lit(1), (F.col("n_chars") - half).cast("int")),
                F.substring(F.col("next_text"), F.lit(1), half))))


def fingerprints(docs):
    """doc_id with the signature sets of its text, its edited text and the next document's text."""
    frame = with_edited_text(with_next_text(docs))
    frame = with_signatures(frame, "text", "signatures")
    frame = with_signatures(frame, "edited_text", "edited_signatures")
    return with_signatures(frame, "next_text", "next_signatures")


def near_duplicates(docs, threshold=0.8):
    """Links (a, b, likeness), a < b, between class representatives, and membership (doc_id, class_id).

    A class is named by the smallest doc_id of its equal sets.
    """
    frame = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    sets = cut(with_signatures(frame, "text", "signatures").select("doc_id", "signatures"), "spotsigs")
    classes = cut(sets.groupBy("signatures").agg(F.min("doc_id").alias("class_id")), "spotsigs")
    members = sets.join(classes, "signatures").select("doc_id", "class_id")
    classes = classes.select("class_id", "signatures", F.size("signatures").alias("n"))
    spotted = classes.select("class_id", "n", F.explode("signatures").alias("s"))
    rarity = spotted.groupBy("s").agg(F.count("*").alias("df"))
    order = Window.partitionBy("class_id").orderBy("df", "s")
    prefix = (spotted.join(rarity, "s").withColumn("rank", F.row_number().over(order))
              .where(F.col("rank") <= F.col("n") - F.ceil(F.col("n") * threshold) + 1))
    # Sets whose lengths differ by more than the threshold are at least two partitions apart.
    part = F.floor(F.log(F.col("n")) / -F.log(F.lit(threshold))).cast("int")
    prefix = cut(prefix.select("class_id", "n", "s", part.alias("part")), "spotsigs")
    left = prefix.select(F.col("class_id").alias("a"), F.col("n").alias("na"), "s", "part")
    right = prefix.select(F.col("class_id").alias("b"), F.col("n").alias("nb"), "s",
                          F.explode(F.array(F.col("part") - 1, F.col("part"), F.col("part") + 1)).alias("part"))
    fits = (F.col("a") < F.col("b")) & (F.least("na", "nb") >= F.greatest("na", "nb") * threshold)
    pairs = left.join(right, ["s", "part"]).where(fits).select("a", "b").distinct()
    one, two = (classes.select(F.col("class_id").alias(x), F.col("signatures").alias(f"s{x}")) for x in "ab")
    links = (pairs.join(one, "a").join(two, "b").withColumn("likeness", likeness("sa", "sb"))
             .where(F.col("likeness") >= threshold).select("a", "b", "likeness"))
    return links, members
