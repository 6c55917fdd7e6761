"""Licence scan by a positional index of rare licence words.

Templates list words at relative positions; ``*`` stands for a word that is too
common to be looked up. A file's licence words are kept with their positions.
For each template that a file's words point to, the word of highest IDF (over
all files) that file and key phrase share is looked up: every position of it
proposes a place of the template. At each proposed place the other postings are
intersected by relative position; a place counts if the mandatory key phrase is
complete and at least ``SUPPORT`` of the template's listed words are there.

Since a place has all words of its key phrase, it has the one looked up, so no
place of a base phrase is missed. Only licence words leave the first step,
which is written once with a row number of its own: texts are read once and
never shuffled. The index is fixed and small; IDF has a row per licence word.

All of it is DataFrame functions. Defined cases: a NULL text counts as empty:
no words, no places, score 0; repeated rows are scanned each; other columns are
ignored, whatever their names; an empty table gives no rows.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from flowtally.llm.common import cut, lower_ascii

# Phrases and labels every scan reports.
BASE = [
    ("gpl", "gnu general public license"),
    ("apache", "apache license"),
    ("cc-by", "cc by"),
    ("mit", "mit license"),
]
# Further templates: label, words, key phrase within them.
TEMPLATES = [
    ("gpl-2.0", "gnu general public license version 2", "gnu general public license version 2"),
    ("gpl-3.0", "gnu general public license version 3", "gnu general public license version 3"),
    ("lgpl", "gnu lesser general public license", "gnu lesser general public license"),
    ("agpl", "gnu affero general public license", "gnu affero general public license"),
    ("mpl-2.0", "mozilla public license version 2 0", "mozilla public license version 2 0"),
    ("apache-2.0", "licensed under * apache license version 2 0", "apache license version 2 0"),
    ("cc-by-nc", "cc by nc", "cc by nc"),
    ("cc-by-nd", "cc by nd", "cc by nd"),
    ("cc-by-sa", "cc by sa", "cc by sa"),
    ("bsd", "redistribution * use * source * binary forms * * without modification * permitted",
     "redistribution * use * source * binary forms"),
    ("mit", "permission * hereby granted free * charge * * person obtaining * copy",
     "permission * hereby granted free * charge"),
]
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
SUPPORT = 0.8


def postings():
    """(label, base, position, word, key) of every listed word of every template."""
    rows = []
    for base, (label, text, key) in [(True, (n, p, p)) for n, p in BASE] + [(False, t) for t in TEMPLATES]:
        words, phrase = text.split(), key.split()
        at = next(i for i in range(len(words)) if words[i:i + len(phrase)] == phrase)
        rows += [(f"{label}/{'base' if base else 'own'}", label, base, i, w, at <= i < at + len(phrase))
                 for i, w in enumerate(words) if w != "*"]
    return rows


INDEX = postings()
VOCABULARY = sorted({row[4] for row in INDEX})


def licence_words(docs):
    """row, doc_id, n_words and hits (position, word) of the licence words of every text."""
    blank = F.when(F.get("_words", F.lit(0)) == "", 1).otherwise(0)
    last = F.when((F.size("_words") > 1) & (F.element_at("_words", -1) == ""), 1).otherwise(0)

    def hit(word, i):
        return F.when(F.lower(word).isin(VOCABULARY),
                      F.struct((i - blank).alias("pos"), lower_ascii(word).alias("word")))

    frame = docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id",
        F.split(F.coalesce("text", F.lit("")), SEPARATORS).alias("_words"))
    return cut(frame.select(
        "row", "doc_id", (F.size("_words") - blank - last).cast("bigint").alias("n_words"),
        F.filter(F.transform("_words", hit), lambda h: h.isNotNull()).alias("hits")), "licences")


def places(files):
    """row, label, base, start and support (share of listed words) of every verified place."""
    spark = files.sparkSession
    index = F.broadcast(spark.createDataFrame(
        INDEX, "template string, label string, base boolean, at int, word string, key boolean"))
    hits = files.where(F.size("hits") > 0).select("row", F.inline("hits"))
    present = hits.select("row", "word").distinct()
    # One row per licence word at most.
    idf = present.groupBy("word").agg((-F.log(F.count("*"))).alias("idf"))
    rarest = Window.partitionBy("row", "template").orderBy(F.desc("idf"), "word")
    keys = index.where("key").select("template", "word").distinct()
    chosen = (present.join(F.broadcast(idf), "word").join(F.broadcast(keys), "word")
              .withColumn("rank", F.row_number().over(rarest)).where("rank = 1")
              .select("row", "template", "word"))
    proposed = (hits.join(chosen, ["row", "word"]).join(index.where("key"), ["template", "word"])
                .select("row", "template", (F.col("pos") - F.col("at")).alias("start")).distinct())
    expected = proposed.join(index, "template").withColumn("pos", F.col("start") + F.col("at"))
    found = expected.join(hits, ["row", "pos", "word"]).groupBy("row", "template", "label", "base", "start").agg(
        F.count("*").alias("n"), F.sum(F.col("key").cast("int")).alias("n_key"))
    sizes = index.groupBy("template").agg(
        F.count("*").alias("listed"), F.sum(F.col("key").cast("int")).alias("listed_key"))
    return (found.join(F.broadcast(sizes), "template")
            .withColumn("support", F.col("n") / F.col("listed"))
            .where((F.col("n_key") == F.col("listed_key")) & (F.col("support") >= SUPPORT))
            .select("row", "label", "base", F.col("start").cast("bigint").alias("start"), "support"))


def scan(docs):
    """Every document with n_words, n_base, first_word, last_word, base_labels, labels and score."""
    files = licence_words(docs)
    base = F.col("base")

    def labels(column):
        return F.concat_ws(",", F.sort_array(F.collect_set(column)))

    found = places(files).groupBy("row").agg(
        F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("start"))).alias("first_word"),
        F.max(F.when(base, F.col("start"))).alias("last_word"),
        labels(F.when(base, F.col("label"))).alias("base_labels"),
        labels("label").alias("labels"), F.max("support").alias("score"))
    return files.drop("hits").join(found, "row", "left").drop("row").fillna(
        {"n_base": 0, "base_labels": "", "labels": "", "score": 0.0})


def oracle():
    """The same result as SQL over ``documents``."""
    index = ", ".join(
        f"('{t}', '{n}', {str(b).lower()}, {a}, '{w}', {str(k).lower()})" for t, n, b, a, w, k in INDEX)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
with listed(template, label, base, pos, word, key) as (values {index}),
sizes as (select template, count(*) as n, sum(key::int) as n_key from listed group by template),
texts as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as words from documents),
words as (select doc_id, unnest(words) as word, generate_subscripts(words, 1) - 1 as pos from texts),
found as (
  select w.doc_id, l.template, l.label, l.base, w.pos - l.pos as start,
    count(*) as n, sum(l.key::int) as n_key
  from words w join listed l on w.word = l.word group by all),
places as (
  select f.doc_id, f.label, f.base, f.start, f.n / s.n as support
  from found f join sizes s using (template) where f.n_key = s.n_key and f.n / s.n >= {SUPPORT}),
per_file as (
  select doc_id, count(*) filter (where base) as n_base,
    min(start) filter (where base) as first_word, max(start) filter (where base) as last_word,
    string_agg(distinct label, ',' order by label) filter (where base) as base_labels,
    string_agg(distinct label, ',' order by label) as labels, max(support) as score
  from places group by doc_id)
select t.doc_id, len(t.words)::bigint as n_words, coalesce(p.n_base, 0)::bigint as n_base,
  p.first_word::bigint as first_word, p.last_word::bigint as last_word,
  coalesce(p.base_labels, '') as base_labels, coalesce(p.labels, '') as labels,
  coalesce(p.score, 0.0)::double as score
from texts t left join per_file p using (doc_id)"""
