"""Collocations of two to four words, counted by direct-address tiling.

Level by level: words, then pairs (word, word), then pairs (frequent pair,
word), then (frequent triple, word). The symbols of a level that occur often
enough are ranked by frequency; the ``HEAD`` most frequent are known by their
rank, numbered language by language. A task splits its pairs of ranks into
tiles of ``TILE`` by ``TILE``: a well-filled tile is counted by one dense bincount over its
cells, the pairs of all other tiles as sorted coordinates (COO). Symbols
beyond the head go by their 64-bit hash and are counted as sorted coordinates too, so
there is no cap. A task hands on sums, one exchange adds them up, and pairs
with ``least`` occurrences are the symbols of the next level.

A phrase is at most as frequent as its parts. So a task looks a part up before
it counts: in a bitmap of ``BITS`` bits that holds every frequent symbol of the
level. A false hit costs a row, never a wrong count. What is sent to the tasks
is bounded by ``HEAD`` and ``BITS`` at any size of the corpus.

Hashes are seeded; should two symbols of a level share one, the whole count
starts again with another seed, so counts are exact. Texts are read once per
level, documents are never exchanged. Scores, the parts of each cut and the
phrases inside longer ones are joins on (lang, phrase).

Defined cases: NULL and empty texts have no words; a NULL lang is ``und``; a
document that is there twice counts twice; other columns are ignored, whatever
their names; an empty table gives no rows.
"""

import functools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Window
from pyspark.sql import functions as F

from flowtally.llm.common import cut, text_bytes

LEAST = 30
LONGEST = 4
TOP = 2000
HEAD = 1 << 18
TILE = 1 << 10
BITS = 1 << 26
# Tokens a task gathers before it counts, distinct words it keeps, and rows it hands on at a time.
TOKENS = 1_000_000
WORDS = 300_000
ROWS = 65_536

BREAK = b"\xff"
_BREAKS = bytes.maketrans(b".,;:!?\n\x0b\x0c\r", BREAK * 10)
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
ABSENT, TAIL = -2, -1


def tokens(text):
    """Lower-cased (A-Z) words of a text, with ``BREAK`` between its pieces."""
    return text_bytes(text).lower().translate(_BREAKS).replace(BREAK, b" \xff ").split()


def _join(a, b):
    """Hash of a symbol made of two."""
    x = a * _M1 + b
    x ^= x >> np.uint64(32)
    x *= _M2
    return x ^ x >> np.uint64(29)


def _second(joined, a):
    """The second of two symbols, from their joint hash and the first; every step of the hash can be undone."""
    x = joined ^ joined >> np.uint64(29) ^ joined >> np.uint64(58)
    x *= np.uint64(pow(int(_M2), -1, 1 << 64))
    x ^= x >> np.uint64(32)
    return x - a * _M1


class Level:
    """The frequent symbols of a level: ranks of the head, a bitmap of all."""

    def __init__(self, head, spots, bits):
        """``head``: hashes in order of rank; ``spots``: (number of a 64-bit word of the bitmap, its bits)."""
        self.by_rank = head
        self.ranks = np.argsort(head, kind="stable").astype(np.int32)
        self.hashes = head[self.ranks]
        self.shift = np.uint64(64 - (bits.bit_length() - 1))
        self.bitmap = np.zeros(bits >> 6, dtype=np.uint64)
        self.bitmap[spots[0]] = spots[1]

    def rank(self, hashes):
        """Rank of each symbol, TAIL for a frequent one beyond the head, ABSENT for all others."""
        spot = hashes >> self.shift
        known = (self.bitmap[spot >> np.uint64(6)] >> (spot & np.uint64(63))) & np.uint64(1) == 1
        out = np.where(known, np.int32(TAIL), np.int32(ABSENT))
        if len(self.hashes):
            wanted = hashes[known]
            place = np.minimum(np.searchsorted(self.hashes, wanted), len(self.hashes) - 1)
            out[known] = np.where(self.hashes[place] == wanted, self.ranks[place], np.int32(TAIL))
        return out


def tiled(left, right, head):
    """Counts of pairs of ranks below ``head``: left ranks, right ranks, counts.

    Pairs are brought into the order of their tiles; a tile with at least one
    pair for 32 cells is counted densely.
    """
    side = TILE.bit_length() - 1
    across = -(-head >> side)
    tile = (left >> side).astype(np.int64) * across + (right >> side)
    cell = ((left & (TILE - 1)) << side | right & (TILE - 1)).astype(np.int64)
    order = np.argsort(tile.astype(np.uint16) if across <= 256 else tile, kind="stable")
    tile, cell = tile[order], cell[order]
    starts = np.concatenate([[0], np.flatnonzero(tile[1:] != tile[:-1]) + 1, [len(tile)]]) if len(tile) else np.zeros(1, int)
    dense = np.diff(starts) >= TILE * TILE // 32
    codes, counts, sparse = [], [], np.ones(len(tile), dtype=bool)
    for a, b in zip(starts[:-1][dense], starts[1:][dense]):
        cells = np.bincount(cell[a:b], minlength=TILE * TILE)
        hit = np.flatnonzero(cells)
        codes.append(tile[a] * (TILE * TILE) + hit)
        counts.append(cells[hit])
        sparse[a:b] = False
    coo = np.unique(tile[sparse] * (TILE * TILE) + cell[sparse], return_counts=True)
    codes, counts = np.concatenate([*codes, coo[0]]).astype(np.int64), np.concatenate([*counts, coo[1]])
    tile, cell = codes // (TILE * TILE), codes % (TILE * TILE)
    return (tile // across << side) + (cell >> side), (tile % across << side) + (cell & (TILE - 1)), counts


def sorted_counts(a, b):
    """Counts of pairs of hashes as sorted coordinates: a, b, counts."""
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    first = np.ones(len(a), dtype=bool)
    first[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    places = np.flatnonzero(first)
    return a[places], b[places], np.diff(np.append(places, len(a)))


class _Words(dict):
    """The words of one language: word -> number; hashes by number."""

    def __init__(self, lang, seed):
        self.seed = xxhash.xxh64_intdigest(lang.encode("utf-8", "replace"), seed)
        self.hashes = []
        self[BREAK]

    def __missing__(self, word):
        self[word] = number = len(self)
        self.hashes.append(xxhash.xxh64_intdigest(word, self.seed))
        return number


def _streams(batches, seed):
    """Per language the numbers of words in order, ``TOKENS`` or so at a time: (words, [arrays])."""
    streams, size = {}, 0
    for batch in batches:
        langs, texts = batch.column(0).to_pylist(), batch.column(1)
        for i, lang in enumerate(langs):
            lang = "und" if lang is None else lang
            if lang not in streams:
                streams[lang] = (_Words(lang, seed), [])
            words, parts = streams[lang]
            found = tokens(texts[i].as_py())
            parts.append(np.fromiter(map(words.__getitem__, found), dtype=np.int32, count=len(found)))
            parts.append(np.zeros(1, dtype=np.int32))
            size += len(found)
            if size >= TOKENS:
                yield streams
                streams = {k: (w, []) for k, (w, _) in streams.items()}
                if sum(len(w) for w, _ in streams.values()) > WORDS:
                    streams = {}
                size = 0
    yield streams


def _texts(docs):
    return docs.select(F.col("lang").cast("string").alias("lang"), "text")


def word_counts(docs, seed):
    """Rows (h, lang, phrase, f) of all words; phrase is NULL in the row of a language's total."""
    def run(batches):
        for streams in _streams(batches, seed):
            for lang, (words, parts) in streams.items():
                counts = np.bincount(np.concatenate(parts) if parts else [], minlength=len(words)).astype(np.int64)
                counts[0] = 0
                hit = np.flatnonzero(counts)
                names = list(words)
                hashes = np.append(np.array(words.hashes, dtype=np.uint64)[hit], [np.uint64(0)]).view(np.int64)
                phrases = [*(names[k].decode("utf-8", "replace") for k in hit), None]
                counts = np.append(counts[hit], [counts.sum()])
                for at in range(0, len(counts), ROWS):
                    part = slice(at, at + ROWS)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(hashes[part]), pa.array([lang] * len(counts[part]), pa.string()),
                         pa.array(phrases[part], pa.string()), pa.array(counts[part])], names=["h", "lang", "phrase", "f"])

    rows = _texts(docs).mapInArrow(run, "h long, lang string, phrase string, f long")
    return rows.groupBy("h", "lang", "phrase").agg(F.sum("f").alias("f"))


def _pairs(hashes, levels):
    """Pairs (symbol, next word) of the level after ``levels`` in a stream of words: a, its rank, b, its rank."""
    first = levels[0]
    symbols, ranks = hashes, first.rank(hashes)
    ranks[hashes == 0] = ABSENT
    word_ranks = ranks
    for width, level in enumerate([*levels[1:], None], start=1):
        # Both the symbol and the one a word further are frequent, and so is the word after it.
        ok = np.flatnonzero((ranks[:-1] > ABSENT) & (ranks[1:] > ABSENT))
        a, b = symbols[ok], hashes[ok + width]
        if level is None:
            return a, ranks[ok], b, word_ranks[ok + width]
        symbols, ranks = np.zeros(len(symbols) - 1, dtype=np.uint64), np.full(len(symbols) - 1, ABSENT, dtype=np.int32)
        symbols[ok] = _join(a, b)
        ranks[ok] = level.rank(symbols[ok])


def pair_counts(docs, sent, seed):
    """Rows (h, a, f, clash): pairs of a frequent symbol ``a`` and the word after it; whether two share the hash.

    The word follows from h and a, so pairs of equal h and a are equal.
    """
    def run(batches):
        levels = sent.value
        for streams in _streams(batches, seed):
            for words, parts in streams.values():
                numbers = np.concatenate(parts) if parts else np.zeros(0, dtype=np.int32)
                if len(numbers) <= len(levels):
                    continue
                known = np.array(words.hashes, dtype=np.uint64)
                known[0] = 0
                a, left, b, right = _pairs(known[numbers], levels)
                head = (left >= 0) & (right >= 0)
                x, y, counts = tiled(left[head], right[head], max(len(levels[-1].by_rank), len(levels[0].by_rank), 1))
                rest = sorted_counts(a[~head], b[~head])
                a = np.concatenate([levels[-1].by_rank[x], rest[0]])
                joined = _join(a, np.concatenate([levels[0].by_rank[y], rest[1]]))
                counts = np.concatenate([counts, rest[2]]).astype(np.int64)
                for at in range(0, len(a), ROWS):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(z[at:at + ROWS].view(np.int64)) for z in (joined, a, counts)], names=["h", "a", "f"])

    rows = _texts(docs).mapInArrow(run, "h long, a long, f long")
    return rows.groupBy("h").agg(F.min("a").alias("a"), F.sum("f").alias("f"), (F.min("a") != F.max("a")).alias("clash"))


def _with_words(pairs):
    """Pairs with the hash ``b`` of their second symbol."""
    def run(batches):
        for batch in batches:
            h, a = (batch.column(k).to_numpy().view(np.uint64) for k in (0, 1))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(_second(h, a).view(np.int64))], names=["h", "a", "f", "b"])

    return pairs.select("h", "a", "f").mapInArrow(run, "h long, a long, f long, b long")


def _level(symbols, head, bits):
    """The :class:`Level` of a table (h, lang, f). What is gathered is bounded by ``head`` and ``bits``."""
    step = F.floor(F.log2("f") * 16).cast("int")
    steps = sorted(map(tuple, symbols.groupBy(step.alias("s")).count().collect()), reverse=True)
    room, lowest = head, 1 << 20
    for s, n in steps:
        room -= n
        if room < 0:
            break
        lowest = s
    top = symbols.where(step >= lowest).select("h", "lang", "f").toArrow().sort_by(
        [("lang", "ascending"), ("f", "descending"), ("h", "ascending")])
    spot = F.shiftrightunsigned("h", 64 - (bits.bit_length() - 1))
    spots = symbols.select(
        F.shiftright(spot, 6).alias("at"), spot.bitwiseAND(F.lit(63)).cast("int").alias("bit")).groupBy("at").agg(
        F.expr("bit_or(shiftleft(1L, bit))").alias("set"))
    spots = spots.toArrow()
    return Level(top["h"].to_numpy().view(np.uint64), (spots["at"].to_numpy(), spots["set"].to_numpy().view(np.uint64)), bits)


def _counted(docs, least, head, bits, seed):
    """Totals (lang, n) and tables (h, lang, phrase, f) of frequent words and phrases, a table for each length; None if hashes clash."""
    spark = docs.sparkSession
    words = cut(word_counts(docs, seed), "words")
    totals = words.where("phrase is null").groupBy("lang").agg(F.sum("f").alias("n"))
    words = words.where("phrase is not null")
    if not words.groupBy("h").count().where("count > 1").isEmpty():
        return None
    tables = [words.where(F.col("f") >= least)]
    levels = [_level(tables[0], head, bits)]
    for size in range(2, LONGEST + 1):
        pairs = pair_counts(docs, spark.sparkContext.broadcast(levels), seed).where(F.col("f") >= least)
        pairs = cut(pairs, f"pairs-{size}")
        if not pairs.where("clash").isEmpty():
            return None
        left = tables[-1].select(F.col("h").alias("a"), "lang", F.col("phrase").alias("first"))
        right = tables[0].select(F.col("h").alias("b"), F.col("phrase").alias("last"))
        named = _with_words(pairs).join(left, "a").join(right, "b").select("h", "lang", F.concat_ws(" ", "first", "last").alias("phrase"), "f")
        tables.append(cut(named, f"phrases-{size}"))
        if size < LONGEST:
            levels.append(_level(tables[-1], head, bits))
    return totals, tables


def _wide(column):
    return column.cast("decimal(20,0)")


def collocations(docs, least=LEAST, top=TOP, head=HEAD, bits=BITS, seed=0):
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    a, l and r count the phrase and the two parts of its lowest-scoring cut, n all words.
    """
    found = None
    while found is None:
        found, seed = _counted(docs, least, head, bits, seed), seed + 1
    totals, tables = found
    counts = functools.reduce(lambda x, y: x.unionByName(y), [t.select("lang", "phrase", "f") for t in tables])
    phrases = functools.reduce(lambda x, y: x.unionByName(y), [
        t.select("lang", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("words")) for t in tables[1:]])

    def text(start, length):
        return F.array_join(F.slice("words", start, length), " ")

    size = F.size("words")
    # Phrases inside longer candidates, with the highest count of any of those.
    inner = F.flatten(F.transform(F.sequence(F.lit(2), size - 1), lambda n: F.transform(
        F.sequence(F.lit(1), size - n + 1), lambda at: text(at, n))))
    inside = phrases.where(size > 2).select("lang", "a", F.explode(inner).alias("phrase"))
    covered = inside.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = phrases.join(covered, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (_wide(F.col("longer")) * 100 < _wide(F.col("a")) * 80))
    cuts = kept.select("lang", "phrase", "a", F.inline(F.transform(F.sequence(F.lit(1), size - 1), lambda k: F.struct(
        k.alias("k"), text(1, k).alias("first"), text(k + 1, size - k).alias("rest")))))
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    score = F.call_function("div", _wide(F.col("a")) * F.lit(2_000_000).cast("decimal(7,0)"), _wide(F.col("l")) + _wide(F.col("r")))
    best = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.cast("bigint").alias("score"), "k", "l", "r")).alias("cut"))
    ranked = best.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score").withColumn("rank", F.row_number().over(
        Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))))
    return ranked.where(F.col("rank") <= top).join(totals, "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def oracle(least=LEAST, top=TOP):
    """The same in SQL for DuckDB."""
    return f"""
with pieces as (
  select coalesce(lang, 'und') as lang,
    unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[.,;:!?\\x0A-\\x0D]')) as piece from documents),
words as (
  select lang, list_filter(regexp_split_to_array(piece, '[ \\t]+'), lambda w: w <> '') as w from pieces),
grams as (
  select lang, s.size as size, unnest(list_transform(range(1, len(w) - s.size + 2), lambda i: array_to_string(w[i:i + s.size - 1], ' '))) as phrase
  from words, (select unnest(range(1, {LONGEST + 1})) as size) s where len(w) >= s.size),
counts as (select lang, size, phrase, count(*) as f from grams group by all having count(*) >= {least}),
totals as (select lang, sum(len(w))::bigint as n from words group by lang),
candidates as (select lang, size, phrase, f as a, string_split(phrase, ' ') as w from counts where size > 1),
inside as (
  select lang, a, unnest(list_transform(range(1, size - s.n + 2), lambda i: array_to_string(w[i:i + s.n - 1], ' '))) as phrase
  from candidates, (select unnest(range(2, {LONGEST})) as n) s where s.n < size),
covered as (select lang, phrase, max(a) as longer from inside group by all),
kept as (
  select c.* from candidates c left join covered v using (lang, phrase)
  where v.longer is null or 100::hugeint * v.longer < 80::hugeint * c.a),
cuts as (
  select lang, phrase, a, s.k, array_to_string(w[1:s.k], ' ') as first, array_to_string(w[s.k + 1:], ' ') as rest
  from kept, (select unnest(range(1, {LONGEST})) as k) s where s.k < size),
scored as (
  select t.lang, t.phrase, t.a, t.k, x.f as l, y.f as r, (2000000::hugeint * t.a // (x.f + y.f))::bigint as score
  from cuts t join counts x on x.lang = t.lang and x.phrase = t.first join counts y on y.lang = t.lang and y.phrase = t.rest),
best as (select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from best)
select lang, rank, phrase, a, l, r, n, score from ranked join totals using (lang) where rank <= {top}"""
