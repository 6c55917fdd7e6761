"""Benchmark overlaps by spaced-seed hashing.

Fixed masks look at some token positions of a span and ignore the others, so
that a replaced word between them does not matter. The three masks of weight
five below hit every stretch of ten tokens with up to two replaced ones. Hashes
under the masks of all benchmark positions are joined with those of all
document positions; each hit fixes an item and an offset, along which document
and item are compared word by word: the best stretch in which a match counts 1
and a replaced word -4 (so at least 80 % match) is an overlap if enough words match.

The benchmark is taken in blocks of bounded size, each checked before it is
sent to the tasks and joined there with all documents; a larger benchmark means
more blocks, never a larger one (an item longer than a block is a block of its
own). Documents are not shuffled, so a hot source or a group of copies changes
nothing. Words that no item has cannot be part of a hit and are skipped first.

Words: A-Z lower-cased, then runs of letters, digits and non-ASCII characters.
Items of fewer words than a mask spans are looked up whole; items of under five
words are no evidence and give no overlap.

Defined cases: NULL or empty texts and items give no overlap; repeated rows give
their overlaps each; items of equal text are reported each; columns other than
doc_id, text, item_id are ignored; an empty table on either side gives no rows.
"""

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from flowtally.llm.common import text_bytes

MASKS = ((0, 1, 2, 3, 4), (0, 1, 2, 4, 5), (0, 1, 3, 6, 7))
SHORTEST = 5
PENALTY = 4
BLOCK_CHARS = 4_000_000
SCHEMA = "doc_id long, item_id long, start_word long, end_word long, item_start long, n_matches long, identity double"
NAMES = re.findall(r"(\w+) \w+", SCHEMA)
TYPES = [pa.int64()] * 6 + [pa.float64()]
BLANKED = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def tokens(text):
    return text_bytes(text).lower().translate(BLANKED).split()


def best_stretch(equal):
    """(start, end) of the stretch of highest score: 1 for a match, -PENALTY for a replaced word."""
    score = np.concatenate([[0], np.cumsum(np.where(equal, 1, -PENALTY))])
    gain = score - np.minimum.accumulate(score)
    end = int(np.argmax(gain))
    start = int(np.flatnonzero(score[:end + 1] == score[:end + 1].min())[-1]) if end else 0
    return start, end


class Index:
    """Seed hashes of a block of items."""

    def __init__(self, items, min_matches):
        self.min_matches, self.items, vocabulary = min_matches, [], {}
        for item_id, text in items:
            words = tokens(text)
            if len(words) >= SHORTEST:
                codes = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words]
                self.items.append((item_id, np.array(codes, dtype=np.int64)))
        self.vocabulary = vocabulary
        rng = np.random.default_rng(20240115)
        self.values = np.concatenate([[0], rng.integers(1, 1 << 62, len(vocabulary))]).astype(np.uint64)
        spans = {len(c) for _, c in self.items}
        self.masks = [(m, None) for m in MASKS] + [
            (tuple(range(n)), n) for n in sorted(spans) if n <= max(m[-1] for m in MASKS)]
        self.seeds = []
        for mask, only in self.masks:
            hashes, places = [], []
            for k, (_, codes) in enumerate(self.items):
                if only in (None, len(codes)) and len(codes) > mask[-1]:
                    at = np.arange(len(codes) - mask[-1])
                    hashes.append(self.hash(codes, at, mask))
                    places.append(np.stack([np.full(len(at), k), at], axis=1))
            hashes = np.concatenate(hashes) if hashes else np.zeros(0, dtype=np.uint64)
            places = np.concatenate(places) if places else np.zeros((0, 2), dtype=np.int64)
            order = np.argsort(hashes, kind="stable")
            self.seeds.append((hashes[order], places[order]))

    def hash(self, codes, at, mask):
        out = np.zeros(len(at), dtype=np.uint64)
        for o in mask:
            out = out * np.uint64(0x9E3779B97F4A7C15) + self.values[codes[at + o]]
        return out

    def hits(self, codes):
        """(item, offset) pairs that a seed proposes for a document's codes."""
        found = set()
        known = codes > 0
        for (mask, _), (hashes, places) in zip(self.masks, self.seeds):
            n = len(codes) - mask[-1]
            if n <= 0 or not len(hashes):
                continue
            full = known[:n].copy()
            for o in mask[1:]:
                full &= known[o:o + n]
            at = np.flatnonzero(full)
            seeds = self.hash(codes, at, mask)
            left = np.searchsorted(hashes, seeds, "left")
            right = np.searchsorted(hashes, seeds, "right")
            for i in np.flatnonzero(right > left):
                for k, q in places[left[i]:right[i]]:
                    found.add((int(k), int(at[i] - q)))
        return found

    def overlaps(self, text):
        """The best overlap of a text with each item that it shares one with."""
        words = tokens(text)
        get = self.vocabulary.get
        codes = np.fromiter((get(w, 0) for w in words), dtype=np.int64, count=len(words))
        best = {}
        for k, shift in self.hits(codes):
            item_id, item = self.items[k]
            a, b = max(0, -shift), min(len(item), len(codes) - shift)
            equal = codes[shift + a:shift + b] == item[a:b]
            start, end = best_stretch(equal)
            matches = int(equal[start:end].sum())
            if matches >= min(self.min_matches, len(item)):
                found = (matches, -(shift + a + start), shift + a + end, a + start, matches / (end - start))
                best[k] = max(best.get(k, found), found)
        return [(self.items[k][0], -x[1], x[2], x[3], x[0], x[4]) for k, x in sorted(best.items())]


def _indexes(items, min_matches):
    """Broadcast indexes, one for each block of items."""
    spark = items.sparkSession
    items = items.select(F.col("item_id").cast("bigint").alias("item_id"),
                         F.coalesce("text", F.lit("")).alias("text"))
    chars = items.agg(F.sum(F.length("text") + 1)).first()[0] or 0
    blocks = -(-chars // BLOCK_CHARS)
    for block in range(blocks):
        chosen = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        rows = sorted(map(tuple, chosen), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        yield spark.sparkContext.broadcast(Index(rows, min_matches))


def overlaps(docs, items, min_matches=10):
    """One row per document and item that overlap: the longest overlap, word positions from 0."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    found = docs.sparkSession.createDataFrame([], SCHEMA)
    for sent in _indexes(items, min_matches):
        def run(batches, sent=sent):
            for batch in batches:
                texts = batch.column(1)
                rows = [(doc_id, *values) for i, doc_id in enumerate(batch.column(0).to_pylist())
                        for values in sent.value.overlaps(texts[i].as_py())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * len(NAMES), TYPES)], names=NAMES)

        found = found.union(docs.mapInArrow(run, SCHEMA))
    return found


def drop_contaminated(docs, items, min_matches=10):
    """Documents without an overlap with any item, with all their columns."""
    at = docs.columns.index("text")
    for sent in _indexes(items, min_matches):
        def run(batches, sent=sent):
            for batch in batches:
                texts = batch.column(at)
                clean = [not sent.value.overlaps(texts[i].as_py()) for i in range(batch.num_rows)]
                yield batch.filter(pa.array(clean, pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
