"""Probabilistic suffix tree over words: variable-length contexts scored by their longest suffix state.

States of words. Every one or two words of the training corpus, or a text's
start, that come before a word are a candidate, however rare, and every
word met there twice or more is one of its next words. A word met once is not: left
out, it has no count there to be told by. A candidate becomes a state if, each
occurrence left out in turn, its next words are likelier than in its suffix. A state's next words
are absolutely discounted, what is left goes to the suffix (interpolation). No
state, next word or count is dropped for its share or rank. They are spread over blocks and
shards, and grow with the corpus; two words are the greatest depth.

Below them stands a small tree of symbols, which smooths words that no state
of words knows. Words of at least ``SYMBOL`` of all training tokens are symbols of
their own; all other words are symbols by their ending, where an ending has
that share, or one common symbol. A context sees coarser symbols (share
``CONTEXT``). A context of one or two symbols becomes a state if the divergence of
its next symbols from those of its suffix, times its count, exceeds half a log
of the corpus size for each symbol it keeps. It keeps the symbols of share
PAIR together with it, absolutely discounted; what is left goes to its suffix,
at the root to the smoothed share (c + 0.1) / (N + 0.1 (V + 1)).
A word with a symbol shared by many gets its part of the root's share of the symbol.
Its shares bound this tree, so that it can be sent to the tasks; what it leaves out is
in the states of words.

Blocks. Texts are split once, into blocks of about ``BLOCK`` tokens with numbers for the
words of the block; all later work is done on these. What a block has to know of
the whole corpus it asks for: it sends each of its words, pairs or triples once, as sorted
64-bit hashes with its own counts, to the shards of the hashes; a shard adds up
and answers each block in the same order. So it learns how often
words, pairs and triples occur, and for each context how often it is followed by
next words met twice, how many they are, and whether it is a state. A block that has n of
the N places of a pair or triple gives n / N of what that adds to its context, so that all
blocks together give it once. However frequent a key, a block sends it once. No table is
joined and nothing of the states of words passes through the driver; with all answers
a block scores its own texts. Words, pairs and triples are matched by 64-bit hash.

Defined cases: a NULL text counts as empty and has one token, the end; a NULL
doc_id counts as ''; repeated rows are learned and scored each; without any
training text all words are unseen; other columns are ignored, whatever their
names; an empty table gives no rows.
"""

import math
import pickle
from array import array
from functools import cached_property, reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import functions as F

from flowtally.llm.bayeslsh import mix
from flowtally.llm.common import cut_and_sweep, is_held_out, words_of

SYMBOL = 2e-6
CONTEXT = 3e-4
PAIR = 1e-6
HOT = 1e-7
BLOCK = 1 << 20
ENDING = 3
DISCOUNT = 0.75
ALPHA = 0.1
END = b"\n"
OTHER = 0
# Numbers of the start and the end of a text in every block; other words follow.
FIRST, LAST = 0, 1
PARTS = "block long, part int, shard int, data binary"


def word_hash(word):
    return xxhash.xxh3_64_intdigest(word) - (1 << 63)


# Stands before the first word of a text; no word has a tab.
START = word_hash(b"\t")


def pack(*arrays):
    """Bytes of arrays, byte by byte of their numbers, which packs better."""
    return pickle.dumps([(a.dtype.str, len(a), pa.compress(
        np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T), codec="zstd", asbytes=True)) for a in arrays])


def unpack(data):
    out = []
    for kind, n, packed in pickle.loads(data):
        kind = np.dtype(kind)
        planes = np.frombuffer(pa.decompress(packed, n * kind.itemsize, codec="zstd"), dtype=np.uint8) if n else np.zeros(0, np.uint8)
        out.append(np.ascontiguousarray(planes.reshape(kind.itemsize, n).T).reshape(-1).view(kind))
    return out


def parts(rows):
    blocks, kinds, shards, data = zip(*rows) if rows else ((),) * 4
    return pa.RecordBatch.from_arrays(
        [pa.array(blocks, pa.int64()), pa.array(kinds, pa.int32()), pa.array(shards, pa.int32()), pa.array(data, pa.binary())],
        names=["block", "part", "shard", "data"])


class Numbers(dict):
    """Numbers of words as they come."""

    def __missing__(self, word):
        self[word] = n = len(self)
        return n


def blocked(batches):
    """Part 0 of each block of texts (doc_id, held, text as bytes): tokens, lengths, held, ids and whether there is one; its words."""
    number = TaskContext.get().partitionId() << 32
    numbers, tokens, coded, texts = Numbers({b"\t": FIRST, END: LAST}), [], [], []

    def code():
        coded.append(np.fromiter(map(numbers.__getitem__, tokens), dtype=np.uint32, count=len(tokens)))
        tokens.clear()

    def row():
        code()
        lengths, held, ids = (np.array(c) for c in zip(*((n, h, i or 0) for n, h, i in texts)))
        found = np.concatenate(coded)
        # Small numbers for frequent words, which packs better.
        order = np.argsort(-np.bincount(found, minlength=len(numbers))[2:], kind="stable") + 2
        number_of = np.arange(len(numbers), dtype=np.uint32)
        number_of[order] = number_of[2:].copy()
        found, words = number_of[found], list(numbers)
        here = np.bincount(found[np.repeat(~held, lengths)], minlength=len(numbers))
        words = pack(np.frombuffer(END.join([words[i] for i in order.tolist()]), dtype=np.uint8), here.astype(np.uint32))
        data = pack(found, lengths.astype(np.uint32), held.astype(np.uint8), ids.astype(np.int64),
                    np.array([i is not None for _, _, i in texts], dtype=np.uint8))
        return parts([(number, 0, 0, data)]).append_column("words", pa.array([words], pa.binary()))

    for batch in batches:
        for doc_id, held, text in zip(*(c.to_pylist() for c in batch.columns)):
            found = text.lower().split() if text else []
            tokens += found
            tokens.append(END)
            texts.append((len(found) + 1, held, doc_id))
            if len(tokens) > 1 << 16:
                code()
                if sum(map(len, coded)) >= BLOCK:
                    yield row()
                    number += 1
                    numbers, coded, texts = Numbers({b"\t": FIRST, END: LAST}), [], []
    if texts:
        yield row()


def blocks_of(docs, held):
    """Blocks of the texts of documents; those that are held are scored, but nothing is learned from them."""
    texts = docs.select(F.col("doc_id").cast("bigint"), held.alias("held"), F.col("text").cast("binary"))
    return cut_and_sweep(texts.mapInArrow(blocked, PARTS + ", words binary"), "blocks")


def distinct(keys, bound):
    """Sorted distinct keys below a bound and the place of each key among them."""
    width = max(len(keys) - 1, 0).bit_length()
    if int(bound).bit_length() + width > 64:
        return np.unique(keys, return_inverse=True)
    # Key and place in one number sort several times faster than places by keys.
    both = np.sort((keys.astype(np.uint64) << np.uint64(width)) | np.arange(len(keys), dtype=np.uint64))
    at = (both & np.uint64((1 << width) - 1)).astype(np.int64)
    keys = (both >> np.uint64(width)).astype(np.int64)
    new = np.ones(len(keys), dtype=bool)
    new[1:] = keys[1:] != keys[:-1]
    place = np.empty(len(keys), dtype=np.int64)
    place[at] = np.cumsum(new) - 1
    return keys[new], place


class Block:
    """Words, pairs and triples of a block of texts and, as far as they have been answered, the corpus' counts and states of them.

    Rounds ask for: 1 words, 2 pairs, 3 next words met of words, 4 states of
    words, 5 triples, 6 next words met of pairs, 7 states of pairs. Of the blocks that have a
    word, pair or triple, one owns it.
    """

    def __init__(self, found, model=None):
        """``found``: data of each part by shard. Part 1 is the lexicon."""
        self.found, self.model = found, model
        tokens, lengths, held, ids, named = unpack(found[0][0])
        self.tokens, self.lengths = tokens.astype(np.int64), lengths.astype(np.int64)
        self.held, self.ids, self.named = held == 1, ids, named == 1
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.before = np.empty_like(self.tokens)
        self.before[1:] = self.tokens[:-1]
        self.before[self.starts] = FIRST
        self.trained = np.repeat(~self.held, self.lengths)

    def answers(self, part, order, size, kinds=1):
        """Answers of a round for the asked ones, 0 for all others."""
        return spread(self.found.get(part, []), order, size, kinds)

    # Words.
    @cached_property
    def lexical(self):
        """Keys, counts, next symbols and context symbols of words."""
        shard, within, n, following = unpack(self.found[1][0])
        context = self.model[0].symbols.coarse_of[following]
        context[FIRST] = 1
        return mix(shard.astype(np.uint64) + np.uint64(1), within.astype(np.uint64)), n, following.astype(np.int64), context

    @cached_property
    def root(self):
        tree, distinct_words = self.model
        return (self.lexical[1] + ALPHA) / (tree.total + ALPHA * (distinct_words + 1))

    # Pairs.
    @cached_property
    def pairs(self):
        """First and second word of distinct pairs, places of pairs by token, the places learned from."""
        size = len(self.lexical[0])
        keys, place = distinct(self.before * size + self.tokens, size * size)
        return keys // size, keys % size, place, np.bincount(place[self.trained], minlength=len(keys))

    @cached_property
    def asked_pairs(self):
        """Those that may be met twice, by key, and the keys of all."""
        hashes, n, _, _ = self.lexical
        first, second, _, _ = self.pairs
        keys = mix(hashes[first], hashes[second])
        asked = np.flatnonzero((n[first] > 1) & (n[second] > 1))
        return asked[np.argsort(keys[asked])], keys

    def ask_pairs(self):
        asked, keys = self.asked_pairs
        return keys[asked], [self.pairs[3][asked].astype(np.uint32)]

    @cached_property
    def pair_counts(self):
        return self.answers(2, self.asked_pairs[0], len(self.pairs[0]), 2)

    @property
    def pair_n(self):
        return self.pair_counts[0]

    @cached_property
    def owned_pairs(self):
        return np.flatnonzero((self.pair_n > 1) & (self.pair_counts[1] > 0))

    # States of words.
    @cached_property
    def asked_words(self):
        hashes, n, _, _ = self.lexical
        asked = np.zeros(len(n), dtype=bool)
        asked[self.pairs[0]] = True
        asked = np.flatnonzero(asked & (n > 1))
        return asked[np.argsort(hashes[asked])]

    def ask_nexts(self):
        own, asked = self.owned_pairs, self.asked_words
        return self.lexical[0][asked], nexts(self.pairs[0][own], self.pair_n[own], asked, len(self.lexical[0]))

    @cached_property
    def word_left(self):
        """Times followed by a word met, and what is left for the suffix (1 where no next word is met)."""
        n = self.lexical[1]
        met, kinds = self.answers(3, self.asked_words, len(n), 2)
        return met, left_of(met, kinds, n)

    @cached_property
    def asked_states(self):
        return self.asked_words[self.word_left[0][self.asked_words] > 0]

    def ask_gains(self):
        hashes, total, following, context = self.lexical
        own, asked, tree = self.owned_pairs, self.asked_states, self.model[0]
        first, second = self.pairs[0][own], self.pairs[1][own]
        log_p, _ = tree.log_probabilities(context[first], None, following[second], 1)
        lower = self.root[second] * 10 ** (log_p - tree.log_root[following[second]])
        return hashes[asked], [gains(first, self.pair_n[own], lower, total, *self.word_left)[asked]]

    @cached_property
    def level(self):
        """Shares kept by pairs and what is left by words, of states."""
        first, n = self.pairs[0], self.lexical[1]
        (state,) = self.answers(4, self.asked_states, len(n))
        share = np.where((self.pair_n > 1) & (state[first] > 0), (self.pair_n - DISCOUNT) / np.maximum(n[first], 1), 0.0)
        return share, np.where(state > 0, self.word_left[1], 1.0)

    # Triples.
    @cached_property
    def inner(self):
        """Tokens that follow two words, a start being one."""
        inner = np.ones(len(self.tokens), dtype=bool)
        inner[self.starts] = False
        return np.flatnonzero(inner)

    @cached_property
    def triples(self):
        """First and second pair of distinct triples of met pairs, their tokens and places by token, the places learned from."""
        place, met = self.pairs[2], self.pair_n > 1
        at = self.inner[met[place[self.inner]] & met[place[self.inner - 1]]]
        size = len(met)
        keys, of = distinct(place[at - 1] * size + place[at], size * size)
        return keys // size, keys % size, at, of, np.bincount(of[self.trained[at]], minlength=len(keys))

    @cached_property
    def triple_keys(self):
        keys = self.asked_pairs[1]
        keys = mix(keys[self.triples[0]], keys[self.triples[1]])
        return np.argsort(keys), keys

    def ask_triples(self):
        order, keys = self.triple_keys
        return keys[order], [self.triples[4][order].astype(np.uint32)]

    @cached_property
    def triple_counts(self):
        order, keys = self.triple_keys
        return self.answers(5, order, len(keys), 2)

    @property
    def triple_n(self):
        return self.triple_counts[0]

    @cached_property
    def owned_triples(self):
        return np.flatnonzero((self.triple_n > 1) & (self.triple_counts[1] > 0))

    # States of pairs.
    @cached_property
    def asked_contexts(self):
        place, keys = self.pairs[2], self.asked_pairs[1]
        asked = np.zeros(len(keys), dtype=bool)
        asked[place[self.inner - 1]] = True
        asked = np.flatnonzero(asked & (self.pair_n > 1))
        return asked[np.argsort(keys[asked])]

    def ask_pair_nexts(self):
        own, asked = self.owned_triples, self.asked_contexts
        return self.asked_pairs[1][asked], nexts(self.triples[0][own], self.triple_n[own], asked, len(self.pair_n))

    @cached_property
    def pair_left(self):
        met, kinds = self.answers(6, self.asked_contexts, len(self.pair_n), 2)
        return met, left_of(met, kinds, self.pair_n)

    @cached_property
    def asked_pair_states(self):
        return self.asked_contexts[self.pair_left[0][self.asked_contexts] > 0]

    def ask_pair_gains(self):
        _, _, following, context = self.lexical
        own, asked, tree = self.owned_triples, self.asked_pair_states, self.model[0]
        first, second = self.triples[0][own], self.triples[1][own]
        # The words of both pairs: a, b and b, c.
        a, b, c = self.pairs[0][first], self.pairs[0][second], self.pairs[1][second]
        log_p, _ = tree.log_probabilities(context[b], context[a], following[c])
        share, left = self.level
        lower = share[second] + left[b] * self.root[c] * 10 ** (log_p - tree.log_root[following[c]])
        return self.asked_pairs[1][asked], [gains(first, self.triple_n[own], lower, self.pair_n, *self.pair_left)[asked]]

    @cached_property
    def pair_level(self):
        first = self.triples[0]
        (state,) = self.answers(7, self.asked_pair_states, len(self.pair_n))
        share = np.where((self.triple_n > 1) & (state[first] > 0), (self.triple_n - DISCOUNT) / np.maximum(self.pair_n[first], 1), 0.0)
        return share, np.where(state > 0, self.pair_left[1], 1.0)

    def scores(self):
        """doc_id, n_tokens, n_known, base_score and score of every text."""
        _, n, following, context = self.lexical
        tree, tokens, place = self.model[0], self.tokens, self.pairs[2]
        last = context[self.before]
        before = np.ones_like(last)
        before[self.inner] = last[self.inner - 1]
        log_p, reach = tree.log_probabilities(last, before, following[tokens])
        ratio = np.where(n[tokens] > 0, log_p - tree.log_root[following[tokens]], reach)
        share, left = self.level
        p = share[place] + left[self.before] * self.root[tokens] * 10 ** ratio
        share, left = self.pair_level
        p[self.inner] *= left[place[self.inner - 1]]
        _, _, at, of, _ = self.triples
        p[at] += share[of]
        known = np.add.reduceat((n[tokens] > 0).astype(np.int64), self.starts)
        yield pa.RecordBatch.from_arrays([
            pa.array(self.ids, mask=~self.named), pa.array(self.lengths), pa.array(known),
            pa.array(np.add.reduceat(np.log10(self.root)[tokens], self.starts)),
            pa.array(np.add.reduceat(np.log10(p), self.starts))], names=["doc_id", "n_tokens", "n_known", "base_score", "score"])

    def states(self):
        """Keys of the states of words and what they change: a context's count and log10 left, a next word's count and share."""
        hashes, n, _, _ = self.lexical
        (share, left), (share2, left2) = self.level, self.pair_level
        pair_keys, triple_keys = self.asked_pairs[1], self.triple_keys[1]
        words, contexts, pairs, triples = (np.flatnonzero(x) for x in (left < 1, left2 < 1, share > 0, share2 > 0))
        for keys, of_word, counts, kept, weight in (
                (hashes[words], True, n[words], None, left[words]),
                (pair_keys[contexts], False, self.pair_n[contexts], None, left2[contexts]),
                (pair_keys[pairs], False, self.pair_n[pairs], share[pairs], None),
                (triple_keys[triples], False, self.triple_n[triples], share2[triples], None)):
            zeros = np.zeros(len(keys))
            counts = counts.astype(np.int64)
            yield pa.RecordBatch.from_arrays([
                pa.array(keys.view(np.int64)), pa.array(counts, mask=np.full(len(keys), not of_word)), pa.array(counts),
                pa.array(zeros if kept is None else kept), pa.array(zeros if weight is None else np.log10(weight))],
                names=["key", "c", "n", "kept", "weight"])


def nexts(context, n, asked, size):
    """A block's part of: places of next words met twice, number of these words; of the asked contexts."""
    return [np.bincount(context, weights=w, minlength=size)[asked].astype(np.uint32) for w in (n, None)]


def left_of(met, kinds, n):
    """What the discount leaves to the suffix."""
    return 1.0 - (met - DISCOUNT * kinds) / np.maximum(n, 1)


def gains(context, n, lower, total, met, left):
    """A block's part of the gain of contexts over their suffixes, each occurrence left out taking 1 from n and total."""
    p = (n - 1 - DISCOUNT) / (total[context] - 1) + left[context] * lower
    gain = np.bincount(context, weights=n * np.log(p / lower), minlength=len(total))
    part = np.bincount(context, weights=n, minlength=len(total)) / np.maximum(met, 1)
    return gain + part * (total - met) * np.log(left)


def spread(data, order, size, kinds):
    """Arrays of a size with answers, by shard, at the places asked for."""
    out, got = [np.zeros(size) for _ in range(kinds)], [unpack(d) for d in data]
    for k in range(kinds):
        out[k][order] = np.concatenate([g[k] for g in got]) if got else 0.0
    return out


def words_in(packed):
    """Words of a block, in order of their numbers, and how often they are learned from."""
    rest, here = unpack(packed)
    rest = rest.tobytes()
    return [b"\t", END, *(rest.split(END) if rest else [])], here


def hashes_of(words):
    return np.array(list(map(word_hash, words)), dtype=np.int64).view(np.uint64)


def shard_of(keys, shards):
    return (keys >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)


def by_shard(number, part, shards, keys, values):
    """Rows of what a block asks for, in order of keys. Shards are ranges of keys."""
    order = np.argsort(keys)
    keys, values = keys[order], [v[order] for v in values]
    edge = np.searchsorted(shard_of(keys, shards), np.arange(shards + 1, dtype=np.uint64))
    return [(number, part, s, pack(np.diff(keys[i:j], prepend=np.uint64(0)), *(v[i:j] for v in values)))
            for s, (i, j) in enumerate(zip(edge[:-1].tolist(), edge[1:].tolist())) if i < j]


def ask_words(shards):
    def run(batches):
        for batch in batches:
            for number, packed in zip(*(c.to_pylist() for c in batch.columns)):
                words, here = words_in(packed)
                yield parts(by_shard(number, 1, shards, hashes_of(words), [here]))

    return run


def answer(table):
    """A shard's answers to the blocks that asked: sums for their keys, of gains whether it is positive.

    Counts come with who owns the key, those of words with their number among the shard's words, too.
    """
    numbers, sent = table.column("block").to_pylist(), [unpack(d) for d in table.column("data").to_pylist()]
    part, shard = (table.column(c)[0].as_py() for c in ("part", "shard"))
    keys = np.concatenate([np.cumsum(s[0], dtype=np.uint64) for s in sent])
    # Runs in order are merged.
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    new = np.r_[True, keys[1:] != keys[:-1]]
    group, back = np.cumsum(new) - 1, []
    for k in range(1, len(sent[0])):
        out = np.bincount(group, weights=np.concatenate([s[k] for s in sent])[order])
        if part in (4, 7):
            out = (out > 0).astype(np.uint8)
        else:
            out = out.astype(np.uint32 if out.max() < 1 << 32 else np.int64)
        back.append(np.empty(len(keys), dtype=out.dtype))
        back[-1][order] = out[group]
    if part in (1, 2, 5):
        back.append(np.zeros(len(keys), dtype=np.uint8))
        back[-1][order[new]] = 1
    if part == 1:
        back.append(np.empty(len(keys), dtype=np.uint32))
        back[-1][order] = group
    edges = np.cumsum([len(s[0]) for s in sent])[:-1]
    back = [np.split(b, edges) for b in back]
    if part == 1:
        # A block's words ascend in them.
        back[-1] = [np.diff(b, prepend=np.uint32(0)) for b in back[-1]]
    return pa.Table.from_batches([parts([(n, part, shard, pack(*(b[i] for b in back))) for i, n in enumerate(numbers)])])


def answered(asks):
    return cut_and_sweep(asks.groupBy("part", "shard").applyInArrow(answer, PARTS), "answers")


def collect_block(table):
    found = {}
    rows = zip(*(table.column(c).to_pylist() for c in ("part", "shard", "data")))
    for part, _, data in sorted(rows, key=lambda r: r[:2]):
        found.setdefault(part, []).append(data)
    return table.column("block")[0].as_py(), found


def by_block(frames, run, schema):
    """What a function makes of number and parts of each block."""
    def of(table):
        return pa.Table.from_batches(list(run(*collect_block(table))))

    return reduce(lambda a, b: a.unionAll(b), frames).groupBy("block").applyInArrow(of, schema)


def asked(frames, rounds, shards, model_sent):
    """Answers of rounds (part, what blocks ask for) that need no answers of one another."""
    def run(number, found):
        block = Block(found, model_sent.value)
        yield parts([row for part, ask in rounds for row in by_shard(number, part, shards, *ask(block))])

    return answered(by_block(frames, run, PARTS))


def lexicon(symbols_sent, shards):
    """Part 1 of blocks: shards, numbers there, counts and next symbols of words; words met once need no number."""
    def run(number, found):
        words, _ = words_in(found[0][0])
        hashes = hashes_of(words)
        got, order = [unpack(d) for d in found[1]], np.argsort(hashes)
        shard = shard_of(hashes, shards).astype(np.uint32)
        within, n = np.empty(len(hashes), dtype=np.uint32), np.empty(len(hashes), dtype=np.int64)
        within[order] = np.concatenate([np.cumsum(g[2], dtype=np.uint32) for g in got])
        n[order] = np.concatenate([g[0] for g in got])
        # Every start is followed by one token, and there are as many as ends.
        n[FIRST] = n[LAST]
        shard[n < 2], within[n < 2] = 0, 0
        following, _ = symbols_sent.value.numbers(words)
        yield parts([(number, 1, 0, pack(shard, within, n, following.astype(np.uint32)))])

    return run


def owned_sums(batches):
    """n and number of the words learned that answers give to their owners."""
    for batch in batches:
        n, own, _ = (np.concatenate(c) for c in zip(*map(unpack, batch.column(0).to_pylist())))
        own = (own > 0) & (n > 0)
        yield pa.RecordBatch.from_arrays([pa.array([int(n[own].sum())]), pa.array([int(own.sum())])], names=["n", "v"])


def vocabulary(least):
    """Rows (word, n, v, frequent) of words owned by blocks: those met often enough, all others summed by their endings."""
    def run(number, found):
        words, _ = words_in(found[0][0])
        n, own = spread(found.get(1, []), np.argsort(hashes_of(words)), len(words), 2)
        n = np.where(own > 0, n, 0).astype(np.int64)
        frequent, rare = np.flatnonzero(n >= least), np.flatnonzero((n > 0) & (n < least))
        endings = Numbers()
        at = np.array([endings[words[i][-ENDING:]] for i in rare.tolist()], dtype=np.int64)
        sums, kinds = (np.bincount(at, weights=w, minlength=len(endings)).astype(np.int64) for w in (n[rare], None))
        yield pa.RecordBatch.from_arrays([
            pa.array([words[i] for i in frequent.tolist()] + list(endings), pa.binary()), pa.array(np.r_[n[frequent], sums]),
            pa.array(np.r_[np.ones(len(frequent), dtype=np.int64), kinds]),
            pa.array(np.r_[np.ones(len(frequent), dtype=bool), np.zeros(len(endings), dtype=bool)])],
            names=["word", "n", "v", "frequent"])

    return run


class Symbols:
    """Symbol numbers of words: fine ones to be predicted, coarse ones for contexts.

    ``frequent`` and ``endings`` are (key, count) lists by descending count.
    """

    def __init__(self, frequent, endings, total):
        self.fine = {w: i + 1 for i, (w, _) in enumerate(frequent)}
        self.words = len(frequent)
        self.fine_ending = {e: self.words + 1 + i for i, (e, _) in enumerate(endings)}
        self.size = self.words + len(endings) + 1
        # Coarse numbers: 0 any other, 1 the start of a text.
        self.coarse, self.coarse_ending = {}, {}
        for target, source in ((self.coarse, frequent), (self.coarse_ending, endings)):
            for key, n in source:
                if n >= CONTEXT * total:
                    target[key] = 2 + len(self.coarse) + len(self.coarse_ending)
        self.contexts = 2 + len(self.coarse) + len(self.coarse_ending)
        # The context symbol goes by the next symbol: a rare word's ending is the whole of both.
        self.coarse_of = np.array([OTHER, *(self.coarse.get(w) or self.coarse_ending.get(w[-ENDING:], OTHER) for w in self.fine),
                                   *(self.coarse_ending.get(e, OTHER) for e in self.fine_ending)], dtype=np.int64)
        self.clear()

    def clear(self):
        """Forget the words met so far; they are kept per worker up to a bound."""
        self.known = {}
        self.next_of, self.context_of, self.hash_of = array("q"), array("q"), array("q")

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("known", "next_of", "context_of", "hash_of")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.clear()

    def numbers(self, words):
        """Next symbols and context symbols of words."""
        found = np.array(list(map(self.fine.get, words, repeat(OTHER))), dtype=np.int64)
        rare, ending = np.flatnonzero(found == OTHER), self.fine_ending.get
        found[rare] = [ending(words[i][-ENDING:], OTHER) for i in rare.tolist()]
        return found, self.coarse_of[found]

    def encode_block(self, data, words):
        """Next symbols and contexts of the tokens of a block that are learned from."""
        block = Block({0: [data]})
        following, context = self.numbers(words_in(words)[0])
        context[FIRST] = 1
        tokens = context[block.tokens]
        last, before = (shift(tokens, block.starts, by)[block.trained] for by in (1, 2))
        return following[block.tokens[block.trained]], last, before

    def _add(self, words, hashed):
        first = len(self.next_of)
        self.known.update(zip(words, range(first, first + len(words))))
        for held, found in zip((self.next_of, self.context_of), self.numbers(words)):
            held.frombytes(found.tobytes())
        if hashed:
            self.hash_of.extend(map(word_hash, words))

    def encode(self, texts, hashed=True, kept=400_000):
        """Next symbols, contexts, word hashes (if wanted) and lengths of texts, one after another, ends included."""
        if len(self.known) > kept or hashed and len(self.hash_of) < len(self.known):
            self.clear()
        tokens, lengths = [], []
        for text in texts:
            found = words_of(text)
            tokens += found
            tokens.append(END)
            lengths.append(len(found) + 1)
        known = self.known
        self._add(list(set(tokens).difference(known)), hashed)
        codes = np.fromiter(map(known.__getitem__, tokens), dtype=np.int64, count=len(tokens))
        lengths = np.array(lengths, dtype=np.int64)
        following = np.frombuffer(self.next_of, dtype=np.int64)[codes]
        context = np.frombuffer(self.context_of, dtype=np.int64)[codes]
        starts = np.cumsum(lengths) - lengths
        last, before = shift(context, starts, 1), shift(context, starts, 2)
        hashes = np.frombuffer(self.hash_of, dtype=np.int64)[codes] if hashed else None
        return following, last, before, hashes, lengths


def shift(context, starts, by):
    """The context symbol so many tokens earlier; 1 before the start of a text."""
    out = np.ones_like(context)
    out[by:] = context[:-by]
    for k in range(by):
        at = starts + k
        at = at[at < len(out)]
        out[at] = 1
    return out


def slices(batch, column, size=1000):
    for first in range(0, batch.num_rows, size):
        yield first, batch.column(column).slice(first, size).to_pylist()


def counter(symbols_sent, pairs_sent=None):
    """A function that counts (context, next) codes of texts or blocks: of one symbol, or of the given pairs of symbols."""
    def encoded(symbols, batch):
        if "data" in batch.schema.names:
            yield from map(symbols.encode_block, *(c.to_pylist() for c in batch.columns))
        else:
            for _, texts in slices(batch, 0):
                yield symbols.encode(texts, hashed=False)[:3]

    def run(batches):
        symbols, held = symbols_sent.value, []
        chosen = None if pairs_sent is None else pairs_sent.value

        def rows():
            codes = np.concatenate([c for c, _ in held])
            counts = np.concatenate([n for _, n in held])
            order = np.argsort(codes)
            codes, counts = codes[order], counts[order]
            new = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]]) if len(codes) else order
            totals = np.add.reduceat(counts, new) if len(codes) else counts
            return pa.RecordBatch.from_arrays([pa.array(codes[new]), pa.array(totals)], names=["code", "n"])

        for batch in batches:
            for following, last, before in encoded(symbols, batch):
                if chosen is None:
                    codes = last * symbols.size + following
                    both = -1 - (before * symbols.contexts + last)
                    codes = np.concatenate([codes, both])
                else:
                    state = find(chosen, before * symbols.contexts + last)
                    codes = (state * symbols.size + following)[state >= 0]
                held.append(np.unique(codes, return_counts=True))
                if sum(len(c) for c, _ in held) > 3_000_000:
                    yield rows()
                    held = []
        if held:
            yield rows()

    return run


def find(keys, values):
    """Places of values in sorted keys, -1 where there is none."""
    if not len(keys):
        return np.full(len(values), -1, dtype=np.int64)
    if len(keys) > 10_000 and len(values) > 10_000:
        # In order, neighbours are near one another in the keys too.
        order = np.argsort(values)
        at = np.empty(len(values), dtype=np.int64)
        at[order] = np.searchsorted(keys, values[order])
    else:
        at = np.searchsorted(keys, values)
    at = np.minimum(at, len(keys) - 1)
    return np.where(keys[at] == values, at, -1)


class Tree:
    """States of one and two context symbols with the log10 probabilities they keep."""

    def __init__(self, symbols, root, total):
        self.symbols, self.root, self.total = symbols, root, total
        self.log_root = np.log10(root)
        self.pairs = np.zeros(0, dtype=np.int64)
        self.levels = []

    def lower(self, states, following):
        """Probabilities of next symbols in the suffix state of each given state of the level to be added."""
        if not self.levels:
            return self.root[following]
        level = self.levels[0]
        at = find(level["keys"], states * self.symbols.size + following)
        kept = np.where(at >= 0, level["kept"][at] if len(level["kept"]) else 0.0, 0.0)
        return kept + level["left"][states] * self.root[following]

    def add(self, states, suffixes, following, n, totals):
        """Test the states and add a level: (state, next symbol, count) rows sorted by both, totals by state."""
        size = len(totals)
        share = np.maximum(n - DISCOUNT, 0) / totals[states]
        mass = np.bincount(states, weights=share, minlength=size)
        left = 1.0 - mass
        lower = self.lower(suffixes[states], following)
        p = share + left[states] * lower
        gain = np.bincount(states, weights=n * np.log(p / lower), minlength=size)
        rest = totals - np.bincount(states, weights=n, minlength=size)
        gain = gain + rest * np.log(np.maximum(left, 1e-12))
        cost = np.bincount(states, minlength=size) * 0.5 * math.log(max(self.total, 2))
        retained = gain > cost
        rows = retained[states]
        self.levels.append({
            "keys": states[rows] * self.symbols.size + following[rows], "kept": share[rows],
            "left": np.where(retained, left, 1.0)})
        return retained

    def log_probabilities(self, last, before, following, depth=2):
        """log10 P(symbol | longest suffix state) and of the weight with which the root is reached."""
        p = self.root[following]
        reach = np.ones(len(p))
        pair = find(self.pairs, before * self.symbols.contexts + last) if depth > 1 else None
        for level, state in list(zip(self.levels, (last, pair)))[:depth]:
            known = state >= 0
            state = np.where(known, state, 0)
            at = find(level["keys"], state * self.symbols.size + following)
            left = np.where(known, level["left"][state], 1.0) if len(level["left"]) else np.ones(len(p))
            kept = np.where(known & (at >= 0), level["kept"][at], 0.0) if len(level["kept"]) else 0.0
            p = kept + left * p
            reach = reach * left
        return np.log10(p), np.log10(reach)


def collected(frame, *columns):
    table = frame.select(*columns).toArrow()
    return [table.column(c).to_numpy() for c in columns]


def code_parts(run, shards):
    """A function that sends rows (code, n) to shards, packed."""
    def sent(batches):
        for batch in run(batches):
            codes, n = (c.to_numpy() for c in batch.columns)
            shard = (codes % shards).astype(np.uint16)
            order = np.argsort(shard, kind="stable")
            edge = np.searchsorted(shard[order], np.arange(shards + 1))
            codes, n = codes[order], n[order].astype(np.uint32)
            yield parts([(0, 0, s, pack(np.diff(codes[i:j], prepend=np.int64(0)), n[i:j]))
                         for s, (i, j) in enumerate(zip(edge[:-1].tolist(), edge[1:].tolist())) if i < j])

    return sent


def code_sums(size, least):
    """A function of a shard's codes: rows (code, n) of at least so many, and n of each state, code being NULL."""
    def of(table):
        sent = [unpack(d) for d in table.column("data").to_pylist()]
        codes, place = np.unique(np.concatenate([np.cumsum(s[0]) for s in sent]), return_inverse=True)
        n = np.bincount(place, weights=np.concatenate([s[1] for s in sent])).astype(np.int64)
        states, place = np.unique(codes[codes >= 0] // size, return_inverse=True)
        totals = np.bincount(place, weights=n[codes >= 0], minlength=len(states)).astype(np.int64)
        kept = n >= least
        return pa.table({
            "code": pa.array(np.r_[codes[kept], states], mask=np.r_[np.zeros(kept.sum(), dtype=bool), np.ones(len(states), dtype=bool)]),
            "state": np.r_[codes[kept], states], "n": np.r_[n[kept], totals]})

    return of


def train(docs):
    """(tree, words: answers to blocks; N; V) learned from documents with a text column."""
    if "doc_id" not in docs.columns:
        docs = docs.withColumn("doc_id", F.lit(None))
    return learn(blocks_of(docs, F.lit(False)))


def shards_of(blocks):
    return max(12, blocks.count() // 4)


def word_parts(blocks):
    return blocks.select("block", "part", "shard", F.col("words").alias("data"))


def learn(blocks):
    """As :func:`train`, from blocks."""
    spark = blocks.sparkSession
    words = answered(blocks.select("block", "words").mapInArrow(ask_words(shards_of(blocks)), PARTS))
    total, distinct = words.select("data").mapInArrow(owned_sums, "n long, v long").agg(
        *(F.coalesce(F.sum(c), F.lit(0)) for c in ("n", "v"))).first()
    least = max(2, math.ceil(SYMBOL * total))
    # At most 1 / SYMBOL words and endings have this share.
    known = cut_and_sweep(by_block([word_parts(blocks), words], vocabulary(least), "word binary, n long, v long, frequent boolean").groupBy(
        "word", "frequent").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).where(F.col("n") >= least), "words").collect()
    known = sorted(((bytes(r["word"]), r["n"], r["v"], r["frequent"]) for r in known), key=lambda r: (-r[1], r[0]))
    frequent, common = [r[:2] for r in known if r[3]], [r[:3] for r in known if not r[3]]
    symbols = Symbols(frequent, [(e, n) for e, n, _ in common], total)

    base = total + ALPHA * (distinct + 1)
    root = np.zeros(symbols.size)
    root[1:1 + len(frequent)] = [(n + ALPHA) / base for _, n in frequent]
    root[1 + len(frequent):] = [(n + ALPHA * v) / base for _, n, v in common]
    root[OTHER] = max(1.0 - root.sum(), ALPHA / base)
    tree = Tree(symbols, root, total)
    sent = spark.sparkContext.broadcast(symbols)
    least = max(2, math.ceil(PAIR * total))

    def level(run, states):
        """Rows (state, next, n) kept, counts of all states, and rows (pair, n) of pairs of states."""
        found = blocks.select("data", "words").mapInArrow(code_parts(run, 64), PARTS).groupBy("shard").applyInArrow(
            code_sums(symbols.size, least), "code long, state long, n long")
        code, state, n = collected(cut_and_sweep(found.groupBy("code", "state").agg(F.sum("n").alias("n")), "codes").orderBy("state"),
                                   "code", "state", "n")
        of_state = np.isnan(code)
        totals = np.ones(states)
        totals[state[of_state]] = n[of_state]
        kept, pair = ~of_state & (state >= 0), ~of_state & (state < 0)
        code = state[kept]
        return (code // symbols.size, code % symbols.size, n[kept], totals), (-1 - state[pair], n[pair])

    single, (pairs, n) = level(counter(sent), symbols.contexts)
    tree.add(single[0], np.arange(symbols.contexts), *single[1:])
    # At most 1 / CONTEXT pairs of context symbols have this share.
    tree.pairs = np.sort(pairs[n >= max(2, math.ceil(CONTEXT * total))])
    if len(tree.pairs):
        double, _ = level(counter(sent, spark.sparkContext.broadcast(tree.pairs)), len(tree.pairs))
        tree.add(double[0], tree.pairs % symbols.contexts, *double[1:])
    return tree, words, total, distinct


def informed(blocks, model):
    """Parts of all blocks with the answers of all rounds, and the model as sent to the tasks."""
    tree, words, _, distinct_words = model
    context, shards = blocks.sparkSession.sparkContext, shards_of(blocks)
    sent = context.broadcast((tree, distinct_words))
    frames = [blocks.drop("words"), cut_and_sweep(
        by_block([word_parts(blocks), words], lexicon(context.broadcast(tree.symbols), shards), PARTS), "lexicon")]
    for rounds in (((2, Block.ask_pairs),), ((3, Block.ask_nexts), (5, Block.ask_triples)),
                   ((4, Block.ask_gains), (6, Block.ask_pair_nexts)), ((7, Block.ask_pair_gains),)):
        frames.append(asked(frames, rounds, shards, sent))
    return frames, sent


def of_blocks(frames, sent, run, schema):
    return by_block(frames, lambda _, found: run(Block(found, sent.value)), schema)


def word_states(docs, model):
    """(table, hot, total, distinct) of the states of words learned from documents.

    A row for each context that is a state, its weight log10 of what is left
    for the suffix, and for each of its next words, with the share kept; both by key, with
    their count n, and c the same for one word. Those of at least ``HOT`` of all tokens are arrays
    (key, kept, weight), all others the table.
    """
    blocks = blocks_of(docs, F.lit(False))
    model = model[0], answered(blocks.select("block", "words").mapInArrow(ask_words(shards_of(blocks)), PARTS)), *model[2:]
    rows = of_blocks(*informed(blocks, model), Block.states, "key long, c long, n long, kept double, weight double")
    rows = cut_and_sweep(rows.groupBy("key").agg(F.max("c").alias("c"), F.max("n").alias("n"), F.max("kept").alias("kept"),
                                       F.min("weight").alias("weight")), "states")
    frequent = (F.col("n") >= max(2, math.ceil(HOT * model[2]))) & F.col("c").isNull()
    # At most 1 / HOT pairs and as many triples have this share.
    return rows.where(~frequent), collected(rows.where(frequent), "key", "kept", "weight"), model[2], model[3]


def score(blocks, model):
    """doc_id, n_tokens, n_known, base_score and score of every text."""
    return of_blocks(*informed(blocks, model), Block.scores,
                     "doc_id long, n_tokens long, n_known long, base_score double, score double")


def score_held_out(docs, folds=10):
    """Scores of all texts, learned from those outside the held-out fold."""
    blocks = blocks_of(docs, is_held_out(folds))
    model = learn(blocks)
    return score(blocks, model).withColumn("held_out", is_held_out(folds)).withColumn(
        "train_tokens", F.lit(model[2]).cast("bigint"))
