"""Language of mixed texts: script ranges, letter n-gram scores and a Viterbi path.

Training counts letter trigrams (words between blanks) per language in a
bounded sample of labelled documents: for each language the ``per_language``
documents of smallest hash of doc_id. A word's score in a language is the sum
of the log probabilities of its trigrams. The script of the word's first letter
narrows the candidates to the languages that use this script in training (all,
if none does). A Viterbi path over a text's words, with a penalty for every
change of language, labels spans; the language of most letters is the text's.

The model has at most ``languages x features`` numbers, whatever the input, and
is sent to the tasks. Texts are then scored where they are read: no shuffle, no
group of rows, memory bounded by a batch of texts and a word cache of fixed size.

Defined cases: NULL texts and texts without a letter are 'und' with score 0;
rows of NULL lang, NULL or empty text teach nothing; without any training row
everything is 'und'; ties go to the alphabetically first language; repeated
rows are predicted each; other columns are ignored, whatever their names.
"""

import math
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Window
from pyspark.sql import functions as F

from flowtally.llm.common import is_held_out

UNKNOWN = "und"
# Script ranges by their Unicode names.
SCRIPTS = ("Latin", "Cyrillic", "Greek", "Arabic", "Hebrew", "Devanagari", "Bengali", "Tamil", "Thai",
           "Hangul", "Hiragana", "Katakana", "Han", "Armenian", "Georgian", "Ethiopic")
RANGES = [regex.compile(rf"\p{{Script={name}}}") for name in SCRIPTS]
WORD = r"\p{L}[\p{L}\p{M}]*"
SPLIT = regex.compile(WORD)
OUT = "doc_id long, lang_pred string, score double, spans array<struct<first_word:int,lang:string>>"


def script_of(word):
    """Number of a word's script, by its first letter; len(SCRIPTS) for any other."""
    for i, pattern in enumerate(RANGES):
        if pattern.match(word):
            return i
    return len(SCRIPTS)


def trigrams(word):
    padded = f" {word} "
    return [padded[i:i + 3] for i in range(len(padded) - 2)]


class Model:
    """Log probabilities of letter trigrams by language, and the languages of each script."""

    def __init__(self, counts, smoothing=0.5, penalty=8.0):
        self.langs = sorted({lang for lang, _, _ in counts})
        self.penalty = penalty
        place = {lang: i for i, lang in enumerate(self.langs)}
        features = sorted({gram for _, gram, _ in counts})
        table = np.zeros((len(features) + 1, len(self.langs)))
        scripts = np.zeros((len(SCRIPTS) + 1, len(self.langs)))
        self.features = {gram: i for i, gram in enumerate(features)}
        for lang, gram, n in counts:
            table[self.features[gram], place[lang]] += n
            letter = gram.strip()[:1]
            if letter:
                scripts[script_of(letter), place[lang]] += n
        table += smoothing
        self.table = np.log(table / table.sum(axis=0))
        self.allowed = scripts >= 0.01 * scripts.sum(axis=0, keepdims=True)
        self.allowed &= scripts > 0
        self.allowed[~self.allowed.any(axis=1)] = True

    def word_scores(self, word):
        get, unseen = self.features.get, len(self.features)
        scores = self.table[[get(g, unseen) for g in trigrams(word)]].sum(axis=0)
        return np.where(self.allowed[script_of(word)], scores, -1e4)


def viterbi(scores, lengths, penalty):
    """Best path of each text: states in one array, texts one after another.

    ``scores`` holds a row per word and a column per language. All texts of the
    batch take a step at a time, the longest first, so a step is one array
    operation over the texts that still have a word.
    """
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
    order = np.argsort(-lengths, kind="stable")
    starts, sizes = starts[order], lengths[order]
    active = np.searchsorted(-sizes, -np.arange(1, int(sizes[0]) + 1), side="right") if len(sizes) else []
    back = np.full(scores.shape, -1, dtype=np.int16)
    state = np.zeros((len(sizes), scores.shape[1]))
    for t, n in enumerate(active):
        best = state[:n].argmax(axis=1)
        jump = state[np.arange(n), best] - (penalty if t else 0.0)
        at = starts[:n] + t
        switched = jump[:, None] > state[:n]
        back[at] = np.where(switched, best[:, None], -1)
        state[:n] = np.where(switched, jump[:, None], state[:n]) + scores[at]
    path = np.zeros(len(scores), dtype=np.int16)
    last = state.argmax(axis=1)
    for t in range(len(active) - 1, -1, -1):
        n = active[t]
        at = starts[:n] + t
        path[at] = last[:n]
        before = back[at, last[:n]]
        last[:n] = np.where(before >= 0, before, last[:n])
    return path


class Scorer:
    """Labels batches of texts; word scores are kept in a cache of bounded size."""

    def __init__(self, model, cache=200_000):
        self.model, self.bound = model, cache
        self.words, self.rows = {}, []

    def _codes(self, words):
        known = self.words
        for word in words:
            if word not in known:
                known[word] = len(self.rows)
                self.rows.append(self.model.word_scores(word))
        return [known[w] for w in words]

    def predict(self, texts):
        """(language, share of letters, spans) of each text."""
        if len(self.words) > self.bound:
            self.words, self.rows = {}, []
        split = [SPLIT.findall(t.lower()) if t else [] for t in texts]
        lengths = np.array([len(w) for w in split], dtype=np.int64)
        langs = self.model.langs
        if not langs or not lengths.sum():
            return [(UNKNOWN, 0.0, [])] * len(texts)
        codes = np.array([c for words in split for c in self._codes(words)], dtype=np.int64)
        letters = np.array([len(w) for words in split for w in words], dtype=np.float64)
        path = viterbi(np.array(self.rows)[codes], lengths, self.model.penalty)
        out, at = [], 0
        for n in lengths:
            if not n:
                out.append((UNKNOWN, 0.0, []))
                continue
            own, weight = path[at:at + n], letters[at:at + n]
            mass = np.bincount(own, weights=weight, minlength=len(langs))
            best = int(mass.argmax())
            firsts = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            out.append((langs[best], float(mass[best] / mass.sum()), [(int(f), langs[own[f]]) for f in firsts]))
            at += n
        return out


def train(docs, per_language=1000, features=50_000):
    """A Model of (doc_id, text, lang) rows.

    Bounds: ``per_language`` documents, the ``features`` most frequent trigrams
    of each language (ties by trigram).
    """
    rows = docs.where("lang is not null and length(text) > 0").select("doc_id", "text", "lang")
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    # The sample is chosen on two narrow columns; texts are read for its documents only.
    chosen = (rows.select("lang", "doc_id").withColumn("_rank", F.row_number().over(order))
              .where(F.col("_rank") <= per_language).select("doc_id").distinct())

    def count(batches):
        counts = defaultdict(Counter)
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts[lang].update(g for w in SPLIT.findall(text.lower()) for g in trigrams(w))
        for lang, grams in counts.items():
            items = list(grams.items())
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(items), pa.string()), pa.array([g for g, _ in items], pa.string()),
                 pa.array([n for _, n in items], pa.int64())], names=["lang", "gram", "n"])

    counts = (rows.join(F.broadcast(chosen), "doc_id", "left_semi").select("lang", "text")
              .mapInArrow(count, "lang string, gram string, n long")
              .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    top = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    counts = counts.withColumn("_rank", F.row_number().over(top)).where(F.col("_rank") <= features)
    return Model([tuple(r) for r in counts.select("lang", "gram", "n").collect()])


def predict(docs, model, texts_at_once=2000):
    """doc_id, lang_pred, score (share of its letters) and spans (first word, language) of every text."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        scorer = Scorer(sent.value)
        for batch in batches:
            for first in range(0, batch.num_rows, texts_at_once):
                part = batch.slice(first, texts_at_once)
                found = scorer.predict(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([f[0] for f in found], pa.string()),
                     pa.array([f[1] for f in found], pa.float64()),
                     pa.array([[{"first_word": a, "lang": b} for a, b in f[2]] for f in found], SPANS)],
                    names=["doc_id", "lang_pred", "score", "spans"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, OUT)


SPANS = pa.list_(pa.struct([("first_word", pa.int32()), ("lang", pa.string())]))


def predict_held_out(docs, folds=5):
    """Predictions for all documents, learned from those outside the held-out fold."""
    model = train(docs.where(~is_held_out(folds)))
    return predict(docs, model).withColumn("held_out", is_held_out(folds))
