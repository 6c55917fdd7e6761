import random
import re
from collections import Counter

import numpy as np
import pytest

from flowtally.llm import collocations
from flowtally.llm.queries import ORACLES, QUERIES
from flowtally_checks.compare import connect, differences

SCHEMA = "doc_id long, lang string, text string, a string, phrase string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, top):
    grams, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for n in (1, 2, 3, 4):
                grams.update((lang, *words[i:i + n]) for i in range(len(words) - n + 1))
    candidates = {g: a for g, a in grams.items() if len(g) > 2 and a >= least}
    covered = Counter()
    for (lang, *words), a in candidates.items():
        for n in range(2, len(words)):
            for i in range(len(words) - n + 1):
                covered[(lang, *words[i:i + n])] = max(covered[(lang, *words[i:i + n])], a)
    found = {}
    for g, a in candidates.items():
        if 100 * covered[g] >= 80 * a:
            continue
        lang, words = g[0], g[1:]
        cuts = [(grams[(lang, *words[:k])], grams[(lang, *words[k:])]) for k in range(1, len(words))]
        score, _, left, right = min((2_000_000 * a // (x + y), k, x, y) for k, (x, y) in enumerate(cuts))
        found.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), left, right))
    return sorted(
        (lang, k, phrase.decode(), -a, left, right, totals[lang], -score) for lang, all_of in found.items()
        for k, (score, a, phrase, left, right) in enumerate(sorted(all_of)[:top], start=1))


def corpus(seed, docs=60):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(12)] + ["Été", "日本", "naïve", "\x1c", "a-b"]
    fixed = ["new york city hall", "hot dog", "the the the the the", "in spite of", "w1 w2 w3 w4"]
    rows = []
    for _ in range(docs):
        parts = [rng.choice(fixed) if rng.random() < 0.3 else rng.choice(words) for _ in range(rng.randint(0, 80))]
        rows.append((rng.choice(["en", "en", "de", None]),
                     "".join(p + rng.choice([" ", " ", "  ", "\t", ", ", ".\n", " ? "]) for p in parts)))
    return rows


def run(spark, rows, **bounds):
    docs = spark.createDataFrame([(i, lang, t, "x", "y") for i, (lang, t) in enumerate(rows)], SCHEMA).repartition(3)
    got = sorted(map(tuple, collocations.collocations(docs, **bounds).collect()))
    assert got == brute(rows, bounds.get("least", 30), bounds.get("top", 2000))
    return got


@pytest.mark.parametrize("bounds", [{"least": 5}, {"least": 5, "top": 7, "head": 6, "bits": 64}])
def test_equals_brute_force(spark, bounds):
    assert len(run(spark, corpus(1), **bounds)) >= 21


def test_odd_rows(spark):
    rows = [("en", None), ("en", ""), ("und", "a b c d e"), (None, "a b c d e"), ("en", " \t , ! "), ("fr", "A B"), ("fr", "a b")]
    assert run(spark, rows, least=2)
    assert run(spark, rows) == []
    assert collocations.collocations(spark.createDataFrame([], SCHEMA)).count() == 0


def test_symbols_that_share_a_hash_start_another_seed(spark, monkeypatch):
    tried, plain = [], collocations._counted

    def first_clashes(docs, least, head, bits, seed):
        tried.append(seed)
        return None if seed == 0 else plain(docs, least, head, bits, seed)

    monkeypatch.setattr(collocations, "_counted", first_clashes)
    run(spark, corpus(2, 20), least=5)
    assert tried == [0, 1]


def test_tiles_equal_a_plain_count():
    rng = np.random.default_rng(5)
    left = np.concatenate([rng.integers(0, 40, 200_000), rng.integers(0, 5000, 50_000)]).astype(np.int32)
    right = np.concatenate([rng.integers(0, 60, 200_000), rng.integers(0, 5000, 50_000)]).astype(np.int32)
    for head in (5000, 1 << 18):
        x, y, n = collocations.tiled(left, right, head)
        assert dict(zip(zip(x.tolist(), y.tolist()), n.tolist())) == Counter(zip(left.tolist(), right.tolist()))
    a, b, n = collocations.sorted_counts(left.astype(np.uint64), right.astype(np.uint64))
    assert dict(zip(zip(a.tolist(), b.tolist()), n.tolist())) == Counter(zip(left.tolist(), right.tolist()))


def test_the_second_symbol_follows_from_the_joint_hash():
    a, b = np.random.default_rng(3).integers(0, 1 << 64, (2, 10_000), dtype=np.uint64)
    assert (collocations._second(collocations._join(a, b), a) == b).all()


@pytest.mark.parametrize("scale", ["0.001", "0.01"])
def test_equals_sql(spark, scale):
    folder = f"/root/testdata/sf{scale}"
    assert differences(QUERIES["op11_collocations"](spark, folder), connect(folder), ORACLES["op11_collocations"]) is None
