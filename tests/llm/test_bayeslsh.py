import random

import numpy as np
import pytest

from flowtally.llm import bayeslsh

SCHEMA = "doc_id long, text string, minima string, row string"


def brute_set(text):
    words = (text or "").encode("utf-8", "replace").lower().split()
    grams = {b" ".join(words[i:i + 3]) for i in range(len(words) - 2)}
    return grams or ({b" ".join(words)} if words else set())


def brute(rows):
    sets = [brute_set(t) for _, t in rows]
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                group[root(i)] = root(j)
    members = {}
    for i, (doc_id, _) in enumerate(rows):
        members.setdefault(root(i), []).append(doc_id)
    low = {r: min((x for x in m if x is not None), default=None) for r, m in members.items()}
    return sorted(((d, len(sets[i]), low[root(i)], d == low[root(i)]) for i, (d, _) in enumerate(rows)), key=repr)


def run(spark, rows, **bounds):
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], SCHEMA).repartition(3)
    got = sorted(map(tuple, bayeslsh.near_duplicates(docs, **bounds).collect()), key=repr)
    assert got == brute(rows)
    return got


def family(rng, words, copies, edits):
    """A text and copies of it, each with some words replaced."""
    base = [f"w{rng.randrange(5000)}" for _ in range(words)]
    out = [" ".join(base)]
    for _ in range(copies):
        new = list(base)
        for _ in range(rng.randint(0, edits)):
            new[rng.randrange(words)] = f"x{rng.randrange(5000)}"
        out.append(" ".join(new))
    return out


def rows_of(seed):
    rng = random.Random(seed)
    texts = [t for k in range(6) for t in family(rng, rng.choice([4, 30, 120, 400]), 12, 2 + 2 * k)]
    texts += [" ".join(f"w{rng.randrange(5000)}" for _ in range(50)) for _ in range(20)]
    texts += texts[:15] + [None, "", "  \n", "One two", "one TWO", "one", "one two three", "x " * 30_000, "x x x"]
    rng.shuffle(texts)
    return [(i * 7 % 1009, t) for i, t in enumerate(texts)]


def test_equals_brute_force(spark):
    got = run(spark, rows_of(1))
    assert 10 < sum(not row[3] for row in got)


@pytest.mark.parametrize("bounds", [{"bucket": 3}, {"bucket": 3, "chunk": 150, "pivots": 2}])
def test_large_buckets_and_groups_of_many_chunks(spark, bounds):
    run(spark, rows_of(2), **bounds)


def test_group_beyond_a_chunk_joined_across(spark):
    rng = random.Random(3)
    rows = list(enumerate(family(rng, 200, 40, 8)))
    run(spark, rows, bucket=8, chunk=600, pivots=3)


def test_ties_nulls_and_repeated_rows(spark):
    same = "a b c d e f g h"
    run(spark, [(None, same), (None, "other words stand here now"), (4, same), (4, same), (2, "z y x w"), (2, "z y x w"),
                (2, "quite another text of two"), (9, None), (9, ""), (None, None)])


def test_exact_threshold(spark):
    """17 of 20 shingles is in, 16 of 19 is out."""
    def text(start, n):
        return " ".join(f"w{i}" for i in range(start, start + n + 2))

    got = run(spark, [(1, text(0, 20)), (2, text(0, 17)), (3, text(100, 19)), (4, text(100, 16))])
    assert [row[3] for row in got] == [True, False, True, True]


def test_empty_table(spark):
    assert bayeslsh.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_bayesian_bounds_keep_similar_pairs():
    needed = bayeslsh.least_matches()
    assert needed == sorted(needed) and 0 < needed[0] < bayeslsh.STEP
    rng = np.random.default_rng(7)
    kept = {}
    for similarity in (0.5, 0.85):
        equal = rng.random((20_000, bayeslsh.BANDS * bayeslsh.ROWS)) < similarity
        matches = np.cumsum(equal, axis=1)[:, bayeslsh.STEP - 1::bayeslsh.STEP]
        kept[similarity] = (matches >= np.array(needed)).all(axis=1).mean()
    assert kept[0.85] == 1 and kept[0.5] < 0.02
