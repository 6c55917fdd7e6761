import itertools
import random

from flowtally.llm import decontaminate

DOCS = "doc_id long, text string, item_id string, identity string"
ITEMS = "item_id long, text string, doc_id string"


def brute(text, item, min_matches=10):
    """Best stretch along every offset: most matches, then the earliest place."""
    a, b = decontaminate.tokens(text), decontaminate.tokens(item)
    best = None
    if len(b) < decontaminate.SHORTEST:
        return None
    for shift in range(-len(b) + 1, len(a)):
        lo, hi = max(0, -shift), min(len(b), len(a) - shift)
        start, end = decontaminate.best_stretch([a[shift + i] == b[i] for i in range(lo, hi)])
        n = sum(a[shift + lo + i] == b[lo + i] for i in range(start, end))
        if n >= min(min_matches, len(b)) and (best is None or n > best):
            best = n
    return best


def test_masks_hit_every_stretch_of_ten_with_two_replaced():
    for wrong in itertools.combinations(range(10), 2):
        assert any(all(s + o not in wrong for o in m)
                   for m in decontaminate.MASKS for s in range(10 - m[-1]))


def test_replaced_words_partial_passages_and_clean_texts(spark):
    rng = random.Random(9)
    word = lambda: f"w{rng.randrange(2000)}"
    items = [(i, " ".join(word() for _ in range(rng.randrange(5, 50))), "x") for i in range(60)]
    items += [(60, "one two three four", "x"), (61, "One, two; three four FIVE!", "x"), (62, None, "x"), (63, "", "x"),
              (None, items[3][1], "x"), (64, items[3][1], "x")]
    docs = []
    for i in range(300):
        words = [word() for _ in range(rng.randrange(0, 80))]
        if i % 3 == 0:
            part = items[i % 60][1].split()
            if i % 2 and len(part) > 14:
                part = part[2:]
            for k in range(3, len(part), 6):
                part[k] = word()
            words[len(words) // 2:len(words) // 2] = part
        docs.append((i, " ".join(words), "x", "y"))
    docs += [(1000, None, "", ""), (1001, "", "", ""), (1002, "zero one two three four five", "", ""),
             (1002, "zero one two three four five", "", ""), (1003, "a " * 30000 + items[7][1], "", ""),
             (None, items[5][1], "", "")]
    frame = spark.createDataFrame(docs, DOCS).repartition(3)
    table = spark.createDataFrame(items, ITEMS)
    out = decontaminate.overlaps(frame, table).collect()
    got = sorted(((r["doc_id"], r["item_id"], r["n_matches"]) for r in out), key=repr)
    wanted = sorted(((d[0], i[0], n) for d in docs if d[0] != 1003 for i in items
                     for n in [brute(d[1] or "", i[1] or "")] if n), key=repr)
    assert [g for g in got if g[0] != 1003] == wanted and len(wanted) > 60
    assert (1003, 7) in {g[:2] for g in got}
    bad = {r["doc_id"] for r in out}
    kept = decontaminate.drop_contaminated(frame, table)
    assert sorted(kept.collect(), key=repr) == sorted((r for r in frame.collect() if r["doc_id"] not in bad), key=repr)


def test_blocks_give_the_same_rows(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    one = sorted(decontaminate.overlaps(docs, items).collect())
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 1500)
    assert sorted(decontaminate.overlaps(docs, items).collect()) == one and len(one) > 0


def test_no_rows(spark):
    docs, items = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    some = spark.createDataFrame([(1, "a b c d e f", "", "")], DOCS)
    assert decontaminate.overlaps(docs, items).count() == 0
    assert decontaminate.overlaps(some, items).count() == 0
    assert decontaminate.drop_contaminated(some, items).count() == 1
