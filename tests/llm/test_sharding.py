import zlib
from collections import defaultdict

from flowtally.llm import sharding

SCHEMA = "doc_id long, text string, size string, shard string"


def check(spark, rows, shards, tolerance):
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], SCHEMA)
    out = sharding.shard_by_size(docs, shards=shards, tolerance=tolerance).collect()
    key = lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "")
    assert sorted(((r["doc_id"], r["text"]) for r in out), key=repr) == sorted(rows, key=repr)
    sizes, slots = defaultdict(int), defaultdict(list)
    for r in sorted(out, key=key):
        data = (r["text"] or "").encode()
        assert r["size"] == len(data) + 1 and r["text_crc32"] == zlib.crc32(data)
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    for found in slots.values():
        assert sorted(found) == list(range(len(found)))
    return out, [sizes[s] for s in range(shards)]


def test_near_equal_sizes(spark):
    rows = [(i, f"text {i} " * (1 + i % 7)) for i in range(4000)]
    _, sizes = check(spark, rows, 16, 0.001)
    assert max(sizes) - min(sizes) <= 2 * 0.001 * sum(sizes) / 16 + 2 * 70


def test_a_group_of_copies_is_split_by_number_only_where_it_must(spark):
    rows = [(i, "the same text") for i in range(2000)] + [(5000 + i, f"own {i} text") for i in range(2000)]
    out, sizes = check(spark, rows, 8, 0.01)
    assert max(sizes) - min(sizes) <= 0.03 * sum(sizes) / 8
    at = [(r["doc_id"], r["shard"]) for r in out if r["text"] == "the same text"]
    assert [s for _, s in sorted(at)] == sorted(s for _, s in at)
    assert len({s for _, s in at}) <= 6


def test_small_groups_stay_whole(spark):
    rows = [(i, f"group {i // 5}") for i in range(3000)]
    out, _ = check(spark, rows, 8, 0.05)
    shards = defaultdict(set)
    for r in out:
        shards[r["text"]].add(r["shard"])
    assert all(len(s) == 1 for s in shards.values())


def test_nulls_ties_and_long_texts(spark):
    rows = [(None, None), (None, "a"), (1, None), (1, None), (2, ""), (3, "x" * 100_000), (3, "x" * 100_000), (-5, "é")]
    check(spark, rows, 4, 0.001)
    check(spark, [(1, None)], 16, 0.001)
    assert sharding.shard_by_size(spark.createDataFrame([], SCHEMA)).count() == 0
