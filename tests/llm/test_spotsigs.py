import hashlib

import regex
import xxhash

from flowtally.llm import spotsigs
from flowtally.llm.queries import op9_spotsigs

SCHEMA = "doc_id long, text string, signatures string, n_chars string"


def chain_hash(words):
    seed = 42
    for w in words:
        seed = xxhash.xxh64_intdigest(w.encode(), seed)
    return seed - (1 << 64) if seed >> 63 else seed


def brute(text):
    words = [w for w in regex.split(r"[^\p{L}\p{N}]+", text.lower()) if w]
    content = [(i, w) for i, w in enumerate(words) if w not in spotsigs.ANCHORS]
    found = set()
    for i, w in enumerate(words):
        if w in spotsigs.ANCHORS:
            after = [c for j, c in content if j > i][:spotsigs.CHAIN]
            if len(after) == spotsigs.CHAIN:
                found.add(chain_hash([w, *after]))
    return found or {chain_hash([" ".join(words)])}


def jaccard(a, b):
    return len(a & b) / len(a | b)


ODD = [
    None, "", "...", "the", "the cat sat", "The Cat sat!", "no anchors here today", "the cat the dog of the big house was in a red car",
    " the the the cat  ran away", "éÉ le chat noir est dans la maison bleue", "word " * 2000 + "the end is near now", "x\ny\tthe z w",
]


def rows_of(texts):
    return [(3 * i, t, "x", "y") for i, t in enumerate(texts)]


def test_fingerprints_against_brute_force(spark):
    rows = rows_of(ODD) + [(7, "of mice and men there were many", "", "")]
    out = spotsigs.fingerprints(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    assert len(out) == len(rows)
    ordered = sorted(rows, key=lambda r: r[0])
    following = {r[0]: ordered[(i + 1) % len(ordered)] for i, r in enumerate(ordered)}
    texts = {r[0]: r[1] or "" for r in rows}
    for r in out:
        text, after = texts[r["doc_id"]], following[r["doc_id"]][1] or ""
        half = len(text) // 2
        assert r["edited_text"] == text[:len(text) - half] + after[:half]
        assert set(r["signatures"]) == brute(text)
        assert set(r["edited_signatures"]) == brute(r["edited_text"])
        assert set(r["next_signatures"]) == brute(after)


def test_query_over_several_ranges(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").unionByName(
        spark.read.parquet("/root/testdata/sf0.01/documents.parquet").selectExpr(
            "doc_id * 3 + 5000 as doc_id", "text", "lang", "source", "n_chars"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    out = {r["doc_id"]: r for r in op9_spotsigs(spark, str(tmp_path)).collect()}
    assert len(out) == len(rows)
    for i in range(0, len(rows), 37):
        doc_id, text = rows[i]
        after = rows[(i + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        r = out[doc_id]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert abs(r["near_edited"] - jaccard(brute(text), brute(edited))) < 1e-12
        assert abs(r["near_next"] - jaccard(brute(text), brute(after))) < 1e-12
    same = [out[d]["fingerprint"] for d, t in rows if t == rows[0][1]]
    assert len(same) > 1 and len(set(same)) == 1


def test_near_duplicates_against_brute_force(spark):
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    texts += [t[:len(t) * 9 // 10] for t in texts[:40]] + texts[:3] + ["", None, "the big cat"]
    rows = rows_of(texts)
    links, members = spotsigs.near_duplicates(spark.createDataFrame(rows, SCHEMA))
    classes = {r["doc_id"]: r["class_id"] for r in members.collect()}
    sets = {r[0]: brute(r[1] or "") for r in rows}
    for i in sets:
        assert classes[i] == min(j for j in sets if sets[j] == sets[i])
    names = sorted(set(classes.values()))
    wanted = {(a, b) for x, a in enumerate(names) for b in names[x + 1:] if jaccard(sets[a], sets[b]) >= 0.8}
    assert {(r["a"], r["b"]) for r in links.collect()} == wanted and len(wanted) > 10


def test_nulls_ties_and_no_rows(spark):
    rows = [(None, "b the x y", "", ""), (1, "a", "", ""), (1, "a", "", ""), (1, None, "", "")]
    assert spotsigs.fingerprints(spark.createDataFrame(rows, SCHEMA)).count() == 4
    assert spotsigs.fingerprints(spark.createDataFrame([], SCHEMA)).count() == 0
    assert spotsigs.fingerprints(spark.createDataFrame(rows[:1], SCHEMA)).collect()[0]["next_text"] == rows[0][1]
