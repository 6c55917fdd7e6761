import hashlib
from collections import defaultdict

from flowtally.llm import linededup

SCHEMA = "doc_id long, text string, n_lines string, k long"


def chunks(text):
    lines = text.split("\n")
    h = [int(hashlib.md5(x.encode()).hexdigest()[:8], 16) for x in lines]
    long = [x.count(" ") + 1 >= linededup.LONG_WORDS for x in lines]
    starts = [i for i in range(len(lines)) if i == 0 or long[i - 1] or long[i]
              or ((h[i - 2] if i > 1 else 0) * 31 + h[i - 1]) % linededup.MODULUS == 0]
    for k, (a, b) in enumerate(zip(starts, starts[1:] + [len(lines)])):
        body = "\n".join(lines[a:b])
        yield k, b - a, (b - a > 1 or long[a]) and body.replace("\n", "").strip(" ") != "", body


def brute(rows):
    places = defaultdict(list)
    for doc_id, text in rows:
        if text is not None:
            for k, _, eligible, body in chunks(text):
                if eligible:
                    places[body].append((-1 << 63 if doc_id is None else doc_id, k))
    out = []
    for doc_id, text in rows:
        if text is None:
            out.append((doc_id, None))
            continue
        own = -1 << 63 if doc_id is None else doc_id
        kept = [body for k, _, eligible, body in chunks(text)
                if not eligible or min(places[body]) == max(places[body]) or min(places[body]) == (own, k)]
        out.append((doc_id, "\n".join(kept)))
    return out


def run(spark, rows):
    docs = spark.createDataFrame([(i, t, "x", 7) for i, t in rows], SCHEMA).repartition(3)
    out = linededup.dedup_lines(docs).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in out), key=repr) == sorted(brute(rows), key=repr)
    return out


def test_against_brute_force_on_documents(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    assert sum(r["removed_chunks"] for r in run(spark, rows)) > 0


def test_shifted_passages_and_odd_texts(spark):
    passage = "\n".join(f"line {i} of a shared passage" for i in range(120))
    long_line = "word " * 60
    rows = [(i, f"intro {i}\n{passage}\nend {i}") for i in range(20)]
    rows += [(30, None), (31, ""), (32, "\n\n\n"), (33, "\n\n\n"), (None, passage), (34, passage), (34, passage),
             (35, f"a {long_line}"), (36, f"x\na {long_line}\ny"), (37, "x\n" * 20000), (38, f"{passage}\n{passage}")]
    out = {r["doc_id"]: r for r in run(spark, rows) if r["doc_id"] != 34}
    assert len(out[5]["text"]) < 0.4 * len(rows[5][1])
    assert out[36]["text"] == "x\ny"
    assert out[33]["text"] == "\n\n\n" and out[30]["text"] is None


def test_columns_stay_without_report(spark):
    docs = spark.createDataFrame([(1, "a\nb", "x", 7)], SCHEMA)
    assert linededup.dedup_lines(docs, report=False).collect() == docs.collect()
    assert linededup.dedup_lines(docs.limit(0)).count() == 0


def brute_passages(rows):
    """Texts without chunks the chunk rule removes and without lines of runs of 50 words or more that occur earlier."""
    places, places_of_chunk = defaultdict(list), defaultdict(list)
    runs, starts = [], []
    for row, (doc_id, text) in enumerate(rows):
        own = -1 << 63 if doc_id is None else doc_id
        lines = (text or "").split("\n")
        at = 0
        for k, n, eligible, body in chunks(text or ""):
            if eligible:
                places_of_chunk[body].append((own, k))
            starts.append((row, own, k, at, n, eligible, body))
            at += n
        for a in range(len(lines)):
            for b in range(a + 1, min(a + 50, len(lines)) + 1):
                body = "\n".join(lines[a:b])
                if sum(x.count(" ") + 1 for x in lines[a:b]) >= linededup.LONG_WORDS and body.replace("\n", "").strip(" "):
                    places[body].append((own, a))
                    runs.append((row, own, a, b, body))
    gone = defaultdict(set)
    first = {body: min(found) for body, found in places.items()}
    for row, own, a, b, body in runs:
        if first[body] != (own, a):
            gone[row].update(range(a, b))
    for row, own, k, at, n, eligible, body in starts:
        if eligible and min(places_of_chunk[body]) != (own, k):
            gone[row].update(range(at, at + n))
    return [(doc_id, text if text is None else "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone[row]),
             len(gone[row])) for row, (doc_id, text) in enumerate(rows)]


def test_passages_of_short_lines_go_to_their_edges(spark):
    rows = [(1, "one\ntwo"), (2, None), (3, ""), (4, "\n\n\n"), (5, "y\n" * 200), (6, " " * 80), (7, " " * 80),
            (None, "z\n" * 60), (8, "a " * 60 + "\nq"), (9, "b\n" + "a " * 60)]
    short = {}
    for n in range(2, 9):
        size = -(-52 // n)
        short[n] = "\n".join(" ".join(f"p{n}w{i}x{j}" for j in range(size)) for i in range(n))
        rows += [(100 * n + i, f"intro {n} {i}\n{short[n]}\nend {n} {i}") for i in range(3)]
    docs = spark.createDataFrame([(i, t, "x", 7) for i, t in rows], SCHEMA).repartition(3)
    out = linededup.dedup_passages(docs).collect()
    got = {r["doc_id"]: r["text"] for r in out}
    for n in short:
        assert short[n] in got[100 * n]
        assert got[100 * n + 1] == f"intro {n} 1\nend {n} 1" and got[100 * n + 2] == f"intro {n} 2\nend {n} 2"
    assert sorted(((r["doc_id"], r["text"], r["removed_lines"]) for r in out), key=repr) == sorted(brute_passages(rows), key=repr)
    assert all(r["n_lines"] == (0 if t is None else t.count("\n") + 1) for r in out for i, t in rows if i == r["doc_id"])


def test_passages_against_brute_force_on_documents(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    docs = spark.createDataFrame([(i, t, "x", 7) for i, t in rows], SCHEMA)
    out = linededup.dedup_passages(docs).collect()
    assert sorted(((r["doc_id"], r["text"], r["removed_lines"]) for r in out), key=repr) == sorted(brute_passages(rows), key=repr)


def test_the_query_removes_passages_of_short_lines(spark, tmp_path):
    from flowtally.llm.queries import op2_line_dedup

    passage = "\n".join(" ".join(f"v{i}x{j}" for j in range(18)) for i in range(3))
    rows = [(i, f"start {i}\n{passage}\nstop {i}", "x", 7) for i in range(4)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r["text"] for r in op2_line_dedup(spark, str(tmp_path)).collect()}
    assert got == {0: rows[0][1], **{i: f"start {i}\nstop {i}" for i in range(1, 4)}}
