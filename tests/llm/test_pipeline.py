import random

import corpus_pipeline
from flowtally.llm import decontaminate, kneser, linededup, nearcopies

DATA = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_follow_one_another(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    before = {r["doc_id"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, DATA)
        assert out.columns == COLUMNS and out.dtypes == docs.dtypes, name
        rows = out.collect()
        ids = {r["doc_id"] for r in rows}
        assert len(ids) == len(rows) and ids <= before
        assert all(r["n_chars"] == len(r["text"]) for r in rows)
        docs = spark.createDataFrame(rows, docs.schema)
        before = ids
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, DATA).collect()
    assert {p["doc_id"] for p in pieces} == before
    whole = corpus_pipeline.run(spark, DATA).collect()
    assert {p["doc_id"] for p in whole} == before
    total = lambda rows: sum(p["length"] for p in rows)
    assert total(whole) == total(pieces)


def test_decisions_are_those_of_the_operators(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    items = spark.read.parquet(f"{DATA}/benchmark.parquet")
    ids = lambda frame: {r["doc_id"] for r in frame.collect()}
    assert ids(corpus_pipeline.quality(spark, docs, DATA)) == ids(kneser.judge(docs, labels).where("kept"))
    near = nearcopies.near_copies(docs)
    assert ids(corpus_pipeline.near_dedup(spark, docs, DATA)) == {r["component_id"] for r in near.collect()}
    assert ids(corpus_pipeline.decontamination(spark, docs, DATA)) == ids(docs) - ids(decontaminate.overlaps(docs, items))
    texts = {r["doc_id"]: r["text"] for r in linededup.dedup_passages(docs).collect()}
    assert {r["doc_id"]: r["text"] for r in corpus_pipeline.line_dedup(spark, docs, DATA).collect()} == texts


def test_odd_documents(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(f"w{rng.randrange(40)}" for _ in range(20)), "en", "s", 1) for i in range(30)]
    rows += [(40, None, None, None, None), (41, "", "en", "s", 0), (None, "w1 w2 w3", None, "s", 8), (1, rows[1][1], "en", "s", 1),
             (42, "w1 " * 20000, "en", "s", 9)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string, _row string"
    docs = spark.createDataFrame([(*r, "x", "y") for r in rows], schema)
    for frame in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, frame, DATA)
            assert out.columns == docs.columns
            out.collect()
        corpus_pipeline.STAGES[-1][1](spark, frame, DATA).collect()
