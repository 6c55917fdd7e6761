import numpy as np

from flowtally.llm import langid

SCHEMA = "doc_id long, text string, lang string, score string"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = langid.predict_held_out(docs.withColumnRenamed("source", "score")).join(
        docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(out) > 100
    assert sum(r["lang"] == r["lang_pred"] for r in out) / len(out) > 0.98
    assert all(0 <= r["score"] <= 1 for r in out)


def naive_viterbi(scores, penalty):
    best, back = scores[0].copy(), []
    for row in scores[1:]:
        step = [max((best[j] - (penalty if j != i else 0), -abs(i - j) * 0) for j in range(len(best)))[0]
                for i in range(len(best))]
        back.append(None)
        best = np.array(step) + row
    return best.max()


def test_path_has_the_best_score():
    rng = np.random.default_rng(5)
    lengths = np.array([0, 7, 1, 40, 3], dtype=np.int64)
    scores = rng.normal(size=(lengths.sum(), 3)) * 2
    path = langid.viterbi(scores, lengths, 1.5)
    at = 0
    for n in lengths:
        if n:
            own, p = scores[at:at + n], path[at:at + n]
            total = own[np.arange(n), p].sum() - 1.5 * (p[1:] != p[:-1]).sum()
            assert abs(total - naive_viterbi(own, 1.5)) < 1e-9
        at += n


def test_spans_scripts_and_odd_texts(spark):
    en = "the cat and the dog were in the house with this other one that they have "
    ru = "это был большой дом который стоял на берегу реки и там жили люди "
    rows = [(i, en * 3, "en", "x") for i in range(20)] + [(100 + i, ru * 3, "ru", "x") for i in range(20)]
    rows += [(200, None, "en", None), (201, "", "ru", None), (202, "x", None, None)]
    model = langid.train(spark.createDataFrame(rows, SCHEMA))
    assert model.langs == ["en", "ru"]
    tests = [(1, en * 4 + ru * 2, None, ""), (2, None, "en", ""), (3, "12 !? 3", "ru", ""), (4, "", None, ""),
             (5, ru, None, ""), (None, "that", None, ""), (5, ru, None, ""), (6, "漢字", None, ""), (7, en * 3000, "ru", "")]
    out = langid.predict(spark.createDataFrame(tests, SCHEMA), model).collect()
    got = {r["doc_id"]: r for r in out}
    assert len(out) == len(tests)
    assert [got[i]["lang_pred"] for i in (1, 2, 3, 4, 5, 7)] == ["en", "und", "und", "und", "ru", "en"]
    assert [s["lang"] for s in got[1]["spans"]] == ["en", "ru"] and got[1]["spans"][1]["first_word"] == 64
    assert 0.5 < got[1]["score"] < 1 and got[2]["score"] == 0
    nothing = langid.train(spark.createDataFrame([], SCHEMA))
    assert {r["lang_pred"] for r in langid.predict(spark.createDataFrame(tests, SCHEMA), nothing).collect()} == {"und"}
    assert langid.predict_held_out(spark.createDataFrame([], SCHEMA)).count() == 0
