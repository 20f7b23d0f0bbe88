import numpy as np

from tests.llm import brute
from usagelens.llm import naive_bayes
from usagelens.llm.queries import QUERIES

DOCS = "doc_id long, text string, lang string"


def test_held_out_accuracy(spark):
    rows = QUERIES["op8_language"](spark, "/root/testdata/sf0.01").collect()
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    assert len(rows) == len(lang) and all(r["held_out"] == (brute.fold(r["doc_id"], 5) == 0) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_scores_are_the_mean_log_probabilities(spark):
    training = spark.createDataFrame([(1, "ab ab abc", "x"), (2, "bca bb", "y")], DOCS)
    names, matrix = naive_bayes.fit(training)
    assert names == ["x", "y"] and np.allclose(np.exp(matrix).sum(axis=0), 1)
    grams = [b for buckets, _ in naive_bayes._grams(["abc"]) for b in buckets]
    assert len(grams) == 3 + 4 + 3  # a b c, _a ab bc c_, _ab abc bc_
    logit = matrix[grams].mean(axis=0) * len(grams)
    want = np.exp(logit.max() - logit.max()) / np.exp(logit - logit.max()).sum()
    row = naive_bayes.identify(spark.createDataFrame([(3, "ABC!", None)], DOCS), (names, matrix)).first()
    assert row["lang_pred"] == names[int(logit.argmax())] and abs(row["score"] - want) < 1e-5


def test_undetermined_ties_and_long_texts(spark):
    model = naive_bayes.fit(spark.createDataFrame([(1, "aa", "x"), (2, "aa", "w"), (3, None, "v"), (4, "zz", None)], DOCS))
    assert model[0] == ["w", "x"]
    long = "aa " * 3_000_000
    docs = spark.createDataFrame([(1, None, 1, "s"), (2, "", 2, "s"), (3, "12 !?", 3, "s"), (4, "aa", 4, "s"), (5, long, 5, "s"),
                                  (None, "aa", 6, "s")], "doc_id long, text string, score int, lang_pred string")
    rows = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in naive_bayes.identify(docs, model).collect()}
    assert rows[1] == rows[2] == rows[3] == ("und", 0.0)
    assert rows[4][0] == rows[5][0] == rows[None][0] == "w" and abs(rows[4][1] - 0.5) < 1e-6


def test_nothing_to_learn_from_and_nothing_to_score(spark):
    model = naive_bayes.fit(spark.createDataFrame([], DOCS))
    assert naive_bayes.identify(spark.createDataFrame([(1, "aa", "x")], DOCS), model).first()["lang_pred"] == "und"
    assert naive_bayes.identify(spark.createDataFrame([], DOCS), model).collect() == []


def test_repeated_rows_count_each(spark):
    once = naive_bayes.fit(spark.createDataFrame([(1, "ab", "x")], DOCS))
    twice = naive_bayes.fit(spark.createDataFrame([(1, "ab", "x")] * 2, DOCS))
    assert twice[1].max() > once[1].max()
