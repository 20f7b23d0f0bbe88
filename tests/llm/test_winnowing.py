import random
import time

import pytest

from tests.llm import brute
from usagelens.llm import winnowing
from usagelens.llm.queries import QUERIES

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"
FIELDS = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


def _check(spark, docs, items):
    rows = winnowing.decontaminate(spark.createDataFrame(docs, DOCS).repartition(3),
                                   spark.createDataFrame(items, ITEMS)).collect()
    found = sorted((tuple(r[f] for f in FIELDS) for r in rows), key=str)
    assert found == sorted(brute.contamination(docs, items), key=str)
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_random_texts_against_brute_force(spark, seed):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(6 + 20 * seed)]

    def text(n):
        return " ".join(rnd.choice(vocabulary) for _ in range(n))

    items = [(i, text(rnd.choice([1, 2, 5, 9, 12, 13, 14, 25, 60]))) for i in range(14)]
    docs = []
    for i in range(40):
        body = text(rnd.choice([0, 3, 12, 13, 40, 120]))
        if rnd.random() < 0.6:
            own = rnd.choice(items)[1].split()
            a = rnd.randrange(len(own))
            body += " " + " ".join(own[a:a + rnd.choice([12, 13, 14, 40])]) + " " + text(5)
        docs.append((i, body))
    _check(spark, docs, items)


def test_edges(spark):
    passage = " ".join(f"p{i}" for i in range(20))
    docs = [(1, passage), (2, None), (3, ""), (4, "... !"), (None, passage), (5, passage.upper() + " É é"),
            (6, passage), (6, passage), (7, "x " * 50_000 + passage), (8, " ".join(passage.split()[:12])),
            (9, passage + " " + passage), (6, "other text")]
    items = [(1, passage), (1, passage), (2, None), (3, "?"), (None, passage), (4, "other text"), (10, passage)]
    rows = _check(spark, docs, items)
    by = {(r["doc_id"], r["n_words"]): r for r in rows}
    assert by[9, 40]["n_hit"] == 40 and by[8, 12]["n_hit"] == 0 and not by[7, 50_020]["contaminated"]
    assert by[1, 20]["n_items"] == 2


def test_empty_tables(spark):
    assert winnowing.decontaminate(spark.createDataFrame([], DOCS), spark.createDataFrame([(1, "a")], ITEMS)).collect() == []
    rows = winnowing.decontaminate(spark.createDataFrame([(1, "a b")], DOCS), spark.createDataFrame([], ITEMS)).collect()
    assert [(r["n_words"], r["n_hit"], r["contaminated"]) for r in rows] == [(2, 0, False)]


def test_other_columns_with_the_same_names(spark):
    docs = spark.createDataFrame([(1, "a b c", 9, "x")], "doc_id long, text string, n_words int, item string")
    items = spark.createDataFrame([(5, "b", "z")], "item_id long, text string, words string")
    row = winnowing.decontaminate(docs, items).first()
    assert (row["n_words"], row["n_hit"], row["n_items"]) == (3, 1, 1)


def test_no_python_in_the_plan(spark):
    plan = QUERIES["op3_decontamination"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Arrow", "Pandas", "Cartesian"))


@pytest.mark.parametrize("width", [1, 3, 13, 20])
def test_texts_of_one_word_over_and_over(spark, width):
    docs = [(1, "la " * 400), (2, "la " * 5 + "di " + "la " * 30), (3, "di da"), (4, "la")]
    _check(spark, docs, [(1, "la " * width), (2, "la di " + "la " * width)])


def test_time_grows_with_the_length_of_repeated_words(spark):
    def seconds(n):
        docs = spark.createDataFrame([(1, "la " * n)], DOCS)
        items = spark.createDataFrame([(1, "la"), (2, "la " * 20)], ITEMS)
        started = time.perf_counter()
        row = winnowing.decontaminate(docs, items).first()
        assert (row["n_words"], row["n_hit"], row["n_items"]) == (n, n, 2)
        return time.perf_counter() - started

    seconds(1000)
    assert seconds(200_000) < 2 * seconds(100_000) + 2
