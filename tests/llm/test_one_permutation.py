import random

import numpy as np
import pytest

from tests.llm import brute
from usagelens.llm import one_permutation

TEXTS = "doc_id long, text string"


def _check(spark, docs):
    rows = one_permutation.near_duplicates(spark.createDataFrame(docs, TEXTS).repartition(4)).collect()
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in rows}
    assert len(rows) == len(docs) and found == brute.near_duplicates(docs)


@pytest.fixture
def texts():
    rnd = random.Random(5)

    def words(n):
        return [rnd.choice("abcdefghijklmnopqrstuvwxyz") + str(rnd.randrange(400)) for _ in range(n)]

    docs = []
    for size in (3, 8, 60, 200):
        base = words(size)
        for _ in range(25):  # copies of one text, each edited elsewhere: a star
            own = list(base)
            for _ in range(rnd.randrange(3)):
                own[rnd.randrange(size)] = "edit" + str(rnd.randrange(10 ** 6))
            docs.append(" ".join(own))
        chain = words(size)
        for _ in range(15):  # each close to the one before only
            docs.append(" ".join(chain))
            chain = chain[max(1, size // 12):] + words(max(1, size // 12))
    docs += [" ".join(words(50)) for _ in range(40)] + docs[:30] + [docs[0].upper()]
    rnd.shuffle(docs)
    return [(i, t) for i, t in enumerate(docs)]


def test_stars_chains_and_copies_against_brute_force(spark, texts):
    _check(spark, texts)


def test_small_blocks_lose_nothing(spark, texts, monkeypatch):
    monkeypatch.setattr(one_permutation, "BLOCK", 4)
    _check(spark, texts)


def test_nulls_empty_and_long_texts(spark):
    long = " ".join(f"w{i % 5000}x{i}" for i in range(60_000))
    docs = [(5, None), (6, ""), (7, " \n\t"), (8, "one"), (9, "ONE"), (10, long), (11, long + " end"), (12, "a b c d")]
    _check(spark, docs)
    rows = one_permutation.near_duplicates(
        spark.createDataFrame([(None, "x y z"), (1, "x y z"), (None, None)], TEXTS)).collect()
    assert sorted(((r["doc_id"], r["component_id"], r["kept"]) for r in rows), key=str) == [
        (1, 1, True), (None, None, True), (None, None, True)]


def test_an_id_with_several_texts_joins_them(spark):
    a, b = "a b c d e f g h", "p q r s t u v w"
    docs = [(1, a), (2, a), (2, b), (3, b), (4, "k l m n o p q")]
    rows = one_permutation.near_duplicates(spark.createDataFrame(docs, TEXTS)).collect()
    assert sorted({(r["doc_id"], r["component_id"]) for r in rows}) == [(1, 1), (2, 1), (3, 1), (4, 4)]


def test_an_id_with_three_texts_joins_them_and_a_null_id_joins_nothing(spark):
    a, b, c = "a b c d e f g h", "p q r s t u v w", "1 2 3 4 5 6 7 8"
    rows = one_permutation.near_duplicates(spark.createDataFrame(
        [(1, a), (2, b), (3, c), (9, a), (9, b), (9, c)], TEXTS)).collect()
    assert {(r["doc_id"], r["component_id"]) for r in rows} == {(k, 1) for k in (1, 2, 3, 9)}
    rows = one_permutation.near_duplicates(spark.createDataFrame(
        [(1, a), (2, b), (None, a), (None, b)], TEXTS)).collect()
    assert {(r["doc_id"], r["component_id"], r["kept"]) for r in rows} == {
        (1, 1, True), (2, 2, True), (None, None, True)}


def test_empty_table_and_other_columns(spark):
    assert one_permutation.near_duplicates(spark.createDataFrame([], TEXTS)).collect() == []
    docs = spark.createDataFrame([(1, "a", "n"), (2, "a", "m")], "doc_id long, text string, node string")
    rows = one_permutation.near_duplicates(docs).collect()
    assert sorted((r["doc_id"], r["component_id"], r["kept"]) for r in rows) == [(1, 1, True), (2, 1, False)]


def test_filled_bins_agree_as_often_as_the_sets_do():
    rng = np.random.default_rng(1)
    for size in (4, 40, 400):
        agree = []
        for _ in range(200):
            own = np.unique(rng.integers(0, 2 ** 64, size, np.uint64))
            other = np.unique(np.r_[own[: size * 3 // 4], rng.integers(0, 2 ** 64, size // 4, np.uint64)])
            agree.append((one_permutation.signature(own) == one_permutation.signature(other)).mean())
        want = (size * 3 // 4) / (size + size // 4)
        assert abs(np.mean(agree) - want) < 0.05


def test_small_similar_sets_always_share_a_bucket():
    rng = np.random.default_rng(7)
    for size in range(1, one_permutation.SMALL_SET + 1):
        for _ in range(60):
            own = np.unique(rng.integers(0, 2 ** 64, size, np.uint64))
            kept = own[rng.random(len(own)) < 0.95]
            other = np.unique(np.r_[kept, rng.integers(0, 2 ** 64, rng.integers(0, 2 + size // 8), np.uint64)])
            inter = len(np.intersect1d(own, other))
            if len(other) <= one_permutation.SMALL_SET and 100 * inter >= 75 * (len(own) + len(other) - inter):
                assert set(one_permutation.small_buckets(own)) & set(one_permutation.small_buckets(other))


def test_many_short_texts_one_word_apart(spark):
    rnd = random.Random(11)
    docs = []
    for i in range(150):  # 7 and 8 words: three of four shingles in common at the threshold
        words = [f"w{rnd.randrange(10 ** 6)}" for _ in range(8)]
        docs += [(4 * i, " ".join(words)), (4 * i + 1, " ".join(words[:7])), (4 * i + 2, " ".join(words[1:])),
                 (4 * i + 3, " ".join(words[:-1] + ["other"]))]
    _check(spark, docs)


def test_blocks_are_cut_by_what_they_hold(spark, texts, monkeypatch):
    monkeypatch.setattr(one_permutation, "BLOCK_SHINGLES", 300)
    _check(spark, texts)
