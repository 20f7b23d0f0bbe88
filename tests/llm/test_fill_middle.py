import random

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tests.llm import brute
from usagelens.llm import fill_middle

TEXTS = "doc_id long, text string"


def _random_text(rng, size):
    return "".join(rng.choice("abcXYZ" * 3 + " .\n1é中😀<") for _ in range(size))


def _run(spark, rows, **options):
    docs = spark.createDataFrame(rows, TEXTS).repartition(2)
    found = fill_middle.fill_in_middle(docs, **options)
    return found.withColumn("restored", fill_middle.restore(F.col("text"), F.col("form"))).collect()


def test_against_plain_lists_with_small_blocks_and_exact_round_trip(spark):
    rng = random.Random(2)
    rows = [(i, _random_text(rng, rng.randrange(0, 120))) for i in range(400)]
    texts, forms = dict(rows), set()
    for r in _run(spark, rows, block_bytes=8):
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["text"]) \
            == brute.middle_filled(r["doc_id"], texts[r["doc_id"]])
        assert r["restored"] == texts[r["doc_id"]]
        forms.add(r["form"])
    assert forms == {"plain", "psm", "spm"}


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=60), st.integers(1, 9), st.integers(0, 2 ** 32 - 1))
def test_every_cut_of_any_text(text, block_bytes, number):
    index = fill_middle.UnitIndex(text.encode(), block_bytes)
    units = __import__("re").findall(r"[A-Za-z]+|[^A-Za-z]", text)
    assert index.n == len(units) and index.n_chars == len(text)
    at = number % (index.n + 1)
    before = "".join(units[:at])
    assert index.cut(at) == (len(before.encode()), len(before))


def test_a_very_long_text_and_a_word_longer_than_a_stride(spark):
    rng = random.Random(4)
    rows = [(1, _random_text(rng, 50_000) * 20), (2, "x" * 3_000_000), (3, "é" * 700_000 + "y" * 1_500_000),
            (4, "word " * 400_000)]
    texts = dict(rows)
    for r in _run(spark, rows):
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["text"]) \
            == brute.middle_filled(r["doc_id"], texts[r["doc_id"]])
        assert r["restored"] == texts[r["doc_id"]]


def test_marks_nulls_repeats_and_ids(spark):
    rows = [(1, None), (2, ""), (3, "a <P> b"), (4, "<S>"), (5, "x<M>"), (None, "some words here"),
            (None, "some words here"), *[(i, "< <P <S< <M P> S> M> >>") for i in range(20, 60)]]
    found = _run(spark, rows)
    for r in found:
        text = {1: None, 2: "", 3: "a <P> b", 4: "<S>", 5: "x<M>", None: "some words here"}.get(
            r["doc_id"], "< <P <S< <M P> S> M> >>")
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["text"]) == brute.middle_filled(r["doc_id"], text)
        assert r["restored"] == (text or "")
    assert len(found) == len(rows) and {r["form"] for r in found if r["doc_id"] in (1, 2, 3, 4, 5)} == {"plain"}


def test_columns_that_clash_and_empty_tables(spark):
    docs = spark.createDataFrame([("k", "one two three", "x", 5, "f")], "doc_id string, text string, n string, `a.b` int, form string")
    row = fill_middle.fill_in_middle(docs).head()
    assert row["n"] == 5 and row["a.b"] == 5 and row["form"] in ("plain", "psm", "spm")
    empty = fill_middle.fill_in_middle(spark.createDataFrame([], TEXTS))
    assert empty.collect() == [] and empty.columns == ["doc_id", "text", *fill_middle.ADDED.names]


def test_shares_follow_the_percentages(spark):
    rows = [(i, "a b c d e f") for i in range(2000)]
    found = _run(spark, rows, plain_percent=50, spm_percent=50)
    plain = sum(r["form"] == "plain" for r in found)
    assert 900 < plain < 1100 and 400 < sum(r["form"] == "spm" for r in found) < 600
