import random
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from tests.llm import brute
from usagelens.llm import line_dedup

TEXTS = "doc_id long, text string"
LONG = "This line is long enough to count as one, surely."


def _rows(df):
    return Counter((r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in df.collect())


def _agrees(spark, rows, **options):
    found = line_dedup.drop_repeated_lines(spark.createDataFrame(rows, TEXTS).repartition(3), **options)
    assert _rows(found) == Counter(brute.deduplicated(rows, **{k: v for k, v in options.items() if k != "hot_keys"}))


@pytest.mark.parametrize("hot_keys", [10_000, 3, 1])
def test_against_plain_loops(spark, hot_keys):
    rng = random.Random(5)
    pool = [f"Line number {i} of those that are found in many texts, {'x' * i}" for i in range(30)]
    rows = []
    for key in range(60):
        lines = [rng.choice(pool[:1] * 10 + pool + ["", "short", f"only in {key} " + "y" * 40])
                 for _ in range(rng.randrange(0, 25))]
        rows.append((key, "\n".join(rng.choice(["", "  ", "\t"]) + rng.choice([x, x.upper()]) for x in lines)))
    _agrees(spark, rows, hot_keys=hot_keys)


def test_threshold_keeper_and_places(spark):
    rows = [(i, f"a\n{LONG}\nb\n  {LONG.upper()}\t") for i in range(1, 6)]
    found = {r["doc_id"]: r for r in line_dedup.drop_repeated_lines(spark.createDataFrame(rows, TEXTS)).collect()}
    assert found[5]["text"] == rows[4][1] and found[5]["n_dropped"] == 0
    assert all((found[i]["text"], found[i]["n_lines"], found[i]["n_dropped"]) == ("a\nb", 4, 2) for i in range(1, 5))
    four = spark.createDataFrame(rows[:4], TEXTS)
    assert all(r["n_dropped"] == 0 for r in line_dedup.drop_repeated_lines(four).collect())


def test_length_counts_code_points_and_only_a_to_z_change_case(spark):
    for line in ("é" * 39 + "A", "é" * 39, "É" * 40, "K" * 40, " " + "z" * 39 + "\x0b"):
        _agrees(spark, [(i, line if i % 2 else line.replace("A", "a")) for i in range(6)])
    assert {r["n_dropped"] for r in line_dedup.drop_repeated_lines(spark.createDataFrame(
        [(i, ("É" if i < 3 else "é") * 40) for i in range(6)], TEXTS)).collect()} == {0}


def test_nulls_repeats_empty_and_very_long_texts(spark):
    many = "\n".join(f"line {i} of a text with very many lines, padded {'z' * 10}" for i in range(30_000))
    rows = [(None, LONG), (None, None), (1, None), (2, ""), (3, "\n\n"), (7, many), (8, many), (9, many),
            (10, many), (11, many + "\nend"), (12, LONG), (12, LONG), (12, "own\n" + LONG), *[(i, LONG) for i in range(13, 17)]]
    _agrees(spark, rows)


def test_a_line_of_no_document_is_not_frequent(spark):
    _agrees(spark, [(None, LONG)] * 9 + [(1, LONG)] * 9)


def test_all_lines_of_a_text_may_go(spark):
    rows = [(i, LONG) for i in range(9)]
    found = line_dedup.drop_repeated_lines(spark.createDataFrame(rows, TEXTS)).collect()
    assert Counter(r["text"] for r in found) == {"": 8, LONG: 1}


def test_columns_that_clash_and_empty_tables(spark):
    schema = "doc_id string, text string, n_lines string, id int, at int, h1 int, keeper int, `a.b` int, row string"
    docs = spark.createDataFrame([(str(i), f"{LONG}\n{i}", "x", i, 2, 3, 4, 5, "r") for i in range(5)], schema)
    found = {r["doc_id"]: r for r in line_dedup.drop_repeated_lines(docs).collect()}
    assert found["0"]["text"] == "0" and found["4"]["text"] == f"{LONG}\n4" and found["0"]["n_lines"] == 2
    assert found["3"]["a.b"] == 5 and found["3"]["row"] == "r" and found["3"]["id"] == 3
    empty = line_dedup.drop_repeated_lines(spark.createDataFrame([], TEXTS))
    assert empty.collect() == [] and empty.columns == ["doc_id", "text", "n_lines", "n_dropped"]


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 5), st.text("aB \t\n", max_size=12)), max_size=12))
def test_any_small_table(spark, rows):
    _agrees(spark, rows, min_chars=2, min_docs=2)
