import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from usagelens.llm import hard_negatives

VECTORS = "vec_id long, label int, embedding array<double>"
NAMES = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def _mined(spark, rows, step, schema=VECTORS, **options):
    found = hard_negatives.mine(spark.createDataFrame(rows, schema).repartition(3), F.col("vec_id") % step == 0, **options)
    assert found.columns == NAMES
    return sorted(tuple(r) for r in found.collect())


@pytest.mark.parametrize("dims", [1, 8, 13, 64])
def test_scores_are_exact_inner_products(dims):
    rng = np.random.default_rng(dims)
    for bound in (1, 255, 70_000):
        rows = rng.integers(-bound, bound + 1, (50, dims))
        anchors = rng.integers(-bound, bound + 1, (7, dims))
        planes = int(bound + 1).bit_length() + 1
        codes = hard_negatives.pack(rows, planes)
        assert (hard_negatives.unpack(codes, dims) == rows).all()
        assert (hard_negatives.scores(codes.transpose(1, 2, 0), anchors) == rows @ anchors.T).all()


@pytest.mark.parametrize("small", [False, True])
def test_against_plain_loops_with_ties(spark, monkeypatch, small):
    if small:  # several blocks
        monkeypatch.setattr(hard_negatives, "SMALL_BLOCK_ROWS", 40)
    rng = random.Random(9)
    rows = [(i, rng.randrange(4), [rng.choice([0.0, 0.25, 0.5, -0.25, rng.uniform(-1, 1)]) for _ in range(11)])
            for i in range(300)]
    rows += [(1000 + i, i % 3, [0.5] * 11) for i in range(30)]  # many equal scores
    want = sorted(brute.hard_negatives(rows, lambda i: i % 20 == 0))
    assert len(want) > 200 and _mined(spark, rows, 20) == want


def test_window_limits_count_and_signs(spark):
    # Scores with the anchor (1.0): positive 100 * 256, negatives right at 30 and 90 percent.
    rows = [(0, 1, [1.0, 0.0]), (1, 1, [100 / 256, 0.0]), (2, 2, [30 / 256, 0.0]), (3, 2, [90 / 256, 0.0]),
            (4, 2, [91 / 256, 0.0]), (5, 2, [29 / 256, 0.0]), (6, 3, [-60 / 256, 0.0])]
    assert [r[3] for r in _mined(spark, rows, 100)] == [3, 2]
    # A negative or zero positive score opens an empty window, or that of 0 alone.
    assert _mined(spark, [(0, 1, [1.0]), (1, 1, [-1.0]), (2, 2, [-0.5])], 100) == []
    assert _mined(spark, [(0, 1, [1.0]), (1, 1, [0.0]), (2, 2, [0.0])], 100) == [(0, 1, 1, 2, 0, 0)]


def test_fewer_rows_than_asked_for(spark):
    rows = [(0, 1, [1.0]), (1, 1, [1.0]), (2, 2, [0.5]), (100, 5, [1.0])]
    assert _mined(spark, rows, 100) == [(0, 1, 1, 2, 65536, 32768)]


def test_rows_that_take_no_part_and_mixed_lengths(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(None, 1, [1.0, 1.0]), (0, 1, [1.0, 0.5]), (1, 1, [0.9, 0.1]), (2, None, [0.5, 0.5]), (3, 2, None),
            (4, 2, [nan, 0.5]), (5, 2, [0.5, None]), (6, 2, [inf, 0.1]), (7, 2, [0.5, -0.1]), (8, 2, [0.5]),
            (100, 3, []), (101, 3, []), (102, 4, []), (9, 2, [0.4, 0.2])]
    want = sorted(brute.hard_negatives(rows, lambda i: i % 100 == 0))
    assert _mined(spark, rows, 100) == want
    assert [r[3] for r in want if r[0] == 0] == [9, 7] and (100, 101, 1, 102, 0, 0) in want


def test_repeated_rows_count_once(spark):
    rows = [(0, 1, [1.0]), (1, 1, [1.0]), (2, 2, [0.5])]
    assert _mined(spark, rows * 3, 100) == _mined(spark, rows, 100)
    twins = _mined(spark, [*rows, (0, 1, [0.75])], 100)  # another row under the anchor's id
    assert {(r[0], r[1]) for r in twins} == {(0, 1)} and len(twins) == 2


def test_floor_of_negative_and_float_components(spark):
    rows = [(0, 1, [0.1, -0.1]), (1, 1, [0.3, -0.7]), (2, 2, [0.123, -0.456]), (3, 2, [0.2, -0.0039])]
    floats = [(i, label, [float(np.float32(x)) for x in v]) for i, label, v in rows]
    assert _mined(spark, rows, 100, "vec_id long, label int, embedding array<float>") \
        == sorted(brute.hard_negatives(floats, lambda i: i == 0))


def test_empty_table_clashing_columns_and_too_large_components(spark):
    assert _mined(spark, [], 100) == []
    schema = VECTORS + ", id int, code string, block int, content string, anchor int"
    rows = [(0, 1, [1.0], 1, "c", 2, "d", 3), (1, 1, [1.0], 1, "c", 2, "d", 3), (2, 2, [0.5], 1, "c", 2, "d", 3)]
    assert len(_mined(spark, rows, 100, schema)) == 1
    with pytest.raises(ValueError):
        _mined(spark, [(0, 1, [1e12]), (1, 1, [1.0])], 100)
