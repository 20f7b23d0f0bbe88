import numpy as np
import pytest

from tests.llm import brute
from usagelens.llm import metric_join

SCHEMA = "vec_id long, embedding array<float>, label int"


def _want(rows):
    good = {k: (label, np.array(v, float)) for k, v, label in rows
            if label is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    links = [(a, b) for a, (la, x) in good.items() for b, (lb, y) in good.items()
             if a < b and la == lb and len(x) == len(y)
             and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.98]
    found = brute.components([r[0] for r in rows], links)
    return {k: (sum(k in p for p in links), found[k], found[k] == k) for k, _, _ in rows}


def _check(spark, rows):
    out = metric_join.near_vectors(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    assert len(out) == len(rows)
    assert {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in out} == _want(rows)


@pytest.fixture
def vectors():
    rng = np.random.default_rng(3)
    rows = []
    for label in (0, 1, 2):
        for _ in range(60):
            rows.append((rng.normal(size=8), label))
        for spread in (0.02, 0.05, 0.09):  # groups near and around the limit
            base = rng.normal(size=8)
            rows += [(base + spread * rng.normal(size=8), label) for _ in range(40)]
        rows += [(rows[-1][0], label)] * 25  # copies
    order = rng.permutation(len(rows))
    return [(int(i), [float(np.float32(x)) for x in rows[j][0]], rows[j][1]) for i, j in enumerate(order)]


def test_against_all_pairs(spark, vectors):
    _check(spark, vectors)


def test_many_cells_and_small_blocks(spark, vectors, monkeypatch):
    monkeypatch.setattr(metric_join, "CELL", 16)
    monkeypatch.setattr(metric_join, "BLOCK", 16)
    monkeypatch.setattr(metric_join, "PLACE", 50)
    _check(spark, vectors)


def test_scaled_float32_copies_keep_the_links_of_their_neighbours(spark, monkeypatch):
    """Copies of one vector at many scales differ by their rounding to float32 only; pivots
    among them nearly coincide."""
    monkeypatch.setattr(metric_join, "CELL", 16)
    rng = np.random.default_rng(11)
    base = rng.normal(size=32)
    base /= np.linalg.norm(base)
    made = [base * scale for scale in rng.uniform(0.5, 2.0, 600)]
    for cosine in np.linspace(0.9801, 0.999, 120):
        side = rng.normal(size=32)
        side -= base * (side @ base)
        made.append(cosine * base + np.sqrt(1 - cosine ** 2) * side / np.linalg.norm(side))
    made += list(rng.normal(size=(40, 32)))
    rows = [(i, [float(np.float32(x)) for x in v], 0) for i, v in enumerate(made)]
    units = np.array([r[1] for r in rows])
    units /= np.linalg.norm(units, axis=1)[:, None]
    want = (units @ units.T >= 0.98).sum(axis=1) - 1
    out = metric_join.near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r["vec_id"]: r["n_links"] for r in out} == dict(enumerate(want.tolist()))


def test_vectors_that_link_with_nothing(spark):
    nan, inf = float("nan"), float("inf")
    one = [1.0, 0.0]
    _check(spark, [(1, one, 0), (2, [2.0, 0.0], 0), (3, one, None), (4, None, 0), (5, [], 0), (6, [0.0, 0.0], 0),
                   (7, [1.0, None], 0), (8, [nan, 1.0], 0), (9, [inf, 1.0], 0), (10, one, 1), (11, [1.0], 0),
                   (12, [1e38, 0.0], 0), (13, [1e-38, 0.0], 0), (14, [-1.0, 0.0], 0)])


def test_null_and_repeated_ids(spark):
    rows = spark.createDataFrame([(None, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (1, [0.0, 1.0], 0),
                                  (2, [0.0, 2.0], 0), (2, [0.0, 2.0], 0)], SCHEMA)
    out = sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in metric_join.near_vectors(rows).collect()), key=str)
    assert out == [(1, 0, 1), (1, 2, 1), (2, 2, 1), (2, 2, 1), (None, 0, None)]


def test_an_id_with_three_vectors_joins_them(spark):
    x, y, z = np.eye(3).tolist()
    rows = [(9, x, 0), (9, y, 0), (9, z, 0), (2, x, 0), (3, y, 0), (4, z, 0)]
    out = metric_join.near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {(r["vec_id"], r["component_id"]) for r in out} == {(k, 2) for k in (2, 3, 4, 9)}


def test_empty_table_and_other_columns(spark):
    assert metric_join.near_vectors(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = spark.createDataFrame([(1, [1.0], 0, "x"), (2, [1.0], 0, "y")],
                                 "vec_id long, embedding array<float>, label int, node string")
    assert sorted(r["n_links"] for r in metric_join.near_vectors(rows).collect()) == [1, 1]
