import random

import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from usagelens.llm import raking
from usagelens.llm.queries import QUERIES

DOCS = "doc_id long, text string, lang string, source string"


def test_margins_meet_their_targets(spark):
    cells = spark.createDataFrame([(s, t, n) for s, t, n in (
        ("a", "x", 50), ("a", "y", 10), ("b", "x", 5), ("b", "y", 30), ("c", "x", 5), ("c", "z", 7))],
        "source string, topic string, n long")
    targets = {"source": spark.createDataFrame([("a", 1.0), ("b", 1.0), ("c", 2.0), ("gone", 4.0)], "source string, share double"),
               "topic": spark.createDataFrame([("x", 0.3), ("y", 0.4), ("z", 0.3)], "topic string, share double")}
    rows = raking.rake(cells, targets).collect()
    for margin, want in (("source", {"a": .25, "b": .25, "c": .5}), ("topic", {"x": .3, "y": .4, "z": .3})):
        for value, share in want.items():
            assert sum(r["weight"] for r in rows if r[margin] == value) == pytest.approx(share, abs=1e-9)


def test_probabilities_meet_the_size_and_take_rare_cells_whole(spark):
    cells = {("a", "", ""): 1000, ("b", "", ""): 10, ("c", "", ""): 200, ("d", "", ""): 0}
    weights = {("a", "", ""): 0.2, ("b", "", ""): 0.4, ("c", "", ""): 0.4, ("d", "", ""): 0.0}
    raked = spark.createDataFrame([(*c, n, weights[c]) for c, n in cells.items()],
                                  "source string, lang string, topic string, n long, weight double")
    found = {(r["source"], r["lang"], r["topic"]): r["prob"] for r in raking.probabilities(raked, 0.5).collect()}
    want = brute.probabilities(cells, weights, 0.5)
    assert found == {c: pytest.approx(p, abs=1e-8) for c, p in want.items()}
    assert found["b", "", ""] == 1.0 and found["d", "", ""] == 0.5
    assert sum(found[c] * n for c, n in cells.items()) == pytest.approx(605, abs=1e-4)


def test_documents_against_plain_loops(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    docs = [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in rows]
    docs += [(10_001, None, None, None), (10_002, "", "en", None), (10_003, "é " * 50_000, None, "src1")]
    found = raking.mix(spark.createDataFrame(docs, DOCS).withColumn("topic", raking.content_kind(F.col("text")))).collect()
    want = brute.mixed(docs)
    assert {r["doc_id"]: r["kept"] for r in found} == {k: v[1] for k, v in want.items()}
    for r in found:
        assert r["prob"] == pytest.approx(want[r["doc_id"]][0], abs=1e-6)


def test_ties_nulls_empty_tables_and_clashing_columns(spark):
    schema = DOCS + ", topic string, prob string, kept int"
    docs = spark.createDataFrame([(None, "a b", "x", "s", "t", "p", 1)] * 2 + [(1, None, None, None, None, None, None)], schema)
    rows = raking.mix(docs, fraction=1.0).collect()
    assert len(rows) == 3 and [r["prob"] for r in rows] == [1.0] * 3 and all(r["kept"] for r in rows)
    assert raking.mix(spark.createDataFrame([], schema)).collect() == []


def test_no_python_in_the_plan(spark):
    plan = QUERIES["op7_mixing"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Arrow", "Pandas", "Cartesian"))


@pytest.mark.parametrize("seed", range(3))
def test_sparse_targets_that_can_be_met_are_met(spark, seed):
    rng = random.Random(seed)
    names = [f"v{i}" for i in range(6)]
    # Weights drawn for few cells give targets that those cells can meet.
    drawn = {(s, t): 0.05 + rng.random() for s in names for t in names if rng.random() < 0.4 or s == t}
    total = sum(drawn.values())
    cells = spark.createDataFrame([(s, t, rng.randrange(1, 1000)) for s, t in drawn], "source string, topic string, n long")
    goals = [{v: sum(w for c, w in drawn.items() if c[at] == v) / total for v in names} for at in (0, 1)]
    targets = {m: spark.createDataFrame(list(g.items()), f"{m} string, share double") for m, g in zip(("source", "topic"), goals)}
    rows = raking.rake(cells, targets, tolerance=1e-7).collect()
    for at, (margin, goal) in enumerate(zip(("source", "topic"), goals)):
        for value, share in goal.items():
            assert sum(r["weight"] for r in rows if r[margin] == value) == pytest.approx(share, abs=1e-6)


def test_targets_that_cannot_be_met_are_told(spark):
    cells = spark.createDataFrame([("a", "x", 5), ("b", "y", 5)], "source string, topic string, n long")
    targets = {"source": spark.createDataFrame([("a", 0.2), ("b", 0.8)], "source string, share double"),
               "topic": spark.createDataFrame([("x", 0.5), ("y", 0.5)], "topic string, share double")}
    with pytest.warns(UserWarning, match="off by 0.3"):
        rows = raking.rake(cells, targets, max_sweeps=10).collect()
    assert {r["topic"]: r["weight"] for r in rows} == {"x": pytest.approx(0.5), "y": pytest.approx(0.5)}


def test_no_window_over_all_cells(spark):
    cells = spark.createDataFrame([("a", "x", "y", 5, 1.0)], "source string, lang string, topic string, n long, weight double")
    plan = raking.probabilities(cells)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
