import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from usagelens.llm import discriminant
from usagelens.llm.queries import QUERIES

DOCS = "doc_id long, text string"


def test_held_out_accuracy(spark):
    rows = {r["doc_id"]: r for r in QUERIES["op4_quality"](spark, "/root/testdata/sf0.01").collect()}
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()
    assert len(rows) == 1000 and all(r["held_out"] == (brute.fold(k, 5) == 0) for k, r in rows.items())
    held = [(rows[r["doc_id"]], r["quality"]) for r in labels if rows[r["doc_id"]]["held_out"]]
    assert sum(r["predicted"] == q for r, q in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows.values())


def test_scores_are_log_density_differences():
    rng = np.random.default_rng(0)
    width = len(discriminant.FEATURES)
    means, covariances = rng.normal(size=(2, width)), []
    for _ in range(2):
        a = rng.normal(size=(width, width))
        covariances.append(a @ a.T + np.eye(width))
    factors = [np.linalg.cholesky(c) for c in covariances]
    model = discriminant.Model(0.25, means, np.array([np.linalg.inv(f) for f in factors]),
                               np.array([np.linalg.slogdet(c)[1] for c in covariances]))
    x = rng.normal(size=(5, width))
    for row, found in zip(x, model.score(x)):
        logs = [-0.5 * ((row - m) @ np.linalg.inv(c) @ (row - m) + np.linalg.slogdet(c)[1])
                for m, c in zip(means, covariances)]
        odds = np.clip(logs[1] - logs[0] + np.log(0.25 / 0.75), -30, 30)
        assert found == pytest.approx(1 / (1 + np.exp(-odds)))


def test_sums_equal_direct_ones(spark):
    rng = np.random.default_rng(1)
    width = len(discriminant.FEATURES)
    x, y = rng.normal(size=(50, width)), rng.integers(0, 2, 50)
    rows = spark.createDataFrame([(v.tolist(), int(q)) for v, q in zip(x, y)], "stats array<double>, quality int")
    model = discriminant.fit(rows.unionByName(rows.limit(1).withColumn("quality", F.lit(None).cast("int"))).repartition(3))
    assert model.share == pytest.approx(y.mean())
    assert np.allclose(model.means, [x[y == 0].mean(axis=0), x[y == 1].mean(axis=0)])


def test_null_empty_long_texts_and_repeats(spark):
    long = "Word " * 400_000
    docs = spark.createDataFrame([(1, None, 0), (2, "", 0), (3, " \n ", 0), (4, long, 0), (4, long, 0), (None, "a b", 0)],
                                 "doc_id long, text string, stats int")
    rows = discriminant.add_statistics(docs).collect()
    assert len(rows) == 6 and all(np.isfinite(r["stats"]).all() for r in rows)
    by = {r["doc_id"]: r["stats"] for r in rows}
    assert by[1] == by[2]


@pytest.mark.parametrize("labels, want", [([], 0.5), ([1, 1], 1.0), ([0, 0, 1], 1 / 3)])
def test_too_few_labels(spark, labels, want):
    width = len(discriminant.FEATURES)
    rows = spark.createDataFrame([([0.0] * width, q) for q in labels], "stats array<double>, quality int")
    model = discriminant.fit(rows)
    assert model.score(np.zeros((1, width)))[0] == pytest.approx(want)


def test_empty_table(spark):
    stats = discriminant.add_statistics(spark.createDataFrame([], DOCS))
    assert discriminant.score(stats, discriminant.Model(0.5)).collect() == []
