"""Text quality by regularised quadratic discriminant analysis.

Every whole text is reduced to a few statistics, transformed towards normality. Per class,
Spark adds up count, sum and outer products of these vectors over all labelled training
rows (no sample); the class covariance is shrunk towards the pooled one and towards a
multiple of the identity, and its Cholesky factor is computed once on the driver. A score
is the logistic function of the difference of the two Mahalanobis log-densities plus the
log prior odds, so it is the model's probability of label 1.

Defined results: null and empty texts get the statistics of a text without words and are
scored like any other. Rows without a label are not learned from; a row whose label is
neither 0 nor 1 is not either. If one class has no training row, the score is the share of
label 1 there is (0.5 with no labels at all). Repeated rows count as often as they occur.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.llm.common import byte_values, ship_package

#: What of the pooled covariance, and of a spherical one, goes into a class covariance.
POOLED_SHARE = 0.05
SPHERE_SHARE = 0.02
THRESHOLD = 0.3
#: Log-density differences beyond this say nothing more; it keeps scores off 0 and 1.
LIMIT = 30.0

_KINDS = ["lower", "upper", "digit", "space", "line", "mark", "symbol", "wide"]
FEATURES = ["log_bytes", "upper", "digit", "space", "line", "mark", "symbol", "wide", "log_word",
            "distinct_words", "top_word", "distinct_lines", "marked_ends", "bars", "capitalised",
            "line_words"]


def _byte_classes() -> np.ndarray:
    kinds = np.zeros((256, len(_KINDS)))
    for byte in range(256):
        char = chr(byte)
        kind = ("wide" if byte >= 128 else "lower" if char.islower() else
                "upper" if char.isupper() else "digit" if char.isdigit() else
                "line" if char == "\n" else "space" if char.isspace() else
                "mark" if char in ".,;:'\"?-()" else "symbol")
        kinds[byte, _KINDS.index(kind)] = 1
    return kinds


_CLASSES = _byte_classes()
_SYMBOLS = tuple(bytes([b]) for b in range(33, 127) if _CLASSES[b, _KINDS.index("symbol")])


def statistics(text: bytes | None) -> list[float]:
    """The statistics of one whole text, in the order of FEATURES."""
    text = text or b""
    size = len(text)
    share = (np.bincount(np.frombuffer(text, np.uint8), minlength=256) @ _CLASSES) / max(size, 1)
    words = text.split()
    n = len(words)
    counts = Counter(words)
    lines = [x for x in text.split(b"\n") if x.strip()]
    ends = sum(w.endswith(_SYMBOLS) for w in words)
    heads = sum(65 <= w[0] <= 90 for w in words)
    root = [math.sqrt(v) for v in share[1:]]  # variance-stabilising for shares
    return [
        math.log1p(size), *root,
        math.log1p((size - text.count(b" ")) / max(n, 1)),
        math.log((len(counts) + 1) / (n + 1)) / math.log(n + 2) if n else 0.0,
        math.sqrt(max(counts.values()) / n) if n else 0.0,
        math.log((len(set(lines)) + 1) / (len(lines) + 1)),
        math.sqrt(ends / max(n, 1)),
        math.sqrt(counts.get(b"|", 0) / max(n, 1)),
        math.sqrt(heads / max(n, 1)),
        math.log1p(n / max(len(lines), 1)),
    ]


def add_statistics(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, stats): the vector of each text."""
    ship_package(docs.sparkSession)

    def compute(batches):
        for batch in batches:
            stats = [statistics(x) for x in byte_values(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(stats, pa.list_(pa.float64()))], names=[key, "stats"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(compute, f"`{key}` {kind}, stats array<double>")


@dataclass
class Model:
    share: float  # of label 1 in the training rows
    means: np.ndarray | None = None  # class x feature
    inverses: np.ndarray | None = None  # inverse Cholesky factor by class
    logdets: np.ndarray | None = None

    def score(self, stats: np.ndarray) -> np.ndarray:
        if self.means is None:
            return np.full(len(stats), self.share)
        logs = []
        for mean, inverse, logdet in zip(self.means, self.inverses, self.logdets):
            away = (stats - mean) @ inverse.T
            logs.append(-0.5 * ((away * away).sum(axis=1) + logdet))
        odds = logs[1] - logs[0] + math.log(self.share / (1 - self.share))
        return 1.0 / (1.0 + np.exp(-np.clip(odds, -LIMIT, LIMIT)))


def moments(labelled: DataFrame, label: str) -> DataFrame:
    """Count, sums and outer products by label: sums of a fixed size, added up by Spark."""
    ship_package(labelled.sparkSession)
    width = len(FEATURES)

    def add(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            stats = np.array(batch.column(0).to_pylist(), float).reshape(-1, width)
            labels = np.array(batch.column(1).to_pylist())
            for value in (0, 1):
                own = np.c_[np.ones((labels == value).sum()), stats[labels == value]]
                total[value] = total.get(value, 0) + own.T @ own
        for value, matrix in total.items():
            flat = matrix.ravel()
            yield pa.RecordBatch.from_arrays(
                [pa.array([value] * len(flat), pa.int32()),
                 pa.array(range(len(flat)), pa.int32()), pa.array(flat)],
                names=["label", "place", "value"])

    return (labelled.select("stats", F.col(label).cast("int"))
            .mapInArrow(add, "label int, place int, value double")
            .groupBy("label", "place").agg(F.sum("value").alias("value")))


def fit(labelled: DataFrame, label: str = "quality") -> Model:
    """The model of rows with ``stats`` and a 0/1 label."""
    size = len(FEATURES) + 1
    sums = np.zeros((2, size * size))
    rows = labelled.where(F.col(label).isin(0, 1))
    for row in moments(rows, label).collect():  # 2 x 17 x 17 numbers
        sums[row["label"], row["place"]] = row["value"]
    sums = sums.reshape(2, size, size)
    n = sums[:, 0, 0]
    if n.sum() == 0:
        return Model(0.5)
    if min(n) < 2:
        return Model(float(n[1] / n.sum()))
    means = sums[:, 0, 1:] / n[:, None]
    spread = [sums[c, 1:, 1:] - n[c] * np.outer(means[c], means[c]) for c in (0, 1)]
    pooled = (spread[0] + spread[1]) / n.sum()
    # Spherical in units of each statistic's own pooled variance.
    sphere = np.diag(np.maximum(np.diag(pooled), 1e-6))
    factors = []
    for c in (0, 1):
        own = (1 - POOLED_SHARE) * spread[c] / n[c] + POOLED_SHARE * pooled
        factors.append(np.linalg.cholesky((1 - SPHERE_SHARE) * own + SPHERE_SHARE * sphere))
    return Model(float(n[1] / n.sum()), means,
                 np.array([np.linalg.inv(f) for f in factors]),
                 np.array([2 * np.log(np.diag(f)).sum() for f in factors]))


def score(stats: DataFrame, model: Model, key: str = "doc_id") -> DataFrame:
    """(key, score, predicted) of every row of ``add_statistics``."""
    ship_package(stats.sparkSession)

    def run(batches):
        for batch in batches:
            vectors = np.array(batch.column(1).to_pylist(), float).reshape(-1, len(FEATURES))
            found = model.score(vectors)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found), pa.array((found >= THRESHOLD).astype(np.int32))],
                names=[key, "score", "predicted"])

    kind = stats.schema[key].dataType.simpleString()
    return stats.select(key, "stats").mapInArrow(
        run, f"`{key}` {kind}, score double, predicted int")
