"""Language identification by multinomial naive Bayes over hashed character n-grams.

N-grams of one to three characters inside words, word ends included, are hashed into
``BUCKETS`` buckets. Spark adds up bucket counts per language over the whole training
corpus; the matrix of log-probabilities (languages x buckets, at most ``MAX_LANGUAGES``
languages, so at most 64 MB) is broadcast; scoring gathers matrix rows for the n-grams of
many texts at once and adds them up by text.

Defined results: a null text, a text without a letter and a corpus without training rows
give ``und`` with score 0. Rows with null language are never learned from. Ties go to the
language first in code-point order. Repeated rows count as often as they occur. Columns
other than the named ones pass through ``identify`` untouched, except that columns named
like its results are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from usagelens.llm.common import byte_values, in_chunks, ship_package, slices

BUCKETS = 1 << 15
ORDERS = (1, 2, 3)
SMOOTHING = 0.5
#: A bound of the broadcast matrix, not of the data: more languages are an error.
MAX_LANGUAGES = 512
#: Evidence beyond this many n-grams does not sharpen the score further.
FULL_EVIDENCE = 60.0
UNDETERMINED = "und"
_CHUNK_BYTES = 1 << 20
_SPACE = 32


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def _grams(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per order: bucket of each n-gram, and the index of its text."""
    lowered = [f" {t.lower()} " for t in texts]
    points = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in lowered])
    letter = _letters()[points]
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # one space after each word
    keep[:-1] |= letter[1:]  # and one before
    points = np.where(letter, points, _SPACE)[keep].astype(np.uint64)
    owner, space = owner[keep], ~letter[keep]
    mixed = np.zeros(len(points), np.uint64)
    for order in ORDERS:
        n = len(points) - order + 1
        if n <= 0:
            return
        mixed = (mixed[:n] * np.uint64(0x9E3779B97F4A7C15)) + points[order - 1:] + np.uint64(order)
        inside = owner[:n] == owner[order - 1:]
        if order == 1:
            inside &= ~space
        else:  # at least one letter, and spaces at the ends only
            for gap in range(1, order - 1):
                inside &= ~space[gap:gap + n]
            if order == 2:
                inside &= ~(space[:n] & space[1:])
        bucket = ((mixed * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(40)) % np.uint64(BUCKETS)
        yield bucket[inside].astype(np.int64), owner[:n][inside]


def _texts(column: pa.Array) -> Iterator[tuple[int, str]]:
    """Row number and piece of text; long texts come in several pieces."""
    for row, text in enumerate(byte_values(column)):
        if text:
            for piece in slices(text):
                yield row, piece.decode("utf-8", "replace")


def _chunks(column: pa.Array) -> Iterator[tuple[list[int], list[str]]]:
    rows, texts, size = [], [], 0
    for row, text in _texts(column):
        rows.append(row)
        texts.append(text)
        size += len(text)
        if size >= _CHUNK_BYTES:
            yield rows, texts
            rows, texts, size = [], [], 0
    if texts:
        yield rows, texts


def gram_counts(training: DataFrame, text: str, lang: str) -> DataFrame:
    """(lang, bucket, n) over all training rows."""
    ship_package(training.sparkSession)

    def count(batches):
        held: dict[str, np.ndarray] = {}

        def rows():
            for name, counts in held.items():
                used = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(used), pa.string()),
                     pa.array(used, pa.int32()), pa.array(counts[used], pa.int64())],
                    names=["lang", "bucket", "n"])
            held.clear()

        for batch in batches:
            names = batch.column(1).to_pylist()
            for name in sorted(set(names)):
                own = pa.array([i for i, x in enumerate(names) if x == name], pa.int32())
                if name not in held and len(held) >= 32:  # bounded memory
                    yield from rows()
                counts = held.setdefault(name, np.zeros(BUCKETS, np.int64))
                for _, texts in _chunks(batch.column(0).take(own)):
                    for buckets, _ in _grams(texts):
                        counts += np.bincount(buckets, minlength=BUCKETS)
        yield from rows()

    per_task = (training.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
                .select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
                .mapInArrow(count, "lang string, bucket int, n long"))
    return per_task.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def fit(training: DataFrame, text: str = "text",
        lang: str = "lang") -> tuple[list[str], np.ndarray]:
    """Languages, and log-probabilities with one row per bucket."""
    # Bounded by languages x buckets, whatever the corpus; the limit is checked first.
    counts = gram_counts(training, text, lang).groupBy("lang").agg(
        F.sort_array(F.collect_list(F.struct("bucket", "n"))).alias("counts"))
    found = counts.orderBy("lang").limit(MAX_LANGUAGES + 1).collect()
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages to learn")
    matrix = np.full((BUCKETS, len(found)), SMOOTHING)
    for i, row in enumerate(found):
        pairs = np.array([tuple(x) for x in row["counts"]], np.int64)
        matrix[pairs[:, 0], i] += pairs[:, 1]
    return [r["lang"] for r in found], np.log(matrix / matrix.sum(axis=0))


def _score(column: pa.Array, names: list[str], matrix: np.ndarray) -> pa.StructArray:
    size, width = len(column), len(names)
    sums, seen = np.zeros((size, width)), np.zeros(size)
    for rows, texts in _chunks(column):
        where = np.array(rows)
        for buckets, owner in _grams(texts):
            if not len(buckets):
                continue
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            mine = where[owner[starts]]
            np.add.at(seen, mine, np.diff(np.r_[starts, len(owner)]))
            for i in range(width):
                np.add.at(sums[:, i], mine, np.add.reduceat(matrix[i][buckets], starts))
    best, score = [UNDETERMINED] * size, np.zeros(size)
    known = np.flatnonzero(seen) if width else np.array([], int)
    if len(known):
        # N-grams overlap, so the evidence is the mean of them, counted FULL_EVIDENCE times at most.
        n = seen[known][:, None]
        logit = sums[known] / n * np.minimum(n, FULL_EVIDENCE)
        top = logit.argmax(axis=1)
        odds = np.exp(logit - logit.max(axis=1, keepdims=True))
        score[known] = 1.0 / odds.sum(axis=1)
        for row, i in zip(known, top):
            best[row] = names[i]
    return pa.StructArray.from_arrays([pa.array(best, pa.string()), pa.array(score)],
                                      names=["lang_pred", "score"])


def identify(docs: DataFrame, model: tuple[list[str], np.ndarray],
             text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``."""
    ship_package(docs.sparkSession)
    names = model[0]
    by_language = docs.sparkSession.sparkContext.broadcast(
        np.ascontiguousarray(model[1].T.astype(np.float32)))
    kept = [f for f in docs.schema.fields if f.name not in ("lang_pred", "score")]
    result = T.StructType(kept + [T.StructField("lang_pred", T.StringType()),
                                  T.StructField("score", T.DoubleType())])
    at = [f.name for f in kept].index(text)

    def score(batches):
        matrix = by_language.value
        for batch in batches:
            found = _score(batch.column(at), names, matrix)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, found.field(0), found.field(1)],
                names=[*batch.schema.names, "lang_pred", "score"])

    return docs.select([F.col(f"`{f.name}`") for f in kept]).mapInArrow(score, result)
