"""Hard negatives by exact integer scores from subset-sum tables (Four Russians).

A component x counts as the whole number floor(256 * x); the score of two vectors is the inner
product of these numbers. Vectors are kept as bit planes in two's complement: plane p of a vector
is one bit per dimension, packed to a byte per eight dimensions. For an anchor, every group of
eight dimensions has a table with the sums of all 256 subsets of its components. A candidate's
byte picks the sum of a group, the sums of all groups give the plane's share, and planes are
added from the highest (which counts negative) to the lowest, doubling in between. The result is
the exact score, not an estimate, for as many anchors at a time as a table row holds.

Every anchor is scored against every row, in blocks: candidates are dealt by a hash of the id
into blocks of bounded size, each block is read once and kept packed, and the anchors pass by it.
A block gives each anchor its best rows only, so what is shuffled afterwards is a few rows per
anchor and block. First the anchors' positives are found (same label), then the rows of other
labels whose scores lie in the window that a positive's score opens.

Defined results. Rows with a null id, label or vector or with a null or non-finite component
take no part. Rows equal in id, label and numbers are one row; rows that share only their id are
rows of their own, none a positive of the other. Vectors are compared with vectors of their own
length only; empty ones score 0. Higher scores come first, ties by smaller id, then by a hash of
the row. Anchors without positives, and positives without a row in the window, give no rows.
Other columns are ignored, whatever they are called. Empty tables give empty results. Vectors so
large that a score might not fit 62 bits are an error.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from usagelens.llm.common import ship_package
from usagelens.session import stage

#: Rows of a block: fewer where that lets more tasks work, more where there are many blocks.
BLOCK_ROWS, SMALL_BLOCK_ROWS, SMALL_BLOCKS = 1 << 16, 1 << 12, 64
#: Bit planes of a block in bytes, at most.
BLOCK_BYTES = 1 << 25
#: Anchors whose tables are used together.
ANCHORS = 64
SCALE = 256


# --- packing -----------------------------------------------------------------------

def pack(numbers: np.ndarray, planes: int) -> np.ndarray:
    """(rows, dims) whole numbers as (rows, planes, groups) bytes, lowest plane first."""
    bits = (numbers[:, None, :] >> np.arange(planes)[None, :, None]) & 1
    return np.packbits(bits.astype(np.uint8), axis=2)


def unpack(codes: np.ndarray, dims: int) -> np.ndarray:
    """The (rows, dims) numbers of ``pack``."""
    bits = np.unpackbits(codes, axis=2, count=dims).astype(np.int64)
    weights = 1 << np.arange(codes.shape[1], dtype=np.int64)
    weights[-1] = -weights[-1]
    return np.tensordot(bits, weights, axes=([1], [0]))


def subset_sums(anchors: np.ndarray, kind: type) -> np.ndarray:
    """(groups, 256, anchors): the sum of the dimensions whose bits a byte has set."""
    groups = -(-anchors.shape[1] // 8)
    padded = np.zeros((groups * 8, len(anchors)), kind)
    padded[:anchors.shape[1]] = anchors.T
    parts = padded.reshape(groups, 8, len(anchors))
    table = np.zeros((groups, 1, len(anchors)), kind)
    for i in range(7, -1, -1):  # the last dimension is the lowest bit
        table = np.concatenate([table, table + parts[:, i:i + 1]], axis=1)
    return table


def scores(codes: np.ndarray, anchors: np.ndarray, kind: type = np.int64) -> np.ndarray:
    """(rows, anchors) inner products; ``codes`` are (planes, groups, rows) bytes."""
    table = subset_sums(anchors, kind)
    total = np.zeros((codes.shape[2], len(anchors)), kind)
    found = np.empty_like(total)
    for plane in range(len(codes) - 1, -1, -1):
        total += total
        for group, sums in zip(codes[plane], table):
            np.take(sums, group, axis=0, out=found, mode="clip")
            total += found
        if plane == len(codes) - 1:
            np.negative(total, out=total)
    return total


def _usable(vector: str) -> Column:
    return F.col(vector).isNotNull() & F.forall(
        vector, lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))


def _packed(rows: DataFrame, planes: int) -> DataFrame:
    """(id, label, dims, anchor, code) of (id, label, vector, anchor)."""

    def work(batches):
        for batch in batches:
            vectors = batch.column(2)
            ends = np.asarray(vectors.offsets)
            values = np.floor(np.asarray(vectors.values)[ends[0]:ends[-1]] * SCALE).astype(np.int64)
            sizes, starts = np.diff(ends), ends[:-1] - ends[0]
            for dims in np.unique(sizes):
                own = np.flatnonzero(sizes == dims)
                numbers = values[starts[own][:, None] + np.arange(dims)]
                codes = pack(numbers, planes).reshape(len(own), -1)
                offsets = np.arange(len(own) + 1, dtype=np.int32) * codes.shape[1]
                code = pa.Array.from_buffers(pa.binary(), len(own), [
                    None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(codes))])
                at = pa.array(own)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(1).take(at),
                     pa.array(np.full(len(own), dims, np.int32)), batch.column(3).take(at), code],
                    names=["id", "label", "dims", "anchor", "code"])

    return rows.mapInArrow(work, "id long, label long, dims int, anchor boolean, code binary")


# --- blocks ------------------------------------------------------------------------

def _dealt(coded: DataFrame, anchors: DataFrame, blocks: int) -> DataFrame:
    """Candidates once, anchors once per block; each block's candidates come before its
    anchors, by label and id."""
    block = F.pmod(F.xxhash64("id", "content"), F.lit(blocks)).cast("int")
    window = F.lit(None).cast("array<long>")
    candidates = coded.select(block.alias("block"), "dims", F.lit(0).alias("turn"), "label", "id",
                              "content", "code", window.alias("positives"))
    passing = anchors.select(
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "dims",
        F.lit(1).alias("turn"), "label", "id", "content", "code", "positives")
    # More partitions than blocks: a hash then seldom puts two blocks into one of few tasks.
    return (candidates.unionByName(passing).repartition(min(4 * blocks, blocks + 1000), "block")
            .sortWithinPartitions("block", "dims", "turn", "label", "id", "content"))


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, int, int], pa.RecordBatch]]:
    """Neighbouring rows of one block, length and turn."""
    keys = np.stack([np.asarray(batch.column(i)) for i in range(3)], axis=1)
    edges = np.flatnonzero(np.any(keys[1:] != keys[:-1], axis=1)) + 1
    for low, high in zip([0, *edges.tolist()], [*edges.tolist(), len(keys)]):
        yield tuple(keys[low].tolist()), batch.slice(low, high - low)


class _Block:
    """The packed candidates of one block and length, by label and id."""

    def __init__(self, parts: list[pa.RecordBatch], dims: int, planes: int):
        self.label, self.id, self.content = (
            np.concatenate([np.asarray(p.column(i)) for p in parts]) for i in (3, 4, 5))
        codes = _codes([c for p in parts for c in p.column(6).to_pylist()], planes)
        self.codes, self.dims = np.ascontiguousarray(codes.transpose(1, 2, 0)), dims


def _codes(held: list[bytes], planes: int) -> np.ndarray:
    return np.frombuffer(b"".join(held), np.uint8).reshape(len(held), planes, -1) if held[0] \
        else np.zeros((len(held), planes, 0), np.uint8)


def _best(values: np.ndarray, among: np.ndarray, n: int) -> np.ndarray:
    """The rows of ``among`` with the ``n`` highest values; of equal values the first rows."""
    if len(among) <= n:
        return among
    held = values[among]
    least = np.partition(held, len(held) - n)[len(held) - n]
    above, equal = among[held > least], among[held == least]
    return np.concatenate([above, equal[:n - len(above)]])


def _pass_by(dealt: DataFrame, planes: int, kind: type, choose, result: str) -> DataFrame:
    """Score the anchors of every block; ``choose(block, rows, anchor, column)`` yields the
    output of one anchor, ``rows`` being the part of the block that was scored."""
    names = [part.split()[0] for part in result.split(", ")]

    def work(batches):
        parts, block, held = [], None, None
        for batch in batches:
            for (number, dims, turn), run in _runs(batch):
                if not turn:
                    if held != (number, dims):
                        parts, block, held = [], None, (number, dims)
                    parts.append(run)
                    continue
                if held != (number, dims):  # no candidate of this length here
                    continue
                if block is None:
                    block, parts = _Block(parts, dims, planes), []
                found = []
                labels = np.asarray(run.column(3))
                for low, high, rows in choose.groups(block, labels):
                    if rows.start == rows.stop:
                        continue
                    own = unpack(_codes(run.column(6).slice(low, high - low).to_pylist(), planes), dims)
                    values = scores(block.codes[:, :, rows], own, kind)
                    for i in range(low, high):
                        found += choose.rows(block, rows, run, i, np.ascontiguousarray(values[:, i - low]))
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(column, pa.int64()) for column in zip(*found)], names=names)

    return dealt.mapInArrow(work, result)


class _Positives:
    """An anchor's best rows of its own label in a block."""

    result = "anchor_id long, anchor_content long, id long, content long, score long"

    def __init__(self, n: int):
        self.n = n

    def groups(self, block: _Block, labels: np.ndarray):
        edges = [0, *(np.flatnonzero(labels[1:] != labels[:-1]) + 1).tolist(), len(labels)]
        for start, stop in zip(edges, edges[1:]):
            rows = slice(int(np.searchsorted(block.label, labels[start], "left")),
                         int(np.searchsorted(block.label, labels[start], "right")))
            for low in range(start, stop, ANCHORS):
                yield low, min(low + ANCHORS, stop), rows

    def rows(self, block, rows, run, i, values):
        own, content = run.column(4)[i].as_py(), run.column(5)[i].as_py()
        ids, contents = block.id[rows], block.content[rows]
        for at in _best(values, np.flatnonzero(ids != own), self.n).tolist():
            yield own, content, int(ids[at]), int(contents[at]), int(values[at])


class _Negatives:
    """For each positive of an anchor, the best rows of other labels inside its window."""

    result = "anchor_id long, anchor_content long, nth long, id long, content long, score long"

    def __init__(self, n: int, low: int, high: int):
        self.n, self.low, self.high = n, low, high

    def groups(self, block: _Block, labels: np.ndarray):
        for low in range(0, len(labels), ANCHORS):
            yield low, min(low + ANCHORS, len(labels)), slice(0, len(block.id))

    def rows(self, block, rows, run, i, values):
        own, content = run.column(4)[i].as_py(), run.column(5)[i].as_py()
        other = block.label != run.column(3)[i].as_py()
        for nth, positive in enumerate(run.column(7)[i].as_py(), 1):
            # Whole numbers between low and high percent of the positive's score.
            least, most = -(-self.low * positive // 100), self.high * positive // 100
            among = np.flatnonzero(other & (values >= least) & (values <= most))
            for at in self._first(block, values, among).tolist():
                yield own, content, nth, int(block.id[at]), int(block.content[at]), int(values[at])

    def _first(self, block, values, among):
        if len(among) <= self.n:
            return among
        # Rows lie by label first, so rows with the last value that fits are put by id here.
        least = np.partition(values[among], len(among) - self.n)[len(among) - self.n]
        above, equal = among[values[among] > least], among[values[among] == least]
        order = np.lexsort((block.content[equal], block.id[equal]))
        return np.concatenate([above, equal[order[:self.n - len(above)]]])


# --- mining ------------------------------------------------------------------------

def mine(vectors: DataFrame, anchor: Column, key: str = "vec_id", label: str = "label",
         vector: str = "embedding", n_positives: int = 5, n_negatives: int = 10,
         low_percent: int = 30, high_percent: int = 90) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows
    where ``anchor`` holds: their best ``n_positives`` rows of the same label, and for each of
    these the best ``n_negatives`` of other labels that score ``low_percent`` to
    ``high_percent`` of it."""
    ship_package(vectors.sparkSession)
    rows = vectors.select(
        F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"),
        F.col(vector).cast("array<double>").alias("vector"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & _usable("vector"))
    largest = F.array_max(F.transform("vector", lambda x: F.abs(x)))
    sizes = rows.agg(F.count("*"), F.coalesce(F.max(F.size("vector")), F.lit(0)),
                     F.coalesce(F.max(largest), F.lit(0.0))).head()
    count, dims, bound = sizes[0], sizes[1], ceil(sizes[2] * SCALE) + 1
    planes = bound.bit_length() + 1
    if dims << (2 * planes - 2) >= 1 << 62:
        raise ValueError("components are too large for exact scores of 62 bits")
    kind = np.int32 if dims << (2 * planes) < 1 << 31 else np.int64

    per_block = max(1, min(BLOCK_ROWS, BLOCK_BYTES // max(1, planes * -(-dims // 8))))
    blocks = max(1, ceil(count / per_block), min(SMALL_BLOCKS, ceil(count / SMALL_BLOCK_ROWS)))
    coded = stage(_packed(rows, planes).dropDuplicates().withColumn(
        "content", F.xxhash64("label", "code")), "bit-planes")
    asked = coded.where("anchor")

    plain = asked.withColumn("positives", F.lit(None).cast("array<long>"))
    first = _Positives(n_positives)
    near = _pass_by(_dealt(coded, plain, blocks), planes, kind, first, first.result)
    order = [F.desc("score"), "id", "content"]
    by_anchor = W.partitionBy("anchor_id", "anchor_content").orderBy(*order)
    positives = stage(near.withColumn("nth", F.row_number().over(by_anchor))
                      .where(F.col("nth") <= n_positives), "positives")

    # At most n_positives scores in a list.
    listed = positives.groupBy("anchor_id", "anchor_content").agg(F.transform(
        F.sort_array(F.collect_list(F.struct("nth", "score"))), lambda x: x["score"]).alias("positives"))
    ready = asked.join(listed, (F.col("id") == F.col("anchor_id"))
                       & (F.col("content") == F.col("anchor_content"))).drop("anchor_id", "anchor_content")
    second = _Negatives(n_negatives, low_percent, high_percent)
    far = _pass_by(_dealt(coded, ready, blocks), planes, kind, second, second.result)
    by_pair = W.partitionBy("anchor_id", "anchor_content", "nth").orderBy(*order)
    ranked = far.withColumn("rank", F.row_number().over(by_pair)).where(F.col("rank") <= n_negatives)
    named = positives.select("anchor_id", "anchor_content", F.col("nth").cast("long").alias("nth"),
                             F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return ranked.join(named, ["anchor_id", "anchor_content", "nth"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))
