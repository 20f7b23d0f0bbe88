"""Near-duplicates by one-permutation hashing with optimal densification.

A document's set is its distinct shingles of five words (fewer words: all of them as one).
One hash per shingle: the top bits choose one of ``BINS`` bins, which keeps its smallest
hash. An empty bin takes the value of the first non-empty bin in an order of its own, the
same for all documents, so two sets still agree in a bin with probability equal to their
similarity. Four bins make a band, a band's values a bucket; with 32 bands a pair at the
threshold of 0.75 meets in no bucket with probability 5e-6, a closer one much less. In small
sets bins depend on each other and that is not true any more: sets of up to ``SMALL_SET``
shingles also have a bucket for each of their smallest shingle hashes, as many as it takes for
two similar sets to have one of them in common, so such a pair always meets.

Equal sets are collapsed to one node first. In each bucket one member is the centre, the one
whose buckets hold most documents, and only the edges of that star become candidate pairs,
so their number never exceeds the number of bucket members. Candidates are confirmed on the
full sets. A star can miss a link between two of its points, so every bucket that still
holds several components is then searched for them, in blocks of a bounded number of
members: pairs of different components are compared on their full sets, and only links that
join components are put out. Larger sets are compared only if their sketches share ``SHARED_BINS``
of 128 bins, which a similar pair misses with probability 1e-8; if one of the two has less than
``SKETCHED`` shingles they are compared in any case. No link is reported unconfirmed, nothing is
capped.

Defined results: null, empty and blank texts have empty sets, are linked with nothing and
kept. A null id is linked with nothing and kept. Rows that share an id are one node, linked
if any of their texts is. Other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagelens.llm.common import byte_values, ship_package
from usagelens.llm.components import smallest_reachable
from usagelens.session import stage

WORDS = 5
BIN_BITS = 7
BINS = 1 << BIN_BITS
ROWS = 4  # bins in a band
#: Link if 100 * intersection >= PERCENT * union.
PERCENT = 75
#: Sets of up to so many shingles meet through their smallest shingles as well.
SMALL_SET = 16
#: Bins two sketches of larger sets must share to be compared. At the threshold 96 are expected,
#: with a standard deviation of 4.9, so a similar pair falls below with probability 1e-8.
SHARED_BINS = 68
SKETCHED = BINS
#: Members of a bucket, and their shingles, in a block; larger buckets are cut into several.
BLOCK = 256
BLOCK_SHINGLES = 1 << 21
_KNOWN_WORDS = 1 << 19

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class _WordHashes(dict):
    """Hash by word, remembered while there is room."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _KNOWN_WORDS:
            self.clear()
        self[word] = found = xxhash.xxh3_64_intdigest(word)
        return found


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _probe_order() -> np.ndarray:
    """For each bin, the rank of every other bin in its own order of looking for a value."""
    pairs = np.arange(BINS * BINS, dtype=np.uint64)
    return _mix(pairs * _MULTIPLIER + np.uint64(1)).reshape(BINS, BINS)


_ORDER = _probe_order()
_EDGES = np.arange(BINS, dtype=np.uint64) << np.uint64(64 - BIN_BITS)


def shingles(text: bytes | None, known: dict) -> np.ndarray:
    """The sorted distinct shingle hashes of a whole text."""
    words = (text or b"").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    ids = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    width = min(WORDS, len(words))
    n = len(words) - width + 1
    joined = np.full(n, width, np.uint64)
    for i in range(width):
        joined = joined * _MULTIPLIER + ids[i:n + i]
    return np.unique(_mix(joined))


def signature(hashes: np.ndarray) -> np.ndarray:
    """The value of every bin, empty ones filled."""
    first = np.searchsorted(hashes, _EDGES)
    last = np.r_[first[1:], len(hashes)]
    full = np.flatnonzero(first < last)
    values = np.zeros(BINS, np.uint64)
    values[full] = hashes[first[full]]
    if len(full) < BINS:
        empty = np.flatnonzero(first >= last)
        values[empty] = values[full[_ORDER[np.ix_(empty, full)].argmin(axis=1)]]
    return values


def band_buckets(signatures: np.ndarray) -> np.ndarray:
    """Per document (row) the bucket of every band, as signed 64-bit numbers."""
    by_band = signatures.reshape(len(signatures), BINS // ROWS, ROWS)
    joined = np.broadcast_to(np.arange(BINS // ROWS, dtype=np.uint64), by_band.shape[:2]).copy()
    for i in range(ROWS):
        joined = _mix(joined * _MULTIPLIER + by_band[:, :, i])
    return joined.view(np.int64)


def small_buckets(hashes: np.ndarray) -> list[int]:
    """Buckets of a small set: its smallest hashes, so many that a set as similar as
    ``PERCENT`` cannot be without all of them."""
    if len(hashes) > SMALL_SET:
        return []
    shared = -(-PERCENT * len(hashes) // 100)  # at least so many are in a similar set
    return _mix(hashes[:len(hashes) - shared + 1] + _MULTIPLIER).view(np.int64).tolist()


def sketches(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(node, n, content, sketch, buckets) of every row; ``content`` names the set."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        known = _WordHashes()
        for batch in batches:
            sizes, contents, signatures, used = [], [], [], []
            for row, body in enumerate(byte_values(batch.column(1))):
                hashes = shingles(body, known)
                sizes.append(len(hashes))
                contents.append(xxhash.xxh3_128_hexdigest(hashes.tobytes()))
                if len(hashes):
                    signatures.append(signature(hashes))
                    used.append((row, small_buckets(hashes)))
            buckets: list = [[]] * len(sizes)
            small: list = [b""] * len(sizes)
            if used:
                values = np.array(signatures)
                for (row, more), own, low in zip(used, band_buckets(values).tolist(), values.astype(np.uint8)):
                    buckets[row], small[row] = own + more, low.tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(contents, pa.string()),
                 pa.array(small, pa.binary()), pa.array(buckets, pa.list_(pa.int64()))],
                names=["node", "n", "content", "sketch", "buckets"])

    return docs.select(F.col(key).alias("node"), F.col(text).alias("text")).mapInArrow(
        run, f"node {docs.schema[key].dataType.simpleString()}, n long, content string, "
             "sketch binary, buckets array<long>")


def full_sets(docs: DataFrame, wanted: DataFrame, key: str, text: str) -> DataFrame:
    """(node, shingles) of the rows whose id is in ``wanted`` (node)."""

    def run(batches):
        known = _WordHashes()
        for batch in batches:
            found = [shingles(x, known).view(np.int64) for x in byte_values(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.list_(pa.int64()))], names=["node", "shingles"])

    own = docs.select(F.col(key).alias("node"), F.col(text).alias("text"))
    return own.join(wanted, "node", "left_semi").mapInArrow(
        run, f"node {docs.schema[key].dataType.simpleString()}, shingles array<long>")


def _similar(inter: Column, a: Column, b: Column) -> Column:
    return 100 * inter >= PERCENT * (a + b - inter)


def _sizes_allow(a: Column, b: Column) -> Column:
    return 100 * F.least(a, b) >= PERCENT * F.greatest(a, b)


def confirm(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are similar."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    inter = F.size(F.array_intersect("x", "y"))
    return pairs.join(left, "a").join(right, "b").where(
        _similar(inter, F.size("x"), F.size("y"))).select("a", "b").distinct()


def star_pairs(members: DataFrame) -> DataFrame:
    """Candidate pairs (a, b): in each bucket the centre with every other member."""
    popular = members.groupBy("node").agg(F.sum("size").alias("popular"))
    centres = stage(members.join(popular, "node").groupBy("bucket").agg(
        F.max(F.struct("popular", "node", "n")).alias("c")).select(
        "bucket", F.col("c.node").alias("centre"), F.col("c.n").alias("centre_n")), "centres")
    return members.join(centres, "bucket").where(
        (F.col("node") != F.col("centre")) & _sizes_allow(F.col("n"), F.col("centre_n"))).select(
        F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b")).distinct()


def _joining_links(group: pd.DataFrame) -> pd.DataFrame:
    """Links that join components, among the members of one bucket in one or two blocks."""
    group = group.drop_duplicates("node").sort_values("node")
    nodes, part = group["node"].tolist(), group["part"].to_numpy()
    across = len(set(part)) > 1  # two blocks: only pairs between them are this group's
    sets = [np.asarray(x) for x in group["shingles"]]
    sizes = np.array([len(x) for x in sets])
    sketch = np.frombuffer(b"".join(group["sketch"]), np.uint8).reshape(len(nodes), BINS)
    label = pd.factorize(group["component"])[0]
    links = []
    for i in range(len(nodes) - 1):
        rest = np.arange(i + 1, len(nodes))
        small, large = np.minimum(sizes[rest], sizes[i]), np.maximum(sizes[rest], sizes[i])
        rest = rest[(label[rest] != label[i]) & (100 * small >= PERCENT * large)]
        if across:
            rest = rest[part[rest] != part[i]]
        if len(rest):
            rest = rest[(np.minimum(sizes[rest], sizes[i]) < SKETCHED)
                        | ((sketch[rest] == sketch[i]).sum(axis=1) >= SHARED_BINS)]
        for j in rest:
            if label[i] == label[j]:  # joined meanwhile
                continue
            inter = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if 100 * inter >= PERCENT * (sizes[i] + sizes[j] - inter):
                links.append((nodes[i], nodes[j]))
                label[label == label[j]] = label[i]
    return pd.DataFrame(links, columns=["a", "b"])


def remaining_links(members: DataFrame, components: DataFrame, nodes: DataFrame,
                    sets: DataFrame) -> DataFrame:
    """Links (a, b) between components that meet in a bucket."""
    labelled = stage(members.where("size > 2").join(components, "node", "left").withColumn(
        "component", F.coalesce("component", "node")).select("bucket", "node", "n", "component"), "labelled")
    parts = F.greatest(F.ceil(F.col("size") / BLOCK), F.ceil(F.col("held") / BLOCK_SHINGLES))
    mixed = stage(labelled.groupBy("bucket").agg(
        F.min("component").alias("low"), F.max("component").alias("high"),
        F.count("*").alias("size"), F.sum("n").alias("held")).where("low != high").select(
        "bucket", parts.cast("int").alias("parts")), "mixed")
    full = nodes.select("node", "sketch").join(sets, "node")
    rows = labelled.drop("n").join(mixed, "bucket").join(full, "node").withColumn(
        "part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    # A member of block p takes part in the block pairs (p, q) and (q, p), smaller block first.
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "bucket", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"),
        "part", "node", "component", "sketch", "shingles")
    kind = members.schema["node"].dataType.simpleString()
    return rows.groupBy("bucket", "low", "high").applyInPandas(
        _joining_links, f"a {kind}, b {kind}").distinct()


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_shingles, component_id, kept) of every row of ``docs``."""
    ship_package(docs.sparkSession)
    found = stage(sketches(docs, key, text), "sketches")
    nodes = stage(found.where((F.col("n") > 0) & F.col("node").isNotNull()).groupBy("content").agg(
        F.min(F.struct("node", "n", "sketch", "buckets")).alias("r")).select("content", "r.*"), "nodes")

    in_bucket = nodes.select("node", "n", F.explode("buckets").alias("bucket"))
    shared = stage(in_bucket.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1"),
                   "buckets")
    members = stage(in_bucket.join(shared, "bucket"), "members")
    sets = stage(full_sets(docs, members.select("node").distinct(), key, text), "sets")

    links = confirm(stage(star_pairs(members), "stars"), sets)
    # One id with several texts joins their classes, each to the smallest.
    classed = found.where((F.col("n") > 0) & F.col("node").isNotNull()).select("node", "content").join(
        nodes.select("content", F.col("node").alias("b")), "content").select("node", "b")
    repeated = classed.groupBy("node").agg(F.min("b").alias("a"), F.max("b").alias("last")).where(
        "a != last").select("node", "a")
    several = classed.join(repeated, "node").where("a != b").select("a", "b").distinct()
    links = stage(links.unionByName(several), "confirmed")
    components = smallest_reachable(links)
    more = stage(remaining_links(members, components, nodes, sets), "more-links")
    if not more.isEmpty():
        components = smallest_reachable(links.unionByName(more))

    classes = nodes.select("content", F.col("node").alias("first")).join(
        components.select(F.col("node").alias("first"), "component"), "first", "left").select(
        "content", F.coalesce("component", "first").alias("component"))
    return found.select("node", "n", "content").join(stage(classes, "classes"), "content", "left").select(
        F.col("node").alias(key), F.col("n").alias("n_shingles"),
        F.when(F.col("node").isNotNull(), F.coalesce("component", "node")).alias("component_id"),
    ).withColumn("kept", F.col(key).eqNullSafe(F.col("component_id")))
