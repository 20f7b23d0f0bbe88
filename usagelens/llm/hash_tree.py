"""Sharding by a hierarchical weighted hash tree: region, rack, shard.

At each level a key draws a number for every child of the node it has reached, from a hash
of key and child; the draw is ``-ln(u) / weight`` and the smallest wins, so a child gets its
weight's share of the keys. A draw depends on that child alone. If the weight of one subtree
changes, keys move only into it (weight up) or out of it (weight down), and the draws inside
all other subtrees stay as they were.

A tree of n shards: the first 8 are two regions of two racks of two shards, each later shard
is a region of its own, so one more shard takes rows only into itself (fewer than 8 shards
are regions of their own as well). Any other tree can be given as rows.

Law of the query: ``key``. Key and shard count alone decide; equal texts under different
keys may part. Defined results: a null key is one key like any other; rows with equal keys
share a shard; null text has size 1 and the checksum of an empty text. Columns named like a
result are replaced.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from usagelens.session import stage

BASE_SHARDS = 8
SHARDS = 8
_POSITION_BITS = 33


class Leaf(NamedTuple):
    region: str
    rack: str
    shard: int
    weight: float = 1.0


def tree(shards: int) -> list[Leaf]:
    """The tree of a shard count."""
    if shards < 1:
        raise ValueError("at least one shard")
    base = BASE_SHARDS if shards >= BASE_SHARDS else 0
    return [Leaf(f"g{s // 4}", f"k{s // 2}", s) if s < base else Leaf(f"g+{s}", f"k+{s}", s)
            for s in range(shards)]


def _uniform(key: Column, child: Column) -> Column:
    """A number strictly between 0 and 1 from 52 bits of a hash of key and child."""
    bits = F.conv(F.substring(F.md5(F.concat_ws("/", child, key)), 1, 13), 16, 10)
    return (bits.cast("double") + 0.5) / float(1 << 52)


def _descend(key: Column, children: dict[str, dict[str, float]], node: Column) -> Column:
    """The child that wins the draw below ``node``."""
    if all(len(c) == 1 for c in children.values()) and len(children) == 1:
        return F.lit(next(iter(next(iter(children.values())))))
    below = F.create_map(*[x for name, kids in children.items() for x in (
        F.lit(name), F.array(*[F.struct(F.lit(w).cast("double").alias("w"), F.lit(c).alias("c"))
                               for c, w in kids.items()]))])
    draws = F.transform(below[node], lambda kid: F.struct(
        (-F.log(_uniform(key, kid["c"])) / kid["w"]).alias("draw"), kid["c"].alias("c")))
    return F.array_min(draws)["c"]


def place(key: Column, leaves: list[Leaf]) -> Column:
    """The shard of a key, by descending the tree. Weights of zero take nothing."""
    regions: dict[str, dict[str, float]] = {"": {}}
    racks: dict[str, dict[str, float]] = {}
    shards: dict[str, dict[str, float]] = {}
    for leaf in leaves:
        if leaf.weight <= 0:
            continue
        rack, shard = f"{leaf.region}.{leaf.rack}", f"{leaf.region}.{leaf.rack}.{leaf.shard}"
        for level, parent, child in ((regions, "", leaf.region), (racks, leaf.region, rack),
                                     (shards, rack, shard)):
            kids = level.setdefault(parent, {})
            kids[child] = kids.get(child, 0.0) + leaf.weight
    if not shards:
        raise ValueError("no shard has a weight")
    text = F.coalesce(key.cast("string"), F.lit("\x00"))
    region = _descend(text, regions, F.lit(""))
    rack = _descend(text, racks, region)
    return F.substring_index(_descend(text, shards, rack), ".", -1).cast("int")


def assign(docs: DataFrame, leaves: list[Leaf], grown: list[Leaf],
           key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: size, text_crc32, law, shard and the shard in the grown tree."""
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.col(key), (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"), F.lit("key").alias("law"),
        place(F.col(key), leaves).alias("shard"), place(F.col(key), grown).alias("grown_shard"))


def number_slots(placed: DataFrame, key: str = "doc_id") -> DataFrame:
    """Add ``slot``, 0, 1, 2, ... within each shard in the order of the key.

    Rows are range-partitioned by shard, key and content, so a shard spreads over many tasks,
    and written; a slot is the row's position in its partition plus what earlier partitions
    hold of the shard, a table of at most partitions + shards rows.
    """
    order = ["shard", key, "text_crc32", "size"]
    keys = [F.col(c).asc_nulls_first() for c in order]
    placed = stage(placed.repartitionByRange(*keys).sortWithinPartitions(*keys)
                   .withColumn("_at", F.monotonically_increasing_id()), "slots")
    part = F.shiftright("_at", _POSITION_BITS)
    runs = placed.groupBy(part.alias("_part"), "shard").agg(
        F.min("_at").alias("_first"), F.count("*").alias("_n"))
    earlier = W.partitionBy("shard").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    runs = runs.select("_part", "shard", "_first",
                       F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    return (placed.withColumn("_part", part).join(F.broadcast(runs), ["_part", "shard"])
            .withColumn("slot", F.col("_at") - F.col("_first") + F.col("_before"))
            .select(key, "size", "text_crc32", "law", "shard", "slot", "grown_shard"))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, key: str = "doc_id") -> None:
    """The rows themselves, in one folder per shard; a large shard is many files."""
    docs.withColumn("shard", place(F.col(key), tree(shards))).write.partitionBy("shard").parquet(path)


def shard_documents(docs: DataFrame, shards: int = SHARDS, key: str = "doc_id",
                    text: str = "text") -> DataFrame:
    return number_slots(assign(docs, tree(shards), tree(shards + 1), key, text), key)
