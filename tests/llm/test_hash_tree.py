import zlib
from collections import Counter

import pytest

from tests.llm import brute
from usagelens.llm import hash_tree

TEXTS = "doc_id long, text string"


def _rows(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_shards_agree_with_a_plain_descent_and_grow_only_into_the_new_one(spark):
    docs = spark.createDataFrame([(i, f"t{i}") for i in range(3000)], TEXTS).repartition(5)
    rows = _rows(hash_tree.shard_documents(docs))
    for i in range(0, 3000, 7):
        assert rows[i]["shard"] == brute.place(i, hash_tree.tree(8))
        assert rows[i]["grown_shard"] == brute.place(i, hash_tree.tree(9))
    assert all(r["grown_shard"] in (r["shard"], 8) for r in rows.values())
    counts = Counter(r["grown_shard"] for r in rows.values())
    assert min(counts[s] for s in range(9)) > 240 and max(counts.values()) < 430


def test_slots_have_no_gaps_and_follow_the_key(spark):
    docs = spark.createDataFrame([(i, "x" * (i % 5)) for i in range(500)], TEXTS).repartition(7)
    rows = hash_tree.shard_documents(docs).collect()
    for shard in range(8):
        own = sorted((r["slot"], r["doc_id"]) for r in rows if r["shard"] == shard)
        assert [s for s, _ in own] == list(range(len(own)))
        assert [d for _, d in own] == sorted(d for _, d in own)


def test_nulls_ties_long_texts_and_other_columns(spark):
    long = "é" * 200_000
    docs = spark.createDataFrame(
        [(None, None, "a", 1), (1, "", "b", 2), (1, "", "b", 2), (2, long, None, None)],
        "doc_id long, text string, shard string, slot int")
    rows = hash_tree.shard_documents(docs).collect()
    assert len(rows) == 4 and {r["law"] for r in rows} == {"key"}
    sizes = Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows)
    assert sizes == Counter({(None, 1, 0): 1, (1, 1, 0): 2, (2, 400_001, zlib.crc32(long.encode())): 1})
    assert len({(r["shard"], r["slot"]) for r in rows}) == 4


def test_empty_table(spark):
    assert hash_tree.shard_documents(spark.createDataFrame([], TEXTS)).collect() == []


@pytest.mark.parametrize("change", [3.0, 0.0])
def test_only_the_changed_subtree_gains_or_loses(spark, change):
    leaves = hash_tree.tree(8)
    other = [leaf._replace(weight=change) if leaf.shard == 2 else leaf for leaf in leaves]
    docs = spark.createDataFrame([(i, "") for i in range(2000)], TEXTS)
    rows = hash_tree.assign(docs, leaves, other).collect()
    moved = [(r["shard"], r["grown_shard"]) for r in rows if r["shard"] != r["grown_shard"]]
    region = {0, 1, 2, 3}
    assert moved and all((b if change else a) in region for a, b in moved)
    assert not [1 for a, b in moved if a not in region and b not in region]


def test_weights_and_bad_trees(spark):
    leaves = [hash_tree.Leaf("a", "r", 0, 3.0), hash_tree.Leaf("b", "r", 1, 1.0)]
    docs = spark.createDataFrame([(i, "") for i in range(4000)], TEXTS)
    share = sum(r["shard"] == 0 for r in hash_tree.assign(docs, leaves, leaves).collect()) / 4000
    assert 0.7 < share < 0.8
    with pytest.raises(ValueError):
        hash_tree.tree(0)
    with pytest.raises(ValueError):
        hash_tree.place(docs["doc_id"], [hash_tree.Leaf("a", "r", 0, 0.0)])


def test_written_shards_hold_the_rows(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"t{i}") for i in range(100)], TEXTS)
    hash_tree.write_shards(docs, str(tmp_path / "shards"))
    back = _rows(spark.read.parquet(str(tmp_path / "shards")))
    assert len(back) == 100 and all(r["shard"] == brute.place(i, hash_tree.tree(8)) for i, r in back.items())
