import zlib

import numpy as np

import corpus_pipeline
from tests.llm import brute
from usagelens.llm import hash_tree, naive_bayes
from usagelens.llm.common import fold

SF_DIR = "/root/testdata/sf0.001"


def test_against_brute_force(spark):
    table = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    docs = [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in table.collect()]
    names, matrix = naive_bayes.fit(table.where(fold("doc_id", 5) != 0))

    def known(text):
        grams = [b for buckets, _ in naive_bayes._grams([text or ""]) for b in buckets]
        if not grams:
            return False
        logit = matrix[grams].mean(axis=0) * min(len(grams), naive_bayes.FULL_EVIDENCE)
        return 1 / np.exp(logit - logit.max()).sum() >= corpus_pipeline.LEAST_SCORE

    docs = [d for d in docs if known(d[1])]
    near = brute.near_duplicates([d[:2] for d in docs])
    docs = [d for d in docs if near[d[0]][2]]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    bad = {r[0] for r in brute.contamination([d[:2] for d in docs], items) if r[5]}
    docs = [d for d in docs if d[0] not in bad]
    kept = brute.mixed(docs)
    docs = [d for d in docs if kept[d[0]][1]]
    want = {k: (len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), brute.place(k, hash_tree.tree(8)),
                brute.place(k, hash_tree.tree(9))) for k, t, _, _ in docs}
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    assert {r["doc_id"]: (r["size"], r["text_crc32"], r["shard"], r["grown_shard"]) for r in rows} == want
    assert len(rows) == len(want) and 0 < len(want) < table.count()
    for shard in range(8):
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(sum(
            v[2] == shard for v in want.values())))


def test_every_stage_keeps_the_columns_and_takes_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "some words here", "en", None, 3),
         (4, "some words here", "en", "s", 3), (4, "some words here", "en", "s", 3), (5, "123", "fr", "s", 3)],
        spark.read.parquet(f"{SF_DIR}/documents.parquet").schema)
    for rows in (docs, docs.limit(0)):
        for i, (name, function) in enumerate(corpus_pipeline.STAGES):
            out = function(spark, rows, SF_DIR)
            assert i == 4 or out.columns == docs.columns, name
            assert len(out.collect()) <= 6


def test_stages(spark):
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None


def test_one_row_of_each_group_stays_when_ids_repeat(spark):
    schema = spark.read.parquet(f"{SF_DIR}/documents.parquet").schema
    same, other = "one two three four five six", "seven eight nine ten eleven twelve"
    rows = [(1, same, "en", "s", 1)] * 4 + [(2, same, "en", "s", 1), (3, other, "en", "s", 1), (3, None, "en", "s", 1),
            (4, other + " more", "fr", "t", 2), (5, None, None, None, None), (None, same, "en", "s", 1),
            (None, same, "en", "s", 1), (6, "a b c d e f", "en", "s", 1), (6, "g h i j k l", "en", "s", 1)]
    out = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, schema).repartition(3), SF_DIR).collect()
    near = brute.near_duplicates([(k, t) for k, t, *_ in rows if k is not None and t is not None and k != 6] + [(5, None)])
    want = sorted(k for k, found in near.items() if found[2])
    assert sorted(r["doc_id"] for r in out if r["doc_id"] is not None) == sorted([*want, 6])
    assert sum(r["doc_id"] is None for r in out) == 2
    assert {r["doc_id"]: r["text"] for r in out}[3] == other and all(r.asDict().keys() == set(schema.names) for r in out)
