"""From raw documents to sharded training text: five stages, each one of the corpus operators.

Every stage is written as Parquet to the shared folder and read again as the next one's
documents. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from usagelens.llm import hash_tree, naive_bayes, one_permutation, raking, winnowing
from usagelens.llm.common import fold, ship_package, table
from usagelens.session import stage

#: Texts whose language is less sure than this are rejected, as are those without a letter.
LEAST_SCORE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language."""
    ship_package(spark)
    model = naive_bayes.fit(docs.where(fold("doc_id", 5) != 0))
    known = (F.col("lang_pred") != naive_bayes.UNDETERMINED) & (F.col("score") >= LEAST_SCORE)
    return naive_bayes.identify(docs, model).where(known).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id.

    Rows that share an id are one document of the group, so one of them stays: of those with
    words the one whose text hashes lowest. Rows without an id are in no group and all stay.
    """
    ship_package(spark)
    kept = one_permutation.near_duplicates(docs).where("kept").select("doc_id").distinct()
    # Found by ids alone, and usually empty, so texts are placed by id only once.
    again = stage(docs.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.count("*").alias("n")).where("n > 1").select(F.col("doc_id").alias("again")), "repeated-ids")
    alone = kept.join(again, F.col("doc_id") == F.col("again"), "left_anti")
    single = docs.join(alone, docs["doc_id"].eqNullSafe(alone["doc_id"]), "left_semi")
    wordless = ~F.coalesce(F.col("text"), F.lit("")).rlike("[^\\x09-\\x0D\\x20]")
    several = docs.join(again, F.col("doc_id") == F.col("again"), "left_semi").join(kept, "doc_id", "left_semi").select(
        "doc_id", F.struct(wordless.alias("wordless"), F.xxhash64("text").alias("hash"),
                           F.struct(*docs.columns).alias("row")).alias("r"))
    return single.unionByName(several.groupBy("doc_id").agg(F.min("r").alias("r")).select("r.row.*"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    judged = winnowing.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    bad = judged.where("contaminated").select(F.col("doc_id").alias("bad"), "content").distinct()
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["bad"])
                     & (F.xxhash64(docs["text"]) == bad["content"]), "left_anti")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose sources, languages and topics have their target weights."""
    topics = docs.withColumn("topic", raking.content_kind(F.col("text")))
    return raking.mix(topics).where("kept").select(*docs.columns)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every document that is left."""
    return hash_tree.shard_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", language),
    ("MinHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mixing),
    ("sharding", sharding),
]

#: Hashes decide in several stages, which SQL cannot express; tests use a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
