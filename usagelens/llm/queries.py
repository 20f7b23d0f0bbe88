"""The corpus operators over the whole given tables, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from usagelens.llm import (
    context_mixing, discriminant, fill_middle, hard_negatives, hash_tree, line_dedup, metric_join,
    naive_bayes, one_permutation, raking, token_scan, warc_members, winnowing,
)
from usagelens.llm.common import fold, table
from usagelens.session import stage


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, found by scanning token files written from the texts."""
    docs = table(spark, sf_dir, "documents")
    return token_scan.count_tokens(docs).select("doc_id", "n_tokens")


def op2_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_mixing.score(table(spark, sf_dir, "documents"), fold("doc_id", 7) == 2)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.decontaminate(table(spark, sf_dir, "documents"),
                                   table(spark, sf_dir, "benchmark")).drop("content")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold("doc_id", 5) == 0
    stats = stage(discriminant.add_statistics(docs), "text-statistics")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    model = discriminant.fit(stats.where(~held_out).join(labels, "doc_id"))
    return discriminant.score(stats, model).select(
        "doc_id", held_out.alias("held_out"), "score", "predicted")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_members.archive_round_trip(table(spark, sf_dir, "pages"))


def op6_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metric_join.near_vectors(table(spark, sf_dir, "embeddings"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its probability, and whether it is in the sample."""
    docs = table(spark, sf_dir, "documents").withColumn("topic", raking.content_kind(F.col("text")))
    return raking.mix(docs).select(
        "doc_id", *[F.coalesce(m, F.lit("")).alias(m) for m in raking.MARGINS], "n_tokens", "prob", "kept")


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = fold("doc_id", 5) == 0
    model = naive_bayes.fit(docs.where(~held_out))
    return naive_bayes.identify(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return one_permutation.near_duplicates(table(spark, sf_dir, "documents"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hash_tree.shard_documents(table(spark, sf_dir, "documents"))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.drop_repeated_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors.withColumn("label", moved), F.col("vec_id") % 100 == 0)


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    restored = fill_middle.restore(F.col("text"), F.col("form"))
    return fill_middle.fill_in_middle(docs).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("text", 256).alias("output_sha256"), F.sha2(restored, 256).alias("restored_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_context_mixing": op2_context_mixing,
    "op3_decontamination": op3_decontamination,
    "op4_quality": op4_quality,
    "op5_warc": op5_warc,
    "op6_near_vectors": op6_near_vectors,
    "op7_mixing": op7_mixing,
    "op8_language": op8_language,
    "op9_near_duplicates": op9_near_duplicates,
    "op10_sharding": op10_sharding,
    "op11_line_dedup": op11_line_dedup,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_fill_middle": op13_fill_middle,
}

# All windows of all items against all windows of all documents.
_DECONTAMINATION = r"""
WITH split AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words FROM documents),
items AS (
  SELECT CAST(item_id AS VARCHAR) AS item, list_filter(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'),
    lambda w: w <> '') AS words FROM benchmark),
sized AS (SELECT item, words, least(13, len(words)) AS width FROM items WHERE len(words) > 0),
windows AS (SELECT DISTINCT item, width, array_to_string(words[i:i + width - 1], ' ') AS span
  FROM (SELECT *, unnest(range(1, len(words) - width + 2)) AS i FROM sized)),
widths AS (SELECT DISTINCT width FROM sized),
spans AS (SELECT doc_id, width, i, array_to_string(words[i:i + width - 1], ' ') AS span
  FROM (SELECT doc_id, width, words, unnest(range(1, len(words) - width + 2)) AS i
        FROM split, widths WHERE len(words) >= width)),
found AS (SELECT doc_id, item, i, width FROM spans JOIN windows USING (width, span)),
hit AS (SELECT doc_id, count(*) AS n_hit FROM (
  SELECT DISTINCT doc_id, unnest(range(i, i + width)) AS at FROM found) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM split LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)"""

_WARC = """
WITH sized AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS digest FROM pages),
linked AS (SELECT *, max(page_id) OVER (PARTITION BY digest) AS last FROM sized)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
  CASE WHEN n >= 1000 AND last IS NOT NULL AND page_id IS DISTINCT FROM last THEN 'revisit' ELSE 'response' END
    AS record_type,
  CASE WHEN n >= 1000 AND page_id IS DISTINCT FROM last THEN last END AS refers_to
FROM linked"""

_COMPONENTS = """
reach(a, b) AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
smallest AS (SELECT a, min(b) AS b FROM reach GROUP BY a)"""

_VECTORS = f"""
WITH RECURSIVE good AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT x.vec_id AS a, y.vec_id AS b FROM good x JOIN good y
  ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.v) = len(y.v)
  WHERE list_cosine_similarity(x.v, y.v) >= 0.98),
{_COMPONENTS},
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(smallest.b, vec_id)) AS component_id,
  vec_id = least(vec_id, coalesce(smallest.b, vec_id)) AS kept
FROM embeddings LEFT JOIN counts ON counts.a = vec_id LEFT JOIN smallest ON smallest.a = vec_id"""

_NEAR = rf"""
WITH RECURSIVE split AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x09-\x0D\x20]+'), lambda w: w <> '') AS words FROM documents),
shingles AS (SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') AS s FROM (
  SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS i FROM split WHERE len(words) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (SELECT x.doc_id AS a, y.doc_id AS b FROM shingles x JOIN shingles y USING (s)
  JOIN sizes p ON p.doc_id = x.doc_id JOIN sizes q ON q.doc_id = y.doc_id
  WHERE x.doc_id <> y.doc_id GROUP BY x.doc_id, y.doc_id, p.n, q.n
  HAVING 100 * count(*) >= 75 * (p.n + q.n - count(*))),
{_COMPONENTS}
SELECT split.doc_id, coalesce(n, 0) AS n_shingles,
  least(split.doc_id, coalesce(smallest.b, split.doc_id)) AS component_id,
  split.doc_id = least(split.doc_id, coalesce(smallest.b, split.doc_id)) AS kept
FROM split LEFT JOIN sizes USING (doc_id) LEFT JOIN smallest ON smallest.a = split.doc_id"""

_LINES = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
keyed AS (SELECT doc_id, pos, line, translate(trim(line, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
frequent AS (SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 40
  GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
judged AS (SELECT keyed.*, coalesce(doc_id <> keeper, false) AS gone FROM keyed LEFT JOIN frequent USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id"""

_NEGATIVES = """
WITH good AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
    CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM good a JOIN good b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, other AS negative_id,
  positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other)
QUALIFY row_number() OVER w <= 10"""

_MIDDLE = """
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
    sha256('1:' || CAST(doc_id AS VARCHAR)) AS h FROM documents),
drawn AS (SELECT doc_id, t, u, len(u) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
    CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM cut),
placed AS (SELECT doc_id, t, u, n,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
      WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form,
    least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b FROM drawn),
parts AS (SELECT doc_id, t, n, form, coalesce(array_to_string(u[1:a], ''), '') AS p,
    coalesce(array_to_string(u[a + 1:b], ''), '') AS m, coalesce(array_to_string(u[b + 1:n], ''), '') AS s FROM placed)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m ELSE t END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM parts"""

ORACLE: dict[str, str] = {
    "op3_decontamination": _DECONTAMINATION,
    "op5_warc": _WARC,
    "op6_near_vectors": _VECTORS,
    "op7_mixing": raking.sql(),
    "op9_near_duplicates": _NEAR,
    "op11_line_dedup": _LINES,
    "op12_hard_negatives": _NEGATIVES,
    "op13_fill_middle": _MIDDLE,
}
