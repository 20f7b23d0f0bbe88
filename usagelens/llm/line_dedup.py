"""Line de-duplication: lines that many documents share stay in one of them only.

A text is split at line feeds. A line's key is the line without the ASCII white space at both
ends and with A-Z in lower case. A key of at least ``min_chars`` code points that occurs in at
least ``min_docs`` documents is frequent: its lines go, except in the largest id that has it.
The other lines stay as they are, in their order.

Lines are exploded once, with the position and a 128-bit hash of the key, and only these numbers
are written and shuffled. Distinct documents are counted per hash with partial counts in the map
tasks. Frequent keys are matched to lines by a join. Keys with more than 1 / ``HOT_KEYS`` of the
matched lines, of which there cannot be more than ``HOT_KEYS``, are broadcast for that, so that a
line found everywhere is not gathered in one task. The positions that go, one row per document
that loses lines, are joined to the texts, which are put together again by position.

Defined results. Null and empty texts are one empty line. Documents are told apart by id: rows
with one id count as one document, and all of them keep or lose a key. A null id is no document
when documents are counted and never the one that keeps a line, so its lines go if other
documents make them frequent. Equal rows stay equal rows. If all lines go, the text is empty.
Other columns pass through; columns called ``n_lines`` or ``n_dropped`` are replaced. Texts may
be of any length: a task holds the lines of one at a time. Empty tables give empty results.
"""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagelens.session import stage

MIN_CHARS = 40
MIN_DOCS = 5
#: At most so many keys are broadcast as hot ones.
HOT_KEYS = 10_000
# Fixed value: what is stripped from both ends of a line.
BLANKS = " \t\n\x0b\x0c\r"


def _split(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """The line stripped, A-Z in lower case and nothing else changed."""
    key = F.btrim(line, F.lit(BLANKS))
    plain = F.octet_length(key) == F.length(key)
    return F.when(plain, F.lower(key)).otherwise(
        F.translate(key, string.ascii_uppercase, string.ascii_lowercase))


def _once(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often ``body`` names it."""
    return F.transform(F.array(value), body)[0]


def long_lines(docs: DataFrame, key: str, text: str, min_chars: int = MIN_CHARS) -> DataFrame:
    """(id, content, at, h1, h2): place and hash of every line that could be frequent."""
    lines = docs.select(F.col(key).alias("id"), F.xxhash64(text).alias("content"),
                        F.posexplode(_split(F.col(text))).alias("at", "line"))
    keyed = lines.select("id", "content", "at", line_key(F.col("line")).alias("key"))
    return keyed.where(F.length("key") >= min_chars).select(
        "id", "content", "at", F.xxhash64("key").alias("h1"),
        F.xxhash64(F.lit(1), "key").alias("h2"))


def frequent_keys(lines: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(h1, h2, keeper, n_lines) of the keys found in at least ``min_docs`` documents."""
    return lines.groupBy("h1", "h2").agg(
        F.count_distinct("id").alias("n_docs"), F.max("id").alias("keeper"),
        F.count("*").alias("n_lines")).where(F.col("n_docs") >= min_docs).drop("n_docs")


def _matched(lines: DataFrame, frequent: DataFrame, hot_keys: int) -> DataFrame:
    """Lines with a frequent key, each with the id that keeps it."""
    total = frequent.agg(F.coalesce(F.sum("n_lines"), F.lit(0))).head()[0]
    is_hot = F.col("n_lines") * hot_keys > total
    # Keys with more than 1 / hot_keys of all lines: never more than hot_keys of them.
    hot = F.broadcast(frequent.where(is_hot).drop("n_lines"))
    rest = frequent.where(~is_hot).drop("n_lines")
    return lines.join(hot, ["h1", "h2"]).unionByName(
        lines.join(hot.drop("keeper"), ["h1", "h2"], "left_anti").join(rest, ["h1", "h2"]))


def drop_repeated_lines(docs: DataFrame, key: str = "doc_id", text: str = "text",
                        min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
                        hot_keys: int = HOT_KEYS) -> DataFrame:
    """``docs`` with shorter texts, and the numbers ``n_lines`` before and ``n_dropped``."""
    lines = stage(long_lines(docs, key, text, min_chars), "long-lines")
    frequent = stage(frequent_keys(lines, min_docs), "frequent-lines")
    gone = _matched(lines, frequent, hot_keys).where(~F.col("id").eqNullSafe(F.col("keeper")))
    # As long as one text has lines; equal rows name the same places.
    gone = gone.groupBy("id", "content").agg(F.collect_set("at").alias("gone"))

    whole = docs.select(F.col(key).alias("own"), F.xxhash64(text).alias("hash"),
                        F.struct("*").alias("row"))
    joined = whole.join(gone, F.col("own").eqNullSafe(F.col("id"))
                        & (F.col("hash") == F.col("content")), "left")
    had = _split(F.col(f"row.`{text}`"))
    left = _once(F.struct(had.alias("lines"), F.col("gone").alias("gone")), lambda x: F.array_join(
        F.transform(F.array_except(F.sequence(F.lit(0), F.size(x["lines"]) - 1), x["gone"]),
                    lambda at: F.get(x["lines"], at)), "\n"))
    added = {"n_lines": F.size(had).cast("long"),
             "n_dropped": F.coalesce(F.size("gone"), F.lit(0)).cast("long")}
    shown = F.when(F.col("gone").isNull(), F.coalesce(F.col(f"row.`{text}`"), F.lit(""))).otherwise(left)
    return joined.select(
        *[(shown if c == text else F.col(f"row.`{c}`")).alias(c)
          for c in docs.columns if c not in added],
        *[value.alias(name) for name, value in added.items()])
