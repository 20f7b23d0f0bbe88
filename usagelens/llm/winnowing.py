"""Benchmark decontamination by winnowing.

Words are runs of a-z (A-Z lower-cased), 0-9 and all characters beyond ASCII. Every run of
``GRAM`` words has a hash, and of every ``WINDOW`` neighbouring hashes the smallest is kept as
a fingerprint with its position. A span of GRAM + WINDOW - 1 = 13 words that two texts share
gives both the same smallest hash at the same place of the span, so every shared span that
long has a common fingerprint. Items of fewer than 13 words must occur whole; for each such
length L all runs of L words are fingerprints (a window of one).

Fingerprints of documents and items are joined. Each meeting fixes how the item lies against
the document, and the hit is extended in both directions over all words that agree there;
runs of at least 13 words (or the whole short item) are what the item covers. Agreement is
checked on the words themselves, so a hash collision changes nothing.

Only built-in functions are used. The join has no hint: items small enough by Spark's own
threshold are broadcast, others meet the documents in a shuffled join that splits hot
fingerprints. Documents without a meeting are never tokenised a second time.

Defined results: null and blank texts have no words and no hits; null or blank items match
nothing; a repeated item id counts once, whichever of its texts occurs; null item ids are
left out. Documents that agree in id and text get equal rows; texts under one id are judged
apart. Other columns play no part.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from usagelens.session import stage

SPAN = 13
GRAM = 7
WINDOW = SPAN - GRAM + 1
#: A document is contaminated if at least one in so many of its words is hit.
SHARE = 20
_POSITION_BITS = 30  # word positions; the hash takes the 33 bits above, the sign stays free
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """The words of a text."""
    text = F.coalesce(text, F.lit(""))
    plain = F.octet_length(text) == F.char_length(text)  # for ASCII, lower() does just this
    lowered = F.when(plain, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))
    return F.array_remove(F.split(lowered, _GAPS), "")


def _grams(hashes: Column, width: int) -> Column:
    """Hash and position of every run of ``width`` words, as one number ordered by hash."""
    def gram(i: Column) -> Column:
        mixed = F.xxhash64(*[F.get(hashes, i + k) for k in range(width)])
        return F.shiftleft(F.shiftrightunsigned(mixed, 31), _POSITION_BITS).bitwiseOR(i.cast("long"))

    last = F.size(hashes) - width
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), gram)).otherwise(
        F.array().cast("array<bigint>"))


def _smallest(grams: Column, window: int) -> Column:
    """The smallest of every ``window`` neighbours, each once."""
    last = F.size(grams) - window
    picked = F.transform(F.sequence(F.lit(0), last), lambda i: F.least(
        *[F.get(grams, i + k) for k in range(window)]) if window > 1 else F.get(grams, i))
    return F.when(last >= 0, F.array_distinct(picked)).otherwise(F.array().cast("array<bigint>"))


def with_fingerprints(texts: DataFrame, span: int) -> DataFrame:
    """``texts`` (with ``words``) and ``prints``: the fingerprints for spans of that length."""
    gram = min(GRAM, span)
    hashed = texts.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    grams = hashed.withColumn("grams", _grams(F.col("hashes"), gram)).drop("hashes")
    return grams.withColumn("prints", _smallest(F.col("grams"), span - gram + 1)).drop("grams")


def _exploded(rows: DataFrame, position: str, keys: list[str]) -> DataFrame:
    # Not explode(): the filter it implies would be pushed below the projections that compute
    # the array, and compute it once more for every use.
    one = rows.select(*keys, F.explode_outer("prints").alias("print")).where(F.col("print").isNotNull())
    return one.select(*keys, F.shiftright("print", _POSITION_BITS).alias("hash"),
                      F.col("print").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)).cast("int").alias(position))


def meetings(prints: DataFrame, items: DataFrame, span: int) -> DataFrame:
    """(doc, content, entry, shift): where an item could lie against a document. ``shift`` is
    the position of the item's first word in the document."""
    own = stage(_exploded(with_fingerprints(items, span), "item_at", ["entry"]), "item-prints")
    return _exploded(prints, "doc_at", ["doc", "content"]).join(own, "hash").select(
        "doc", "content", "entry", (F.col("doc_at") - F.col("item_at")).alias("shift")).distinct()


def _once(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often ``body`` names it."""
    return F.transform(F.array(value), body)[0]


def _runs(shift: Column, span: Column) -> Column:
    """The runs, as (first, last) positions in the document, in which the item's words at this
    shift agree with the document's. Only as many words are looked at as the item has."""
    low = F.greatest(F.lit(0), shift)
    high = F.least(F.size("words"), shift + F.size("item_words"))  # exclusive
    breaks = F.concat(
        F.array(low - 1),
        F.filter(F.sequence(low, high - 1), lambda i: F.get("words", i) != F.get("item_words", i - shift)),
        F.array(high))
    return _once(breaks, lambda b: F.filter(
        F.zip_with(F.slice(b, 1, F.size(b) - 1), F.slice(b, 2, F.size(b) - 1),
                   lambda x, y: F.struct((x + 1).alias("first"), (y - 1).alias("last"))),
        lambda r: r["last"] - r["first"] + 1 >= span))


def extend(found: DataFrame, items: DataFrame, texts: DataFrame) -> DataFrame:
    """(doc, content, item, first, last) of every run that covers a window of an item.
    ``found`` are meetings, ``texts`` (doc, content, text) the documents.

    A document's words meet an item's once, with the list of all their shifts, which is no
    longer than the two texts; the words are not copied for every shift.
    """
    wanted = found.select("doc", "content").distinct()
    read = texts.join(wanted, [texts["doc"].eqNullSafe(wanted["doc"]),
                               texts["content"].eqNullSafe(wanted["content"])], "left_semi").select(
        "doc", "content", words(F.col("text")).alias("words")).dropDuplicates(["doc", "content"])
    read = stage(read, "met-documents")
    shifts = found.groupBy("doc", "content", "entry").agg(F.collect_set("shift").alias("shifts"))
    lined = shifts.join(read, [shifts["doc"].eqNullSafe(read["doc"]),
                               shifts["content"].eqNullSafe(read["content"])]).select(
        shifts["doc"], shifts["content"], "entry", "shifts", "words").join(
        items.select("entry", "item", F.col("words").alias("item_words")), "entry")
    span = F.least(F.lit(SPAN), F.size("item_words"))
    runs = F.flatten(F.transform("shifts", lambda shift: _runs(shift, span)))
    return lined.select("doc", "content", "item", F.explode_outer(runs).alias("run")).where(
        F.col("run").isNotNull()).select(
        "doc", "content", "item", "run.first", "run.last").distinct()


def find_spans(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
               item: str = "item_id", item_text: str = "text") -> tuple[DataFrame, DataFrame]:
    """All rows with their word counts (doc, content, n_words), and the runs of words that
    windows of items cover."""
    texts = docs.select(F.col(key).alias("doc"), F.xxhash64(F.col(text)).alias("content"),
                        F.col(text).alias("text"))
    items = stage(benchmark.select(F.col(item).alias("item"), words(F.col(item_text)).alias("words")).where(
        F.col("item").isNotNull() & (F.size("words") > 0)).distinct()
        .withColumn("entry", F.monotonically_increasing_id()), "items")
    spans = [r[0] for r in items.select(F.least(F.lit(SPAN), F.size("words"))).distinct().collect()]  # 1 to 13

    split = texts.select("doc", "content", words(F.col("text")).alias("words")).withColumn(
        "n_words", F.size("words").cast("long"))
    printed = stage(with_fingerprints(split, SPAN).drop("words"), "fingerprints")
    found = None
    for span in sorted(spans, reverse=True):
        own = items.where(F.least(F.lit(SPAN), F.size("words")) == span)
        prints = printed if span == SPAN else with_fingerprints(split, span)
        part = meetings(prints, own, span)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = meetings(printed, items, SPAN)
    runs = stage(extend(stage(found, "meetings"), items, texts), "runs")
    return printed.select("doc", "content", "n_words"), runs


def decontaminate(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id",
                  text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """Per row of ``docs``: key, n_words, n_hit, n_items, items_sha256, contaminated, and
    ``content``, a hash of the text."""
    rows, runs = find_spans(docs, benchmark, key, text, item, item_text)
    earlier = W.partitionBy("doc", "content").orderBy("first", "last").rowsBetween(
        W.unboundedPreceding, -1)
    covered = F.greatest(F.lit(0), F.col("last") - F.greatest(
        F.col("first"), F.coalesce(F.max("last").over(earlier), F.lit(-1)) + 1) + 1)
    hit = runs.select("doc", "content", "first", "last").distinct().select(
        "doc", "content", covered.alias("n")).groupBy("doc", "content").agg(F.sum("n").alias("n_hit"))
    named = runs.select("doc", "content", F.col("item").cast("string").alias("item")).distinct().groupBy(
        "doc", "content").agg(F.count("*").alias("n_items"),
                              F.concat_ws(",", F.array_sort(F.collect_list("item"))).alias("items"))
    result = stage(hit.join(named, [hit["doc"].eqNullSafe(named["doc"]),
                                    hit["content"].eqNullSafe(named["content"])]).select(
        hit["doc"].alias("d"), hit["content"].alias("c"), "n_hit", "n_items",
        F.sha2("items", 256).alias("sha")), "hits")
    return rows.join(result, [rows["doc"].eqNullSafe(result["d"]),
                              rows["content"].eqNullSafe(result["c"])], "left").select(
        F.col("doc").alias(key), "content", "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("sha", F.sha2(F.lit(""), 256)).alias("items_sha256")).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (SHARE * F.col("n_hit") >= F.col("n_words")))
