"""Mixing sources to target weights by iterative proportional fitting.

Documents fall into cells, one per combination of source, language and topic that occurs. A
cell starts with its share of all tokens; raking scales the cells of each source, then of
each language, then of each topic to that value's target, until all three agree with their
targets to ``TOLERANCE``. A document's
weight is its cell's raked share over its real share, and its probability of being sampled
is that weight times a factor that makes the expected sample the wanted fraction of all
tokens. No probability exceeds one: cells that would are taken whole and the others' factor
rises until the expected total is met. A document is kept if a number drawn from a hash of
its id is below its probability, so a sample does not depend on partitioning and can be
repeated.

Only built-in functions are used. Documents are read once for their cells' sums; all fitting
is done on the cells, a table with a row per combination of values.

Defined results: a null value of a margin is a value of its own, written as an empty text.
Null and blank texts have 0 tokens; cells without any token are sampled at the fraction
itself. Values that a given target table lacks get weight 0, targets of values that do not
occur are spread over the others in proportion. Targets that no weights meet (a source that has
only one language, say) are raked until they come no nearer, and what is left is told by a warning. Documents with equal ids are kept or left out
together if they share a cell; a null id is one id. Other columns pass through; columns
named like a result are replaced.
"""

from __future__ import annotations

import warnings
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from usagelens.session import stage

MARGINS = ("source", "lang", "topic")
#: Targets of the query: shares in proportion to tokens to this power, which evens them out.
TEMPER = 0.7
#: The part of all tokens a sample should have.
FRACTION = 0.7
#: Sweeps end when no share is off its target by more than this, when as many as fit into a plan
#: leave more than this part of what was off before, or after so many.
TOLERANCE = 1e-12
_STANDSTILL = 0.995
MAX_SWEEPS = 200
_SWEEPS_PER_PLAN = 5
#: Sweeps of the SQL, which has no loop: enough for the tolerance on the given tables.
_SQL_SWEEPS = 40
_BLANKS = "[\\x09-\\x0D\\x20]+"
_ADDED = ("n_tokens", "prob", "kept")


def count_words(text: Column) -> Column:
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), _BLANKS), "")).cast("long")


def content_kind(text: Column) -> Column:
    """A topic for corpora without topic labels: the kind of content by its marks."""
    return (F.when(F.contains(text, F.lit(" | ")), "table")
            .when(F.contains(text, F.lit("$$$")) | F.contains(text, F.lit("%%%")), "markup")
            .when(F.contains(text, F.lit("!!")), "notice").otherwise("prose"))


def _value(name: str) -> Column:
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))


def cell_sums(docs: DataFrame, margins: tuple[str, ...] = MARGINS) -> DataFrame:
    """(margins..., n): the tokens of every cell."""
    return docs.groupBy(*[_value(m).alias(m) for m in margins]).agg(F.sum("n_tokens").alias("n"))


def tempered(cells: DataFrame, margin: str, power: float = TEMPER) -> DataFrame:
    """(margin, share): targets in proportion to tokens to a power."""
    return cells.groupBy(margin).agg(F.sum("n").cast("double").alias("t")).select(
        margin, F.when(F.col("t") > 0, F.pow("t", F.lit(power))).otherwise(0.0).alias("share"))


def rake(cells: DataFrame, targets: dict[str, DataFrame], tolerance: float = TOLERANCE,
         max_sweeps: int = MAX_SWEEPS) -> DataFrame:
    """``cells`` with ``weight``: shares of all tokens that agree with the targets, which are
    tables (margin, share) of any scale. Sweeps go on until no value's share is off its target
    by more than ``tolerance``. Where ``_SWEEPS_PER_PLAN`` more bring the shares hardly nearer,
    the cells cannot meet the targets: a warning then names what is left. Windows run over
    cells, never over documents."""
    rows = cells.withColumn("weight", F.col("n").cast("double"))
    for margin, target in targets.items():
        goal = F.when(F.col("t") > 0, F.coalesce("share", F.lit(0.0))).otherwise(0.0)
        present = cells.groupBy(margin).agg(F.sum("n").alias("t")).join(target, margin, "left").select(
            margin, goal.alias("goal"))
        whole = present.agg(F.sum("goal")).scalar()
        rows = rows.join(present.select(margin, F.try_divide("goal", whole).alias(f"_{margin}")), margin)
    rows = stage(rows, "cells")
    before = float("inf")
    for sweep in range(1, max_sweeps + 1):
        for margin in targets:
            total = F.sum("weight").over(W.partitionBy(margin))
            rows = rows.withColumn("weight", F.when(
                total > 0, F.col("weight") * F.coalesce(f"_{margin}", F.lit(0.0)) / total).otherwise(0.0))
        if sweep % _SWEEPS_PER_PLAN and sweep < max_sweeps:
            continue
        rows = stage(rows, "swept")  # plans of bounded depth
        off = _largest_deviation(rows, list(targets))
        if off <= tolerance:
            break
        if off > _STANDSTILL * before or sweep == max_sweeps:
            warnings.warn(f"the targets are not met: a share is off by {off:.3g} after {sweep} sweeps")
            break
        before = off
    return rows.drop(*[f"_{m}" for m in targets])


def _largest_deviation(rows: DataFrame, margins: list[str]) -> float:
    """The furthest that the share of any value of a margin is from its target."""
    def furthest(margin: str) -> DataFrame:
        off = F.sum("weight") - F.max(F.coalesce(f"_{margin}", F.lit(0.0)))
        return rows.groupBy(margin).agg(F.abs(off).alias("off")).agg(F.max("off").alias("off"))

    found = reduce(DataFrame.unionByName, map(furthest, margins)).agg(F.max("off")).head()[0]
    return found or 0.0


def probabilities(raked: DataFrame, fraction: float = FRACTION) -> DataFrame:
    """``raked`` with ``prob``. With one factor for all, cells whose probability would exceed
    one are taken whole and the factor of the others rises to make up for it, until no more
    cells exceed one. Each round is one sum over the cells."""
    rows = raked.withColumn("ratio", F.when(F.col("n") > 0, F.col("weight") / F.col("n")).otherwise(0.0))
    factor, whole = 0.0, -1
    while True:
        full = F.col("ratio") * F.lit(factor) > 1
        sums = rows.agg(
            F.coalesce(F.sum("n"), F.lit(0)), F.count_if(full), F.coalesce(F.sum(F.when(full, F.col("n"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0))).head()
        total, found, taken, left = sums
        if found == whole:
            break
        whole = found
        # Nothing left to share out: whatever has weight has been taken whole.
        factor = max(0.0, fraction * total - taken) / left if left > 0 else factor
    prob = F.when(F.col("n") == 0, F.lit(fraction)).otherwise(
        F.least(F.lit(1.0), F.col("ratio") * F.lit(factor)))
    return rows.withColumn("prob", F.round(prob, 9)).drop("ratio")


def draw(key: str) -> Column:
    """A number from 0 up to 1 out of 52 bits of a hash of the id."""
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / float(1 << 52)


def mix(docs: DataFrame, margins: tuple[str, ...] = MARGINS, key: str = "doc_id",
        text: str = "text", targets: dict[str, DataFrame] | None = None,
        fraction: float = FRACTION) -> DataFrame:
    """``docs`` with n_tokens, prob and kept."""
    rows = docs.drop(*_ADDED).withColumn("n_tokens", count_words(F.col(text)))
    cells = stage(cell_sums(rows, margins), "cell-sums")
    wanted = targets or {m: tempered(cells, m) for m in margins}
    probs = stage(probabilities(rake(cells, wanted), fraction), "probabilities").select(
        *[F.col(m).alias(f"_cell_{m}") for m in margins], "prob")
    same = [_value(m) == F.col(f"_cell_{m}") for m in margins]
    return rows.join(probs, same, "left").drop(*[f"_cell_{m}" for m in margins]).withColumn(
        "kept", draw(key) < F.col("prob"))


def sql(sweeps: int = _SQL_SWEEPS, fraction: float = FRACTION, temper: float = TEMPER) -> str:
    """DuckDB SQL for the query's rows."""
    steps = ["""docs AS (SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang,
      CASE WHEN contains(text, ' | ') THEN 'table'
           WHEN contains(text, '$$$') OR contains(text, '%%%') THEN 'markup'
           WHEN contains(text, '!!') THEN 'notice' ELSE 'prose' END AS topic,
      CAST(len(list_filter(string_split_regex(coalesce(text, ''), '[\\x09-\\x0D\\x20]+'),
                           lambda w: w <> '')) AS BIGINT) AS n_tokens FROM documents)""",
             "cells AS (SELECT source, lang, topic, sum(n_tokens) AS n FROM docs GROUP BY ALL)"]
    shares = []
    for m in MARGINS:
        steps.append(f"t_{m} AS (SELECT {m}, power(sum(n), {temper}) / sum(power(sum(n), {temper})) OVER () "
                     f"AS s_{m} FROM cells GROUP BY {m})")
        shares.append(f"JOIN t_{m} USING ({m})")
    steps.append("w0 AS (SELECT cells.*, s_source, s_lang, s_topic, CAST(n AS DOUBLE) AS w FROM cells "
                 + " ".join(shares) + ")")
    step = 0
    for _ in range(sweeps):
        for m in MARGINS:
            steps.append(f"w{step + 1} AS MATERIALIZED (SELECT * REPLACE (CASE WHEN sum(w) OVER (PARTITION BY {m}) > 0 "
                         f"THEN w * s_{m} / sum(w) OVER (PARTITION BY {m}) ELSE 0 END AS w) FROM w{step})")
            step += 1
    steps += [f"r AS (SELECT *, CASE WHEN n > 0 THEN w / n ELSE 0 END AS ratio FROM w{step})",
              f"""f AS (SELECT *, (sum(n) OVER () * {fraction} - coalesce(sum(n) OVER (ORDER BY ratio DESC, source, lang,
        topic ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / nullif(sum(w) OVER (ORDER BY ratio DESC, source,
        lang, topic ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0) AS factor FROM r)""",
              "c AS (SELECT arg_max(factor, ratio) AS factor FROM f WHERE factor * ratio <= 1)",
              f"""p AS (SELECT source, lang, topic, round(CASE WHEN n = 0 THEN {fraction}
        ELSE least(1.0, ratio * (SELECT factor FROM c)) END, 9) AS prob FROM f)"""]
    return "WITH " + ",\n".join(steps) + """
SELECT doc_id, source, lang, topic, n_tokens, prob,
  CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) / 4503599627370496.0 < prob AS kept
FROM docs JOIN p USING (source, lang, topic)"""
