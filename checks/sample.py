"""The given star-schema tables seen as raw telemetry (see FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from usagelens.schemas import RAW_COLUMNS
from usagelens.sources.employees import conform_employees

# Which event kind each row of the events table stands for.
KINDS = {
    "click": "api_request", "view": "tool_decision", "purchase": "tool_result",
    "signup": "user_prompt", "error": "api_error",
}


def _text(c: Column) -> Column:
    return c.cast("string")


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per event, and a second, redelivered one where ``k`` is 7."""
    source = spark.read.parquet(f"{sf_dir}/events.parquet")
    k, user, kind = F.col("k"), F.col("user_id"), F.col("event_type")

    def only(kinds: tuple[str, ...], value: Column) -> Column:
        return F.when(kind.isin(*kinds), value)

    name = F.when(kind == "click", KINDS["click"])
    for source_kind in list(KINDS)[1:]:
        name = name.when(kind == source_kind, KINDS[source_kind])
    at = F.when((k == 3) & (kind == "view"), "not-a-time").otherwise(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
    period = F.floor(F.dayofmonth("ts") / 5)
    # Spellings of the success flag by k % 20; anything else is true.
    flag = F.lit("true")
    for i, spelling in enumerate(["false", "nan", " YES ", "1", "1.0"]):
        flag = F.when(k % 20 == i, spelling).otherwise(flag)

    columns = {
        "event_type": F.concat(F.lit("telemetry."), name),
        "event_name": F.when((kind == "error") & (k % 17 == 4), "beta_kind").otherwise(name),
        "timestamp": at,
        "session_id": F.concat(F.lit("s"), _text(
            F.when(k % 31 == 30, user - user % 2).otherwise(user)), F.lit("-"), _text(period)),
        "user_id": F.concat(F.lit("u"), _text(user)),
        "email": F.concat(F.lit(" user"), _text(user), F.lit("@example.com ")),
        "model": only(("click", "error"), F.when(k % 13 == 0, "").otherwise(
            F.concat(F.lit("model-"), _text(k % 5)))),
        "input_tokens": only(("click",), F.when(k == 0, "abc").otherwise(_text(k * 10))),
        "output_tokens": only(("click",), _text(
            F.when(k % 23 == 22, -40).otherwise(k % 7 * 100))),
        "cache_read_tokens": only(("click",), _text(k * 50)),
        "cache_creation_tokens": only(("click",), _text(k % 3 * 20)),
        "cost_usd": only(("click",), _text(F.col("value"))),
        "duration_ms": only(("click", "purchase", "error"), _text(
            F.when(k % 29 == 28, -1).otherwise(k * 25))),
        "prompt_length": only(("signup",), _text(k + 1)),
        "tool_name": only(("view", "purchase"), F.concat(F.lit("tool-"), _text(k % 17))),
        "success": only(("purchase",), flag),
        "terminal_type": F.when((user % 2 == 0) | (k % 9 == 0), "vscode").otherwise("iTerm2"),
        "organization_id": F.concat(F.lit("org"), _text(user % 10)),
        "practice": F.when(user % 20 == 19, "").otherwise("RESOURCE"),
    }
    keyed = source.withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    delivered = keyed.withColumn(
        "copy", F.explode(F.sequence(F.lit(1), F.when(k == 7, 2).otherwise(1))))
    return delivered.select(*[columns[c].alias(c) for c in RAW_COLUMNS])


def employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One employee per customer. Every tenth has left and is known by another email,
    every tenth has a blank practice."""
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    key = F.col("c_custkey")
    prefix = F.when(key % 10 == 9, "former").otherwise("user")
    return conform_employees(customer.join(
        nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        F.concat(prefix, _text(key), F.lit("@example.com")).alias("email"),
        F.col("c_name").alias("full_name"),
        F.when(key % 10 == 8, "  ").otherwise(F.col("c_mktsegment")).alias("practice"),
        F.concat(F.lit("L"), _text(key % 10 + 1)).alias("level"),
        F.col("n_name").alias("location"),
    ))
