"""Flat events back to log batches, and pseudonymous ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagelens.functions import clean_timestamp
from usagelens.operators.numbering import number_rows
from usagelens.schemas import (
    API_REQUEST, ATTRIBUTE_KEYS, BODY_COLUMN, ENVELOPE, RAW_COLUMNS, RESOURCE_KEYS,
)

# Fixed value: the message type of a data batch.
DATA_MESSAGE = "DATA_MESSAGE"


def _message() -> Column:
    """The event as JSON text; absent values leave their key out."""
    return F.to_json(F.struct(
        F.col(BODY_COLUMN).alias("body"),
        F.struct(*[F.col(c).alias(k) for c, k in ATTRIBUTE_KEYS.items()]).alias("attributes"),
        F.struct(*[F.col(c).alias(k) for c, k in RESOURCE_KEYS.items()]).alias("resource"),
    ))


def pack_batches(raw: DataFrame, batch_size: int = 10, owner: str = "000000000000",
                 log_group: str = "/telemetry", log_stream: str = "collector",
                 subscription: str = "logs-to-storage") -> DataFrame:
    """Pack consecutive events, by time, into envelopes of up to ``batch_size``.

    The envelope's date is that of its first event. Redelivered rows are kept; a
    copy number as the last sort key lets many copies of one row spread over tasks.
    ``raw`` should be read from files, so that a repeated task sees the same rows in
    the same order.

    Numbered events are placed once more, in ranges of whole batches (one exchange of the
    events). Grouping needs no other placement, and the batches of a task are neighbours in
    time, so writing them needs none either.
    """
    timed = raw.select(
        clean_timestamp(F.col("timestamp")).alias("_at"), *RAW_COLUMNS,
        F.monotonically_increasing_id().alias("_copy"))
    order = ["_at", "session_id", "event_name",
             *[c for c in RAW_COLUMNS if c not in ("session_id", "event_name")], "_copy"]
    numbered = number_rows(timed, order, "_position")

    first = (F.col("_position") - 1) % batch_size == 0
    day = F.when(first, F.col("_at"))
    event = F.struct(
        F.col("_position").alias("position"),
        F.lpad(F.col("_position").cast("string"), 20, "0").alias("id"),
        F.unix_millis("_at").alias("timestamp"),
        _message().alias("message"))
    batch = F.floor((F.col("_position") - 1) / batch_size).cast("bigint")
    # Range limits are drawn over batches, so a batch is never cut.
    placed = numbered.withColumn("batch_id", batch).repartitionByRange("batch_id")
    # At most batch_size events share a batch, so the list below is bounded.
    packed = placed.groupBy("batch_id").agg(
        F.sort_array(F.collect_list(event)).alias("events"), F.min(day).alias("first_at"))
    log_event = ENVELOPE["logEvents"].dataType
    return packed.select(
        "batch_id",
        F.lit(DATA_MESSAGE).alias("messageType"),
        F.lit(owner).alias("owner"),
        F.lit(log_group).alias("logGroup"),
        F.lit(log_stream).alias("logStream"),
        F.array(F.lit(subscription)).alias("subscriptionFilters"),
        F.transform("events", lambda e: F.struct(e["id"], e["timestamp"], e["message"]))
        .cast(log_event).alias("logEvents"),
        F.year("first_at").alias("year"),
        F.month("first_at").alias("month"),
        F.dayofmonth("first_at").alias("day"),
    )


def event_type_totals(raw: DataFrame) -> DataFrame:
    """Rows per event type as delivered, and the cost of the request types."""
    cost = F.when(F.col("event_name") == API_REQUEST, F.col("cost_usd").try_cast("double"))
    return (raw.groupBy("event_type")
            .agg(F.count("*").alias("event_count"),
                 F.coalesce(F.sum(cost), F.lit(0.0)).alias("request_cost_usd"))
            .orderBy(F.desc("event_count"), "event_type"))


def pseudonym(email: Column) -> Column:
    return F.sha2(email, 256)
