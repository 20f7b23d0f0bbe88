"""The ingest and cleaning steps on log files that keep arriving."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from usagelens.operators.standardize import conform, derive
from usagelens.schemas import NUMERIC_COLUMNS
from usagelens.sources.logs import (
    EVENT, OUTCOME, decode_batches, flatten_batches, read_log_batches, set_aside,
)

#: Names the row as it was before zero-filling; copies of a row share it.
ROW_ID = "row_id"
#: The day (UTC) a row is stored under, ``undated`` for rows without a time.
DAY = "event_day"
UNDATED = "undated"
#: A trigger with more days than this is compared with the whole table.
MAX_DAYS = 1000


def stream_events(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """Standardized events from a folder of log files, with ``row_id`` and ``event_day``.

    Redelivered rows are still in it; ``append_events`` leaves them out. Nothing is
    kept from one trigger to the next, and no event is too late. With ``strict=False``
    malformed lines and messages are rows as well, told apart by ``outcome``, with their
    ``text``; ``append_events`` writes them to a folder of their own.
    """
    batches = read_log_batches(spark, path, strict, stream=True)
    events = conform(flatten_batches(batches) if strict else decode_batches(batches))
    whole = F.struct(F.unix_micros("timestamp").alias("timestamp"),
                     *[c for c in events.columns if c != "timestamp"])
    keyed = events.withColumn(ROW_ID, F.md5(F.to_json(whole)))
    day = F.substring(F.col("event_day_start").cast("string"), 1, 10)
    return derive(keyed.na.fill(0.0, NUMERIC_COLUMNS)).withColumn(
        "event_day_start", F.date_from_unix_date(
            F.floor(F.unix_micros("timestamp") / 86_400_000_000).cast("int"))).withColumn(
        DAY, F.coalesce(day, F.lit(UNDATED))).drop("event_day_start")


def append_events(events: DataFrame, path: str, progress: str, rejects: str | None = None,
                  **trigger) -> StreamingQuery:
    """Append to a Parquet table by day, each row once however often and late it arrives.

    A trigger's rows are freed of copies among themselves and of rows the table holds
    already; only the folders of the days that occur in the trigger are read for that, and
    only their ids (a trigger with more than ``MAX_DAYS`` days reads the ids of all). A
    trigger that is repeated after a failure adds nothing twice. Rejects of a lenient stream
    go to the folder ``rejects``, by trigger, with their reason. ``progress`` is the folder
    of the stream's own state.
    """
    lenient = OUTCOME in events.columns
    if lenient and not rejects:
        raise ValueError("a lenient stream needs a folder for what it rejects")
    schema = (events.drop(OUTCOME, "text") if lenient else events).schema

    def add(batch: DataFrame, number: int) -> None:
        # Used several times; a lost part is read again from the trigger's files.
        batch.persist()
        try:
            good = batch
            if lenient:
                set_aside(batch).write.mode("overwrite").parquet(f"{rejects}/trigger={number}")
                good = batch.where(F.col(OUTCOME) == EVENT).drop(OUTCOME, "text")
            fresh = good.dropDuplicates()
            held = _held(good, path, schema)
            if held is not None:
                fresh = fresh.join(held, [DAY, ROW_ID], "left_anti")
            fresh.write.mode("append").partitionBy(DAY).parquet(path)
        finally:
            batch.unpersist()

    writer = events.writeStream.foreachBatch(add)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.option("checkpointLocation", progress).start()


def _held(batch: DataFrame, path: str, schema) -> DataFrame | None:
    """Days and ids of the table's rows, of the trigger's days only; None without a table."""
    try:
        held = batch.sparkSession.read.schema(schema).parquet(path).select(DAY, ROW_ID)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    days = [r[0] for r in batch.select(DAY).distinct().limit(MAX_DAYS + 1).collect()]
    return held.where(F.col(DAY).isin(days)) if len(days) <= MAX_DAYS else held
