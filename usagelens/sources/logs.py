"""Log batches: newline-delimited JSON envelopes holding JSON messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from usagelens.schemas import (
    ATTRIBUTE_KEYS, BODY_COLUMN, ENVELOPE, MESSAGE, RAW_COLUMNS, RESOURCE_KEYS,
)

CORRUPT = "_corrupt_record"
#: The column of decoded rows that tells events from rejects, and its values.
OUTCOME = "outcome"
EVENT, BAD_LINE, BAD_MESSAGE = "event", "line", "message"


def _with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def read_log_batches(spark: SparkSession, path: str, strict: bool = True,
                     stream: bool = False) -> DataFrame:
    """One row per line. A malformed line stops the read, or with ``strict=False``
    is kept in ``_corrupt_record``. With ``stream`` files that arrive later are read too."""
    reader = spark.readStream if stream else spark.read
    if strict:
        return reader.schema(ENVELOPE).json(path, mode="FAILFAST")
    return reader.schema(_with_corrupt(ENVELOPE)).json(
        path, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT)


def flatten_batches(batches: DataFrame, strict: bool = True) -> DataFrame:
    """Flat events, one row per log event, every column a string.

    A batch without log events yields no row. A message that is not JSON stops the
    job, or with ``strict=False`` is left out here and found by ``rejected``.
    """
    if strict:
        messages = batches.select(F.explode("logEvents.message").alias("message"))
        text = F.coalesce("message", F.raise_error(F.lit("log event without a message")))
        decoded = F.from_json(text, MESSAGE, {"mode": "FAILFAST"})
        return messages.select(decoded.alias("m")).select(*_flat_columns())
    return accepted(decode_batches(batches))


def rejected(batches: DataFrame) -> DataFrame:
    """The lines and messages a lenient read had to leave out, with the reason."""
    return set_aside(decode_batches(batches))


def decode_batches(batches: DataFrame) -> DataFrame:
    """Everything a lenient read finds, events and rejects, in one pass.

    ``outcome`` says what a row is: an event, a line that is no batch or a message that is
    no event. Events have their columns, rejects their text.
    """
    # A malformed line has no log events, only its own text.
    found = batches.select(F.explode(F.when(
        F.col(CORRUPT).isNotNull(), F.array(F.struct(
            F.lit(BAD_LINE).alias("reason"), F.col(CORRUPT).alias("message")))
    ).otherwise(F.transform("logEvents.message", lambda m: F.struct(
        F.lit(BAD_MESSAGE).alias("reason"), m.alias("message"))))).alias("e")).select("e.*")
    decoded = F.from_json("message", _with_corrupt(MESSAGE),
                          {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    bad = (F.col("reason") == BAD_LINE) | F.col("m").isNull() | F.col(f"m.{CORRUPT}").isNotNull()
    return found.withColumn("m", decoded).select(
        F.when(bad, F.col("reason")).otherwise(F.lit(EVENT)).alias(OUTCOME),
        F.when(bad, F.col("message")).alias("text"), *_flat_columns())


def accepted(decoded: DataFrame) -> DataFrame:
    """The events among decoded rows."""
    return decoded.where(F.col(OUTCOME) == EVENT).select(*RAW_COLUMNS)


def set_aside(decoded: DataFrame) -> DataFrame:
    """The rejects among decoded rows: reason and text."""
    return decoded.where(F.col(OUTCOME) != EVENT).select(F.col(OUTCOME).alias("reason"), "text")


def _flat_columns():
    # Attribute names hold dots, hence the back-ticks.
    return [
        F.col("m.body").alias(BODY_COLUMN),
        *[F.col(f"m.attributes.`{key}`").alias(name) for name, key in ATTRIBUTE_KEYS.items()],
        *[F.col(f"m.resource.`{key}`").alias(name) for name, key in RESOURCE_KEYS.items()],
    ]


def write_log_batches(batches: DataFrame, path: str, partitioned: bool = False) -> None:
    """Write envelopes as JSON lines, optionally in year/month/day folders.

    Batches of ``pack_batches`` are written where they lie: a task holds neighbouring
    ones, so a short span of days and few folders, and a busy day still spreads over tasks.
    """
    writer = batches.drop("batch_id").write
    if partitioned:
        writer = writer.partitionBy("year", "month", "day")
    writer.json(path)


def ingest(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """Log files to flat events."""
    return flatten_batches(read_log_batches(spark, path, strict), strict)
