"""Raw flat events to typed, de-duplicated events with derived columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from usagelens.functions import (
    calendar_columns, clean_bool, clean_number, clean_timestamp, clean_wire_text,
    kind_flags, token_measures,
)
from usagelens.schemas import EVENT_NAMES, NUMERIC_COLUMNS, REQUIRED_COLUMNS, TEXT_COLUMNS


def missing_columns(raw: DataFrame) -> list[str]:
    """The required columns that events lack, in order; names may have blanks around them."""
    return sorted(set(REQUIRED_COLUMNS) - {c.strip() for c in raw.columns})


def conform(raw: DataFrame) -> DataFrame:
    """Typed columns in a stable schema. Required columns must exist; optional ones
    that do not are added with their empty value; further columns are kept."""
    df = raw.toDF(*[c.strip() for c in raw.columns])
    missing = missing_columns(df)
    if missing:
        raise ValueError(f"events lack required columns: {missing}")

    def typed(name: str, rule, empty) -> Column:
        value = rule(name) if name in df.columns else F.lit(empty)
        return value.alias(name)

    when = F.col("timestamp")
    if not isinstance(df.schema["timestamp"].dataType, T.TimestampType):
        when = clean_timestamp(when)
    known = {*TEXT_COLUMNS, *NUMERIC_COLUMNS, "timestamp", "success"}
    return df.select(
        when.alias("timestamp"),
        *[typed(c, clean_wire_text, "") for c in TEXT_COLUMNS],
        *[typed(c, lambda n: clean_number(F.col(n)), 0.0) for c in NUMERIC_COLUMNS],
        typed("success", lambda n: clean_bool(F.col(n)), False),
        *[F.col(c) for c in df.columns if c not in known],
    )


def drop_redelivered(conformed: DataFrame) -> DataFrame:
    """Keep one of each group of identical rows.

    Runs after cleaning and before zero-filling, so blanks around a text do not keep
    two rows apart but an absent number and a zero do. Copies collapse in the map
    tasks already, and the shuffle key is the whole row: neither many copies of one
    row nor a dominant session ends up in one task.
    """
    return conformed.dropDuplicates()


def count_copies(conformed: DataFrame) -> DataFrame:
    """``drop_redelivered`` that keeps in ``copies`` how often each row was delivered."""
    return conformed.groupBy(*conformed.columns).agg(F.count("*").alias("copies"))


def clean(raw: DataFrame) -> DataFrame:
    """Typed, zero-filled events without copies: all that needs to be shuffled."""
    return drop_redelivered(conform(raw)).na.fill(0.0, NUMERIC_COLUMNS)


def derive(events: DataFrame) -> DataFrame:
    """Token, calendar and kind columns."""
    return (
        events.withColumns(token_measures())
        .withColumns(calendar_columns(F.col("timestamp")))
        .withColumns(kind_flags())
    )


def standardize(raw: DataFrame) -> DataFrame:
    return derive(clean(raw))


def redelivery_summary(conformed: DataFrame) -> DataFrame:
    """One row of counts before and after de-duplication, from a single shuffle."""
    return summarize_copies(count_copies(conformed))


def summarize_copies(copies: DataFrame) -> DataFrame:
    """The same from rows that carry their ``copies``."""
    raw_rows = F.coalesce(F.sum("copies"), F.lit(0))
    undated = F.sum(F.when(F.col("timestamp").isNull(), F.col("copies")))
    return copies.agg(
        raw_rows.alias("raw_row_count"),
        F.count("*").alias("clean_row_count"),
        (raw_rows - F.count("*")).alias("duplicate_rows_removed"),
        F.coalesce(undated, F.lit(0)).alias("invalid_timestamp_count"),
        F.count_if(~F.col("event_name").isin(EVENT_NAMES)).alias("invalid_event_name_count"),
    )
