"""Data-quality counts and the report built from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagelens.operators.marts import activity
from usagelens.operators.standardize import redelivery_summary
from usagelens.schemas import (
    EVENT_NAMES, MISSING_CHECKED, NEGATIVE_CHECKED, NULL_CHECKED, REQUIRED_COLUMNS, UNKNOWN,
)

#: Stands in the report's distribution for all kinds that are not known.
OTHER_KINDS = "other"


def event_distribution(events: DataFrame) -> DataFrame:
    """Every kind that occurs, known or not, with its events, most frequent first."""
    return (events.groupBy("event_name").agg(F.count("*").alias("event_count"))
            .orderBy(F.desc("event_count"), "event_name"))


def kinds_of(rows: DataFrame) -> DataFrame:
    """The same from ``activity`` rows, in no order."""
    return rows.groupBy("event_name").agg(F.sum("events").alias("event_count"))


def _total(value: Column) -> Column:
    return F.coalesce(F.sum(value), F.lit(0).cast("bigint"))


def _counts() -> dict[str, Column]:
    """Null, blank, negative and Unknown counts as aggregates over ``activity`` rows.

    Cleaning has turned null texts into blanks, so only the time can still be null; the blank
    counts say what the null counts no longer can. Texts that are part of the activity's key
    are judged there, the others were counted when events were added up.
    """
    texts = [c for c in NULL_CHECKED if c != "timestamp"]
    counted = ["model", "tool_name"]

    def where(condition: Column) -> Column:
        return _total(F.when(condition, F.col("events")))

    return {
        "null_timestamp": _total(F.col("undated")),
        **{f"null_{c}": F.lit(0).cast("bigint") if c in counted else where(F.col(c).isNull()) for c in texts},
        **{f"blank_{c}": _total(F.col(f"blank_{c}")) if c in counted else where(F.col(c) == "")
           for c in texts},
        **{f"negative_{c}": _total(F.col(f"negative_{c}")) for c in NEGATIVE_CHECKED},
        **{f"missing_{c}": where(F.col(c) == UNKNOWN) for c in MISSING_CHECKED},
    }


def column_counts(events: DataFrame) -> DataFrame:
    """One row of null, blank, negative and Unknown counts, in one pass over enriched events."""
    return activity(events).agg(*[value.alias(name) for name, value in _counts().items()])


def _group(prefix: str, names: list[str]):
    return F.struct(*[F.col(f"f.{prefix}_{n}").alias(n) for n in names])


def quality_report(conformed: DataFrame, events: DataFrame, session_table: DataFrame,
                   user_table: DataFrame, **more) -> DataFrame:
    """``report`` from the cleaned events before de-duplication and the enriched ones."""
    return report(redelivery_summary(conformed), activity(events), session_table, user_table, **more)


def report(summary: DataFrame, rows: DataFrame, session_table: DataFrame, user_table: DataFrame,
           rejects: DataFrame | None = None, duplicate_keys: DataFrame | None = None) -> DataFrame:
    """The report as one nested row.

    ``summary`` is the one row of ``redelivery_summary``, ``rows`` are the ``activity`` of the
    enriched events, ``rejects`` the lines and messages a lenient read left out, and
    ``duplicate_keys`` the employees' emails that occur more than once. The distribution has
    the known kinds and the sum of all others, whatever senders call them;
    ``kinds_of`` lists each one, as a table.
    """
    kind, n = F.col("event_name"), F.col("events")
    facts = rows.agg(
        *[_total(F.when(kind == k, n)).alias(k) for k in EVENT_NAMES],
        _total(F.when(~kind.isin(EVENT_NAMES), n)).alias(OTHER_KINDS),
        F.min("first_at").alias("first_at"), F.max("last_at").alias("last_at"),
        *[value.alias(name) for name, value in _counts().items()])

    def number(df: DataFrame | None, value: Column) -> Column:
        return F.lit(0).cast("bigint") if df is None else df.agg(value).scalar()

    def rejected(reason: str) -> Column:
        return number(rejects, F.count_if(F.col("reason") == reason))

    one = rows.sparkSession.range(1).select(
        summary.select(F.struct("*")).scalar().alias("r"),
        facts.select(F.struct("*")).scalar().alias("f"),
        session_table.agg(F.count("*")).scalar().alias("sessions"),
        user_table.agg(F.count("*")).scalar().alias("users"),
        rejected("line").alias("lines"), rejected("message").alias("messages"),
        number(duplicate_keys, F.count("*")).alias("emails"),
    )
    blanks = [c for c in NULL_CHECKED if c != "timestamp"]
    return one.select(
        F.struct(
            "r.*",
            F.col("f.api_request").alias("total_api_requests"),
            F.col("f.tool_result").alias("total_tool_results"),
            F.col("sessions").alias("total_sessions"),
            F.col("users").alias("total_users"),
            F.col("f.first_at").alias("timestamp_min"),
            F.col("f.last_at").alias("timestamp_max"),
            F.col("lines").alias("rejected_lines"),
            F.col("messages").alias("rejected_messages"),
            F.col("emails").alias("duplicate_employee_emails"),
        ).alias("summary"),
        F.struct(
            F.array(*[F.lit(c) for c in sorted(REQUIRED_COLUMNS)])
            .alias("required_columns_present"),
            F.array(*[F.lit(k) for k in sorted(EVENT_NAMES)]).alias("known_event_names"),
            # Kinds that occur, and never more entries than there are known ones and one.
            F.map_filter(F.create_map(*[x for k in [*EVENT_NAMES, OTHER_KINDS]
                                        for x in (F.lit(k), F.col(f"f.{k}"))]),
                         lambda _, held: held > 0).alias("event_name_distribution"),
            _group("null", NULL_CHECKED).alias("null_counts"),
            _group("blank", blanks).alias("blank_counts"),
            _group("negative", NEGATIVE_CHECKED).alias("negative_numeric_counts"),
            *[F.col(f"f.missing_{c}").alias(f"missing_{c}_count") for c in MISSING_CHECKED],
        ).alias("validation"),
    )
