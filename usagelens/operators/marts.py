"""Request, tool, session and user tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagelens.functions import (
    first_filled, minutes_between, most_frequent, or_unknown, ratio_or, request_ratios,
    seconds_between,
)
from usagelens.operators.enrich import SENT_PRACTICE
from usagelens.schemas import (
    API_REQUEST, EVENT_NAMES, NEGATIVE_CHECKED, TOOL_RESULT, USER_PROMPT,
)
from usagelens.session import stage

#: Stands for every kind without a column; no event name holds a line break.
_OTHER = "\nother"
_IDENTITY = ["user_id", "email", "full_name", "practice", "level", "location",
             "organization_id"]


def api_requests(events: DataFrame) -> DataFrame:
    return events.where(F.col("event_name") == API_REQUEST).withColumns(request_ratios())


def tool_results(events: DataFrame) -> DataFrame:
    return events.where(F.col("event_name") == TOOL_RESULT)


# --- grouped activity ------------------------------------------------------------

def activity(events: DataFrame) -> DataFrame:
    """Events added up per session, identity, event kind, terminal and model or tool.

    Only numbers are aggregated and all text is in the key, so this is a hash
    aggregation that combines in the map tasks; a session that holds much of the
    data shrinks to a few rows per task before the shuffle. Sessions, users, the
    keys of model filters and the quality report all start from these rows: written
    once (``stage``), they replace further scans of the events.
    """
    numbered = "event_id" in events.columns
    sent = [SENT_PRACTICE] if SENT_PRACTICE in events.columns else []
    position = [F.min("event_id").alias("first_event")] if numbered else []
    kind = F.col("event_name")
    detail = (F.when(kind == API_REQUEST, F.col("model"))
              .when(kind == TOOL_RESULT, F.col("tool_name")).otherwise(F.lit("")))
    return events.groupBy(
        "session_id", *_IDENTITY, *sent, "event_name", "terminal_type", detail.alias("detail"),
    ).agg(
        F.count("*").alias("events"),
        F.min("timestamp").alias("first_at"),
        F.max("timestamp").alias("last_at"),
        F.sum("total_tokens").alias("tokens"),
        F.sum("cached_tokens").alias("cached"),
        F.sum("cost_usd").alias("cost"),
        F.sum("duration_ms").alias("duration"),
        F.sum("prompt_length").alias("prompt"),
        F.count_if("success").alias("successes"),
        F.count_if(F.col("timestamp").isNull()).alias("undated"),
        *[F.count_if(F.col(c) == "").alias(f"blank_{c}") for c in ("model", "tool_name")],
        *[F.count_if(F.col(c) < 0).alias(f"negative_{c}") for c in NEGATIVE_CHECKED],
        *position,
    )


def request_keys(rows: DataFrame) -> DataFrame:
    """The sessions and users that requests of each practice and model occur in, from
    ``activity``: what a model filter looks up instead of the requests themselves."""
    return rows.where(F.col("event_name") == API_REQUEST).select(
        "session_id", "user_id", "practice", F.col("detail").alias("model")).distinct()


def _event_position(rows: DataFrame) -> Column:
    """Sorts activity rows by their first event, in the order events are numbered."""
    if "first_event" in rows.columns:
        return F.col("first_event")
    if SENT_PRACTICE not in rows.columns:
        raise ValueError("events need event_id, or the practice they were sent with, "
                         "to tell which one comes first")
    return F.struct(
        F.col("first_at").isNull(), "first_at", "session_id", "event_name",
        "user_id", "email", "organization_id", SENT_PRACTICE)


# --- one row per key from activity -------------------------------------------------

def _of(kind: str, value: str) -> Column:
    total = F.sum(F.when(F.col("event_name") == kind, F.col(value)))
    return F.coalesce(total, F.lit(0))


def _mean_of(kind: str, value: str) -> Column:
    return ratio_or(_of(kind, value), _of(kind, "events"), 0.0)


def _habits(rows: DataFrame, key: str) -> DataFrame:
    """Most frequent terminal, model and tool per key, and how many models and tools.

    Values are added up first, per key and value, and the winner is picked among the
    counts: no task ever holds the value table of a whole group.
    """
    kind = F.col("event_name")
    trait = F.when(kind == API_REQUEST, "model").when(kind == TOOL_RESULT, "tool")
    seen = rows.select(key, "events", F.explode(F.array(
        F.struct(F.lit("terminal").alias("trait"), F.col("terminal_type").alias("value")),
        F.struct(trait.alias("trait"), F.col("detail").alias("value")),
    )).alias("seen")).select(key, "events", "seen.*").where(F.col("trait").isNotNull())
    counts = seen.groupBy(key, "trait", "value").agg(F.sum("events").alias("n"))

    def usual(name: str) -> Column:
        return most_frequent(F.when(F.col("trait") == name, F.col("value")), F.col("n"))

    return counts.groupBy(key).agg(
        usual("terminal").alias("terminal"),
        usual("model").alias("model"),
        usual("tool").alias("tool"),
        F.count_if(F.col("trait") == "model").alias("models"),
        F.count_if(F.col("trait") == "tool").alias("tools"),
    )


# --- sessions --------------------------------------------------------------------

def session_event_counts(events: DataFrame) -> DataFrame:
    """Events per session and kind, whatever kinds there are: the complete crosstab."""
    return events.groupBy("session_id", "event_name").agg(F.count("*").alias("event_count"))


def session_event_crosstab(events: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Events per session and kind as columns. The five known kinds by default, all others
    together in ``count_other``; pass ``names`` for columns of their own. A kind that never
    occurs is a column of zeros."""
    names = EVENT_NAMES if names is None else names
    kind = F.when(F.col("event_name").isin(names), F.col("event_name")).otherwise(_OTHER)
    counted = events.withColumn("event_name", kind).groupBy("session_id").pivot(
        "event_name", [*names, _OTHER]).agg(F.count(F.lit(1)))
    labels = [F.coalesce(F.col(f"`{n}`"), F.lit(0)).alias(
        f"count_{n}" if n in EVENT_NAMES else n) for n in names]
    return counted.select("session_id", *labels,
                          F.coalesce(F.col(f"`{_OTHER}`"), F.lit(0)).alias("count_other"))


def sessions(events: DataFrame) -> DataFrame:
    """One row per session, from enriched events, which are read once: their activity is
    written to the shared folder first."""
    return sessions_of(stage(activity(events), "activity"))


def sessions_of(rows: DataFrame) -> DataFrame:
    """One row per session, from the written ``activity`` of enriched events."""
    at = _event_position(rows)
    base = rows.groupBy("session_id").agg(
        *[first_filled(F.col(c), at).alias(c) for c in _IDENTITY],
        F.min("first_at").alias("session_start"),
        F.max("last_at").alias("session_end"),
        F.sum("events").alias("total_events"),
        *[_of(n, "events").alias(f"count_{n}") for n in EVENT_NAMES],
        F.coalesce(F.sum(F.when(~F.col("event_name").isin(EVENT_NAMES), F.col("events"))),
                   F.lit(0)).alias("count_other"),
        _of(API_REQUEST, "tokens").alias("session_total_tokens"),
        _of(API_REQUEST, "cached").alias("session_cached_tokens"),
        _of(API_REQUEST, "cost").alias("session_total_cost_usd"),
        _mean_of(API_REQUEST, "duration").alias("avg_api_duration_ms"),
        _mean_of(TOOL_RESULT, "successes").alias("tool_success_rate"),
        _mean_of(TOOL_RESULT, "duration").alias("avg_tool_duration_ms"),
        _mean_of(USER_PROMPT, "prompt").alias("avg_prompt_length"),
    )
    start, end = F.col("session_start"), F.col("session_end")
    minutes = minutes_between(start, end)
    return base.join(_habits(rows, "session_id"), "session_id").select(
        "session_id", "user_id", "email", "full_name",
        *[or_unknown(F.col(c)).alias(c) for c in ("practice", "level", "location")],
        or_unknown(F.col("terminal")).alias("terminal_type"),
        "organization_id", "session_start", "session_end", "total_events",
        minutes.alias("session_duration_minutes"),
        seconds_between(start, end).alias("session_duration_seconds"),
        *[f"count_{n}" for n in EVENT_NAMES], "count_other",
        "session_total_tokens", "session_cached_tokens", "session_total_cost_usd",
        "avg_api_duration_ms",
        F.col("models").alias("unique_models"),
        or_unknown(F.col("model")).alias("primary_model"),
        "tool_success_rate", "avg_tool_duration_ms",
        F.col("tools").alias("unique_tools"),
        or_unknown(F.col("tool")).alias("most_used_tool"),
        "avg_prompt_length",
        (F.col("tool_success_rate") * 100.0).alias("tool_success_rate_pct"),
        ratio_or(F.col("total_events"), minutes, F.col("total_events"))
        .alias("events_per_minute"),
    )


# --- users -----------------------------------------------------------------------

def users(events: DataFrame, session_table: DataFrame) -> DataFrame:
    """One row per user. A session counts for the user who comes first in it."""
    return users_of(stage(activity(events), "activity"), session_table)


def users_of(rows: DataFrame, session_table: DataFrame) -> DataFrame:
    """The same from the written ``activity`` of enriched events."""
    at = _event_position(rows)
    base = rows.groupBy("user_id").agg(
        *[first_filled(F.col(c), at).alias(c) for c in _IDENTITY if c != "user_id"],
        F.min("first_at").alias("first_seen"),
        F.max("last_at").alias("last_seen"),
        F.sum("events").alias("total_events"),
        _of(API_REQUEST, "events").alias("total_api_requests"),
        _of(API_REQUEST, "tokens").alias("total_tokens"),
        _of(API_REQUEST, "cached").alias("total_cached_tokens"),
        _of(API_REQUEST, "cost").alias("total_cost_usd"),
        _mean_of(API_REQUEST, "duration").alias("avg_api_duration_ms"),
        _of(TOOL_RESULT, "events").alias("total_tool_runs"),
        _mean_of(TOOL_RESULT, "successes").alias("tool_success_rate"),
    )
    owned = session_table.groupBy("user_id").agg(
        F.count("*").alias("total_sessions"),
        F.avg("session_duration_minutes").alias("avg_session_duration_minutes"),
        F.avg("total_events").alias("avg_events_per_session"),
    )
    joined = (base.join(_habits(rows, "user_id"), "user_id")
              .join(owned, "user_id", "left"))
    return joined.select(
        "user_id", "email",
        *[or_unknown(F.col(c)).alias(c) for c in ("full_name", "practice", "level",
                                                  "location")],
        "organization_id", or_unknown(F.col("terminal")).alias("terminal_type"),
        "first_seen", "last_seen", "total_events",
        F.coalesce("total_sessions", F.lit(0)).alias("total_sessions"),
        *[F.coalesce(c, F.lit(0.0)).alias(c)
          for c in ("avg_session_duration_minutes", "avg_events_per_session")],
        "total_api_requests", "total_tokens", "total_cached_tokens", "total_cost_usd",
        "avg_api_duration_ms", or_unknown(F.col("model")).alias("preferred_model"),
        "total_tool_runs", "tool_success_rate",
        or_unknown(F.col("tool")).alias("favorite_tool"),
        (F.col("tool_success_rate") * 100.0).alias("tool_success_rate_pct"),
    )
