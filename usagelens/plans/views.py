"""The registry of analytics views over the curated tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.functions import ratio_or, round_to
from usagelens.plans.tables import Curated
from usagelens.schemas import API_ERROR

# Lengths of the ranked views.
TOP_USERS = 15
TOP_SESSIONS = 20


def _named(column: str):
    return F.col(column).isNotNull() & (F.col(column) != "")


def _sum(column: str, digits: int):
    return round_to(F.sum(column), digits)


def _mean(column: str, digits: int):
    return round_to(F.avg(column), digits)


def overview(t: Curated) -> DataFrame:
    """One row. Each figure is a scalar subquery; Spark merges those over one table."""
    def figure(df: DataFrame, value, digits: int | None = None):
        cell = df.agg(value).scalar()
        return cell if digits is None else round_to(F.coalesce(cell, F.lit(0.0)), digits)

    count = F.count("*")
    return t.events.sparkSession.range(1).select(
        figure(t.events, count).alias("total_events"),
        figure(t.api_requests, count).alias("total_api_requests"),
        figure(t.tool_results, count).alias("total_tool_results"),
        figure(t.sessions, count).alias("total_sessions"),
        figure(t.users, count).alias("total_users"),
        figure(t.api_requests, F.sum("total_tokens"), 0).alias("total_tokens"),
        figure(t.api_requests, F.sum("cost_usd"), 2).alias("total_cost_usd"),
        figure(t.sessions, F.avg("session_duration_minutes"), 2)
        .alias("avg_session_duration_minutes"),
        figure(t.sessions, F.avg("session_total_tokens"), 2).alias("avg_tokens_per_session"),
        figure(t.sessions, F.avg("session_total_cost_usd"), 4).alias("avg_cost_per_session"),
    )


def token_usage_by_practice(t: Curated) -> DataFrame:
    return t.api_requests.groupBy("practice").agg(
        F.count("*").alias("api_requests"),
        _sum("total_tokens", 0).alias("total_tokens"),
        _sum("cost_usd", 2).alias("total_cost_usd"),
        _mean("total_tokens", 2).alias("avg_tokens_per_request"),
    ).orderBy(F.desc("total_tokens"), "practice")


def cost_by_model(t: Curated) -> DataFrame:
    return t.api_requests.where(_named("model")).groupBy("model").agg(
        F.count("*").alias("api_requests"),
        _sum("cost_usd", 2).alias("total_cost_usd"),
        _sum("total_tokens", 0).alias("total_tokens"),
        _mean("cost_usd", 4).alias("avg_cost_per_request"),
    ).orderBy(F.desc("total_cost_usd"), "model")


def _events_by(t: Curated, *keys: str) -> DataFrame:
    return (t.events.groupBy(*keys).agg(F.count("*").alias("event_count"))
            .orderBy(*[F.asc_nulls_last(k) for k in keys]))


def usage_by_hour(t: Curated) -> DataFrame:
    return _events_by(t, "hour")


def usage_by_weekday(t: Curated) -> DataFrame:
    return _events_by(t, "weekday_num", "weekday")


def daily_usage(t: Curated) -> DataFrame:
    return _events_by(t, "event_date")


def sessions_by_practice(t: Curated) -> DataFrame:
    return t.sessions.groupBy("practice").agg(
        F.count("*").alias("total_sessions"),
        _mean("session_duration_minutes", 2).alias("avg_session_duration_minutes"),
        _mean("session_total_tokens", 2).alias("avg_tokens_per_session"),
        _sum("session_total_cost_usd", 2).alias("total_cost_usd"),
    ).orderBy(F.desc("total_sessions"), "practice")


def _top_users(t: Curated, measure: str) -> DataFrame:
    # Ranked by the rounded figure shown; equal figures by user id.
    return t.users.select(
        "user_id", "full_name", "email", "practice", "level", "location", "total_sessions",
        round_to(F.col("total_tokens"), 0).alias("total_tokens"),
        round_to(F.col("total_cost_usd"), 2).alias("total_cost_usd"),
        "preferred_model", "favorite_tool",
    ).orderBy(F.desc(measure), "user_id").limit(TOP_USERS)


def top_users_by_tokens(t: Curated) -> DataFrame:
    return _top_users(t, "total_tokens")


def top_users_by_cost(t: Curated) -> DataFrame:
    return _top_users(t, "total_cost_usd")


def error_rate_by_model(t: Curated) -> DataFrame:
    """Errors per request. A model with errors but no request is not listed.

    Both sides are grouped before the join, so it joins one row per model.
    """
    requests = (t.api_requests.where(_named("model")).groupBy("model")
                .agg(F.count("*").alias("api_requests")))
    errors = (t.events.where((F.col("event_name") == API_ERROR) & _named("model"))
              .groupBy("model").agg(F.count("*").alias("api_errors")))
    api_errors = F.coalesce("api_errors", F.lit(0))
    rate = api_errors.cast("double") * 100.0 / F.nullif("api_requests", F.lit(0))
    return requests.join(errors, "model", "left").select(
        "model", "api_requests", api_errors.alias("api_errors"),
        round_to(rate, 2).alias("error_rate_pct"),
    ).orderBy(F.desc("error_rate_pct"), F.desc("api_requests"), "model")


def tool_performance(t: Curated) -> DataFrame:
    return t.tool_results.where(_named("tool_name")).groupBy("tool_name").agg(
        F.count("*").alias("total_runs"),
        round_to(ratio_or(F.count_if("success"), F.count("*"), 0.0) * 100.0, 2)
        .alias("success_rate_pct"),
        _mean("duration_ms", 2).alias("avg_duration_ms"),
    ).orderBy(F.desc("total_runs"), "tool_name")


def session_outliers(t: Curated) -> DataFrame:
    return t.sessions.select(
        "session_id", "user_id", "full_name", "practice", "level", "session_start",
        "session_duration_minutes", "session_total_tokens", "session_total_cost_usd",
        "primary_model", "most_used_tool",
    ).orderBy(F.desc("session_total_tokens"), "session_id").limit(TOP_SESSIONS)


VIEWS = {
    view.__name__: view for view in (
        overview, token_usage_by_practice, cost_by_model, usage_by_hour, usage_by_weekday,
        daily_usage, sessions_by_practice, top_users_by_tokens, top_users_by_cost,
        error_rate_by_model, tool_performance, session_outliers,
    )
}


def view_counts(tables: Curated) -> DataFrame:
    """How many rows each view has."""
    parts = [view(tables).agg(F.count("*").alias("row_count"))
             .select(F.lit(name).alias("view_name"), "row_count")
             for name, view in VIEWS.items()]
    return reduce(DataFrame.unionByName, parts)


def register_views(tables: Curated) -> None:
    """Make every view available to SQL as ``analytics_<name>``."""
    for name, view in VIEWS.items():
        view(tables).createOrReplaceTempView(f"analytics_{name}")
