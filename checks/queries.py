"""Every operator run over the whole given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import cached_property, lru_cache, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from usagelens.functions import round_to
from usagelens.operators import batches, marts, quality
from usagelens.operators.enrich import SENT_PRACTICE, enrich
from usagelens.operators.numbering import number_events
from usagelens.operators.standardize import (
    clean, conform, derive, missing_columns, redelivery_summary, standardize,
)
from usagelens.plans import explore, tables, views
from usagelens.plans.pipeline import run, save_curated
from usagelens.schemas import (
    EMPLOYEE_COLUMNS, ENVELOPE, EVENT_NAMES, MISSING_CHECKED, NEGATIVE_CHECKED, NULL_CHECKED,
    RAW_COLUMNS,
)
from usagelens.session import configure, new_path
from usagelens.sources import logs, sinks
from usagelens.sources.employees import duplicate_keys, read_employees
from checks import sample

#: The choice every filtered query is run with.
PRACTICES = ["BUILDING", "MACHINERY"]
MODELS = ["model-1", "model-3"]


def _settled(df: DataFrame) -> DataFrame:
    """Comparable output: fractions to six places (a sum of doubles depends on the
    order of its terms in the last bits) and times without a zone, in UTC."""
    changes = {}
    for field in df.schema.fields:
        if isinstance(field.dataType, T.DoubleType):
            changes[field.name] = round_to(F.col(field.name), 6)
        elif isinstance(field.dataType, T.TimestampType):
            changes[field.name] = F.col(field.name).cast("timestamp_ntz")
    return df.withColumns(changes) if changes else df


def _beside(df: DataFrame, one: DataFrame) -> DataFrame:
    """``df`` with the columns of a single row."""
    cell = one.select(F.struct("*")).scalar()
    return df.withColumn("_one", cell).select(*df.columns, "_one.*")


class _Inputs:
    """The plans queries start from. Plans only: every query computes its own rows."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        self.raw = sample.raw_events(spark, sf_dir)
        self.employees = sample.employees(spark, sf_dir)

    @cached_property
    def conformed(self) -> DataFrame:
        return conform(self.raw)

    @cached_property
    def standard(self) -> DataFrame:
        return standardize(self.raw)

    @cached_property
    def enriched(self) -> DataFrame:
        return enrich(self.standard, self.employees, keep_sent_practice=True)

    @property
    def tables(self) -> tables.Curated:
        # New ones for each query, so that none uses what another has written.
        return tables.build_tables(self.raw, self.employees)

    @property
    def filtered(self) -> tables.Curated:
        return explore.apply_filters(self.tables, PRACTICES, MODELS)


def _ingest_flatten(i: _Inputs) -> DataFrame:
    path = new_path(i.spark, "log_batches")
    logs.write_log_batches(batches.pack_batches(i.raw), path)
    return logs.ingest(i.spark, path)


def _pack_log_batches(i: _Inputs) -> DataFrame:
    packed = batches.pack_batches(i.raw)

    def listed(value) -> F.Column:
        return F.array_join(F.transform("logEvents", value), ",", "none")

    return packed.select(
        "batch_id", "messageType", F.size("logEvents").cast("bigint").alias("event_count"),
        "year", "month", "day",
        listed(lambda e: e["id"]).alias("ids"),
        listed(lambda e: e["timestamp"].cast("string")).alias("times"),
        listed(lambda e: F.get_json_object(e["message"], "$.attributes['session.id']"))
        .alias("session_ids"),
        listed(lambda e: F.get_json_object(e["message"], "$.body")).alias("bodies"),
    )


_STANDARD = [
    "timestamp", *[c for c in RAW_COLUMNS if c != "timestamp"],
    "total_tokens", "cached_tokens", "total_token_footprint", "duration_seconds",
    "has_model", "has_tool", "is_api_request", "is_tool_result", "is_error",
]
_CALENDAR = [
    "session_id", "event_name", "timestamp", "event_date", "year", "month", "month_label",
    "hour", "weekday_num", "weekday", "is_weekend", "is_business_hour",
]


def _dedupe_count(i: _Inputs) -> DataFrame:
    return redelivery_summary(i.conformed).select(
        "raw_row_count", "clean_row_count", "duplicate_rows_removed")


def _event_numbering(i: _Inputs) -> DataFrame:
    return number_events(clean(i.raw)).select(
        "event_id", "timestamp", "session_id", "event_name", "model", "tool_name",
        "input_tokens", "cost_usd", "duration_ms")


def _event_preview(i: _Inputs) -> DataFrame:
    events = enrich(derive(number_events(clean(i.raw))), i.employees)
    return explore.event_preview(
        explore.apply_filters(tables.curate(events), PRACTICES, MODELS))


def _report_fields(report: DataFrame) -> DataFrame:
    """Every field of the report as a column, whether it comes from a plan or a file."""
    def group(name: str, prefix: str, columns: list[str]):
        return [F.col(f"validation.{name}.{c}").alias(f"{prefix}_{c}") for c in columns]

    return report.select(
        "summary.*",
        F.array_join("validation.required_columns_present", ",").alias("required_columns"),
        F.array_join("validation.known_event_names", ",").alias("known_event_names"),
        *[F.coalesce(F.col("validation.event_name_distribution")[n], F.lit(0).cast("bigint"))
          .alias(f"events_{n}") for n in [*EVENT_NAMES, quality.OTHER_KINDS]],
        *group("null_counts", "null", NULL_CHECKED),
        *group("blank_counts", "blank", [c for c in NULL_CHECKED if c != "timestamp"]),
        *group("negative_numeric_counts", "negative", NEGATIVE_CHECKED),
        *[F.col(f"validation.missing_{c}_count") for c in MISSING_CHECKED],
    )


def _quality_report(i: _Inputs) -> DataFrame:
    t = i.tables
    return _report_fields(quality.quality_report(
        i.conformed, t.events, t.sessions, t.users, duplicate_keys=duplicate_keys(i.employees)))


def _employees_from_csv(i: _Inputs) -> DataFrame:
    """An awkward CSV written to the shared folder and read back."""
    path, email = new_path(i.spark, "employees"), F.col("email")
    awkward = i.employees.withColumns({
        "full_name": F.concat("full_name", F.when(email.contains("7@"), ' "the boss", x').when(
            email.contains("3@"), "\nsecond line").otherwise("")),
        "level": F.when(email.contains("5@"), "N/A").otherwise(F.col("level"))})
    awkward.write.csv(path, header=True, escape='"')
    return read_employees(i.spark, path).select(*EMPLOYEE_COLUMNS)


def _stored_events(i: _Inputs) -> DataFrame:
    path = new_path(i.spark, "raw-events")
    sinks.write_raw_events(i.raw, path)
    return i.spark.read.parquet(path).groupBy("event_name").agg(F.count("*").alias("event_count"))


def _report_from_json(i: _Inputs) -> DataFrame:
    """The report of a saved run, read back from its file."""
    folder = new_path(i.spark, "curated")
    save_curated(i.raw, i.employees, folder)
    # Longs as such, and kinds that did not occur as absent entries.
    t = i.tables
    report = quality.quality_report(i.conformed, t.events, t.sessions, t.users)
    return _report_fields(i.spark.read.schema(report.schema).json(f"{folder}/data_quality_report"))


def _logs_with_bad_lines(i: _Inputs) -> str:
    """The given events as log files: the line of every tenth batch is cut short, and a
    message of every eighth of the others."""
    path = new_path(i.spark, "bad_logs")
    whole = F.to_json(F.struct(*ENVELOPE.names))
    torn = F.col("batch_id") % 10 == 3
    spoilt = F.col("batch_id") % 8 == 5
    first = F.transform("logEvents", lambda e, n: F.when(n == 0, F.struct(
        e["id"].alias("id"), e["timestamp"].alias("timestamp"), F.lit("{not json").alias("message"))).otherwise(e))
    lines = batches.pack_batches(i.raw).withColumn("logEvents", F.when(spoilt, first).otherwise(F.col("logEvents"))).select(
        F.when(torn, F.concat(F.lit("{torn "), F.col("batch_id").cast("string"))).otherwise(whole).alias("value"))
    lines.write.text(path)
    return path


def _lenient_run(i: _Inputs) -> DataFrame:
    """A whole run over files with bad lines and messages: what it kept and set aside."""
    path = _logs_with_bad_lines(i)
    folder, staff = new_path(i.spark, "lenient"), new_path(i.spark, "staff")
    i.employees.write.csv(staff, header=True)
    t = run(i.spark, path, staff, folder, strict=False)
    summary = _report_fields(i.spark.read.json(f"{folder}/data_quality_report")).select(
        "raw_row_count", "clean_row_count", "rejected_lines", "rejected_messages")
    found = i.spark.read.parquet(f"{folder}/ingested").where("outcome <> 'event'").agg(
        F.count_if(F.col("outcome") == "line").alias("lines_kept"),
        F.min("text").alias("first_text"), F.max("text").alias("last_text"))
    total = t.events.agg(F.count("*").alias("saved_events"))
    return _beside(_beside(summary, found), total)


def _rejected_rows(i: _Inputs) -> DataFrame:
    path = _logs_with_bad_lines(i)
    found = logs.rejected(logs.read_log_batches(i.spark, path, strict=False))
    return found.groupBy("reason", "text").agg(F.count("*").alias("rows"))


def _saved(i: _Inputs) -> tuple[str, tables.Curated]:
    folder = new_path(i.spark, "curated")
    return folder, save_curated(i.raw, i.employees, folder)


def _exported(i: _Inputs, view: str) -> DataFrame:
    """A view's exported CSV, read back with the view's own types."""
    folder, saved = _saved(i)
    sinks.export_view(saved, view, f"{folder}/metrics")
    return i.spark.read.schema(views.VIEWS[view](saved).schema).option("timeZone", "UTC").csv(
        f"{folder}/metrics/{view}", header=True)


def _overview_from_json(i: _Inputs) -> DataFrame:
    folder, saved = _saved(i)
    sinks.export_view(saved, "overview", f"{folder}/metrics")
    return i.spark.read.schema(views.overview(saved).schema).json(f"{folder}/metrics/overview_json")


def _catalog_statistics(i: _Inputs) -> DataFrame:
    """What the catalog knows of the saved tables' columns after a run."""
    folder, _ = _saved(i)
    database = f"run_{uuid.uuid4().hex[:8]}"
    tables.add_to_catalog(i.spark, folder, database)
    return reduce(DataFrame.unionByName, [
        tables.column_statistics(i.spark, database, name, column)
        for name, column in (("events", "event_id"), ("events", "input_tokens"), ("api_requests", "duration_ms"),
                             ("sessions", "total_events"), ("users", "total_sessions"))])


def _view_from_catalog(i: _Inputs) -> DataFrame:
    folder, _ = _saved(i)
    return views.error_rate_by_model(
        tables.add_to_catalog(i.spark, folder, f"run_{uuid.uuid4().hex[:8]}"))


def _kept_tables(i: _Inputs) -> DataFrame:
    """Tables kept for interactive use: counted, then asked for a second figure."""
    folder, _ = _saved(i)
    kept = tables.read_tables(i.spark, folder).persist()
    return _beside(tables.table_counts(kept), tables.run_totals(kept))


def _missing_columns(i: _Inputs) -> DataFrame:
    """The required columns that cut-down events lack, and how many events that concerns."""
    cut = i.raw.drop("email", "user_id", "timestamp", "model")
    lacking = F.array(*[F.lit(c) for c in missing_columns(cut)])
    return cut.agg(F.count("*").alias("events")).select(F.explode(lacking).alias("missing_column"), "events")


def _request_keys(i: _Inputs) -> DataFrame:
    folder, _ = _saved(i)
    return tables.read_tables(i.spark, folder).request_keys.groupBy("practice", "model").agg(
        F.count_distinct("session_id").alias("sessions"), F.count_distinct("user_id").alias("users"))


def _whole_distribution(i: _Inputs) -> DataFrame:
    folder, _ = _saved(i)
    return i.spark.read.json(f"{folder}/event_name_distribution")


def _duplicate_employees(i: _Inputs) -> DataFrame:
    """Everyone listed twice under an email that former and present employees share."""
    shared = i.employees.withColumn("email", F.regexp_replace("email", "^(former|user)([0-9]).*@", "$2@"))
    return duplicate_keys(shared)


def _padded_columns(i: _Inputs) -> DataFrame:
    """Blanks around column names, and an optional column that is not there."""
    raw = i.raw.drop("model")
    return conform(raw.toDF(*[f" {c} " for c in raw.columns])).groupBy("event_name", "model").agg(
        F.sum("input_tokens").alias("input_tokens"))


def _sql_view(i: _Inputs) -> DataFrame:
    views.register_views(i.tables)
    return i.spark.sql("SELECT * FROM analytics_cost_by_model")


def _saved_overview(i: _Inputs) -> DataFrame:
    """Write every table and the report, then read the overview from the files."""
    folder = new_path(i.spark, "curated")
    save_curated(i.raw, i.employees, folder)
    return views.overview(tables.read_tables(i.spark, folder))


def _saved_filtered_kpis(i: _Inputs) -> DataFrame:
    folder = new_path(i.spark, "curated")
    save_curated(i.raw, i.employees, folder)
    saved = tables.read_tables(i.spark, folder)
    return explore.kpis(explore.apply_filters(saved, PRACTICES, MODELS))


def _view_counts(i: _Inputs) -> DataFrame:
    folder = new_path(i.spark, "curated")
    save_curated(i.raw, i.employees, folder)
    return views.view_counts(tables.read_tables(i.spark, folder))


_QUERIES: dict[str, Callable[[_Inputs], DataFrame]] = {
    "ingest_flatten": _ingest_flatten,
    "pack_log_batches": _pack_log_batches,
    "standardize_events": lambda i: i.standard.select(*_STANDARD),
    "dedupe_count": _dedupe_count,
    "event_numbering": _event_numbering,
    "calendar_features": lambda i: i.standard.select(*_CALENDAR),
    "enrich_employees": lambda i: i.enriched.select(
        "session_id", "event_name", "timestamp", *EMPLOYEE_COLUMNS),
    "practice_resolution": lambda i: i.enriched.select(
        "session_id", "event_name", "timestamp", "email", SENT_PRACTICE, "practice"),
    "api_requests": lambda i: i.tables.api_requests.select(
        "timestamp", "session_id", "user_id", "email", "practice", "model", "input_tokens",
        "output_tokens", "total_tokens", "cached_tokens", "total_token_footprint",
        "cost_usd", "duration_ms", "cost_per_1k_tokens", "cache_ratio"),
    "tool_results": lambda i: i.tables.tool_results.select(
        "timestamp", "session_id", "user_id", "practice", "tool_name", "success",
        "duration_ms", "duration_seconds"),
    "session_event_crosstab": lambda i: marts.session_event_crosstab(i.standard),
    "session_event_counts": lambda i: marts.session_event_counts(i.standard),
    "employees_from_csv": _employees_from_csv,
    "stored_events": _stored_events,
    "report_from_json": _report_from_json,
    "lenient_run": _lenient_run,
    "rejected_rows": _rejected_rows,
    "csv_daily_usage": lambda i: _exported(i, "daily_usage"),
    "csv_top_users_by_cost": lambda i: _exported(i, "top_users_by_cost"),
    "csv_tool_performance": lambda i: _exported(i, "tool_performance"),
    "overview_from_json": _overview_from_json,
    "catalog_statistics": _catalog_statistics,
    "view_from_catalog": _view_from_catalog,
    "kept_tables": _kept_tables,
    "missing_columns": _missing_columns,
    "request_keys": _request_keys,
    "whole_distribution": _whole_distribution,
    "duplicate_employees": _duplicate_employees,
    "enrich_without_list": lambda i: enrich(i.standard, None).select(
        "session_id", "event_name", "practice", "full_name"),
    "padded_columns": _padded_columns,
    "sql_cost_by_model": _sql_view,
    "sessions": lambda i: i.tables.sessions,
    "users": lambda i: i.tables.users,
    "quality_summary": lambda i: redelivery_summary(i.conformed),
    "quality_event_distribution": lambda i: quality.event_distribution(i.standard),
    "quality_counts": lambda i: quality.column_counts(i.tables.events),
    "quality_report": _quality_report,
    **{name: (lambda i, view=view: view(i.tables)) for name, view in views.VIEWS.items()},
    "table_counts": lambda i: tables.table_counts(i.tables),
    "run_totals": lambda i: tables.run_totals(i.tables),
    "saved_overview": _saved_overview,
    "view_counts": _view_counts,
    "saved_filtered_kpis": _saved_filtered_kpis,
    "filter_options": lambda i: explore.filter_options(i.tables),
    "filtered_kpis": lambda i: explore.kpis(i.filtered),
    "filtered_kpi_texts": lambda i: explore.kpi_texts(i.filtered),
    "insights": lambda i: explore.insights(i.filtered),
    "filtered_tokens_by_practice": lambda i: explore.tokens_by_practice(i.filtered),
    "filtered_cost_by_model": lambda i: explore.cost_by_model(i.filtered),
    "filtered_usage_by_hour": lambda i: explore.usage_by_hour(i.filtered),
    "filtered_daily_usage": lambda i: explore.daily_usage(i.filtered),
    "filtered_weekday": lambda i: explore.usage_by_weekday(i.filtered),
    "filtered_tool_performance": lambda i: explore.tool_performance(i.filtered),
    "filtered_top_tools": lambda i: explore.top_tools(i.filtered),
    "filtered_error_rate": lambda i: explore.error_rate_by_model(i.filtered),
    "filtered_top_users": lambda i: explore.top_users(i.filtered),
    "filtered_sessions_by_practice": lambda i: explore.sessions_by_practice(i.filtered),
    "filtered_session_outliers": lambda i: explore.session_outliers(i.filtered),
    "event_preview": _event_preview,
    "event_type_counts": lambda i: batches.event_type_totals(i.raw),
    "pseudonymize_users": lambda i: i.employees.select(
        "email", batches.pseudonym(F.col("email")).alias("user_id")),
}


_inputs = lru_cache(maxsize=8)(_Inputs)


def _runnable(build: Callable[[_Inputs], DataFrame]):
    return lambda spark, sf_dir: _settled(build(_inputs(spark, sf_dir)))


QUERIES = {name: _runnable(build) for name, build in _QUERIES.items()}
