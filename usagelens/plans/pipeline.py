"""Log files and employee list to curated tables, report and exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from usagelens.operators import marts
from usagelens.operators.enrich import enrich, is_small
from usagelens.operators.numbering import number_events
from usagelens.operators.quality import kinds_of, report
from usagelens.operators.standardize import conform, count_copies, derive, summarize_copies
from usagelens.plans.tables import REQUEST_KEYS, Curated, add_to_catalog, table_path
from usagelens.schemas import NUMERIC_COLUMNS
from usagelens.session import new_path, remove_staged, side_by_side, stage
from usagelens.sources.employees import duplicate_keys, read_employees
from usagelens.sources.logs import accepted, decode_batches, ingest, read_log_batches, set_aside
from usagelens.sources.sinks import (
    export_views, write_decoded, write_raw_events, write_report, write_table,
)


def run(spark: SparkSession, logs: str, employees: str, folder: str,
        strict: bool = True, database: str | None = None) -> Curated:
    """The whole batch run. Flat events are written first and read back.

    With ``strict=False`` malformed lines and messages do not stop the run: they are written
    beside the events (``ingested/outcome=line`` and ``outcome=message``), in the same pass,
    and counted in the report. With ``database`` the tables are named in the catalog, with
    column statistics, and the ones returned are read through it.
    """
    rejects = None
    if strict:
        raw_path = table_path(folder, "raw_events")
        write_raw_events(ingest(spark, logs), raw_path)
        raw = spark.read.parquet(raw_path)
    else:
        found = decode_batches(read_log_batches(spark, logs, strict=False))
        decoded = write_decoded(found, table_path(folder, "ingested"))
        raw, rejects = accepted(decoded), set_aside(decoded)
    tables = save_curated(raw, read_employees(spark, employees), folder, rejects=rejects)
    if database:
        tables = add_to_catalog(spark, folder, database)
    export_views(tables, table_path(folder, "metrics"))
    return tables


def save_curated(raw: DataFrame, employees: DataFrame | None, folder: str,
                 partition_events_by: str | None = None,
                 rejects: DataFrame | None = None) -> Curated:
    """Write the five tables, the keys of requests and the report.

    Raw events are read and de-duplicated once: how often each row was delivered is carried
    along until the report has counted it. Saved events lie in time order, file by file, so
    time filters skip whole files, and a session's events sit in one or two of them. They are
    read three times: for requests, for tool results, and to be added up into ``activity``,
    from which sessions, users, request keys and the report all come. What is staged on the
    way is removed.
    """
    spark = raw.sparkSession
    staged = {name: new_path(spark, name) for name in ("numbered", "employees", "activity")}
    if employees is not None:
        # Written once: read by the join and the report, and of known size.
        employees = stage(employees, "employees", staged["employees"])
    counted = count_copies(conform(raw)).na.fill(0.0, NUMERIC_COLUMNS)
    numbered = number_events(counted, path=staged["numbered"])
    enriched = _in_time_order(derive(numbered.drop("copies")), employees)
    events = write_table(enriched, folder, "events", partition_events_by)
    api, tools, rows = side_by_side(
        spark,
        lambda: write_table(marts.api_requests(events), folder, "api_requests"),
        lambda: write_table(marts.tool_results(events), folder, "tool_results"),
        lambda: stage(marts.activity(events), "activity", staged["activity"]))
    sessions, keys = side_by_side(
        spark,
        lambda: write_table(marts.sessions_of(rows), folder, "sessions"),
        lambda: write_table(marts.request_keys(rows), folder, REQUEST_KEYS))
    users = write_table(marts.users_of(rows, sessions), folder, "users")
    doubled = None if employees is None or "email" not in employees.columns else duplicate_keys(employees)
    write_report(report(summarize_copies(numbered), rows, sessions, users, rejects, doubled),
                 table_path(folder, "data_quality_report"))
    kinds_of(rows).write.mode("overwrite").json(table_path(folder, "event_name_distribution"))
    for path in staged.values():
        remove_staged(spark, path)
    return Curated(events=lambda: events, api_requests=lambda: api, tool_results=lambda: tools,
                   sessions=lambda: sessions, users=lambda: users, request_keys=lambda: keys)


def _in_time_order(events: DataFrame, employees: DataFrame | None) -> DataFrame:
    """Enriched events, each task's in the order of their numbers and tasks one after the other.

    Numbered events are read in that order, and a broadcast list leaves it alone. A larger
    list is joined by shuffling, which mixes events by email: they are placed again.
    """
    if employees is None:
        return enrich(events, None)
    if is_small(employees):
        return enrich(events, F.broadcast(employees))
    return enrich(events, employees).repartitionByRange("event_id").sortWithinPartitions("event_id")
