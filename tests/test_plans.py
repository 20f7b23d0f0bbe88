"""What the physical plans must and must not contain."""

import pytest
from pyspark.sql import functions as F

from checks.queries import QUERIES
from usagelens.operators import batches, marts
from usagelens.operators.enrich import enrich
from usagelens.operators.standardize import standardize
from usagelens import session
from usagelens.plans import explore, pipeline, tables, views
from checks import sample

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def saved_tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("saved"))
    given = tables.build_tables(sample.raw_events(spark, SF_DIR), sample.employees(spark, SF_DIR))
    for name, df in [*given.items(), (tables.REQUEST_KEYS, given.request_keys)]:
        df.write.parquet(tables.table_path(folder, name))
    return tables.read_tables(spark, folder)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_python_no_global_window_no_cross_join(spark, name):
    plan = _plan(QUERIES[name](spark, SF_DIR))
    for word in ("Python", "Pandas", "Arrow", "CartesianProduct"):
        assert word not in plan
    # The one window is the running total over one row per range partition.
    windows = [line for line in plan.splitlines() if "Window" in line and "WindowGroupLimit" not in line]
    assert all("windowspecdefinition(_part#" in line and "sum(_rows#" in line for line in windows)


def _scans(df, table):
    """How often a saved table is read: scans in the plan and in its subqueries."""
    return sum("FileScan" in line and f"/{table}]" in line for line in _plan(df).splitlines())


def test_sessions_and_users_are_made_from_one_scan_of_the_events(spark, saved_tables, monkeypatch):
    written = []
    keep = session.stage

    def noted(df, name, path=None):
        written.append(_scans(df, "events"))
        return keep(df, name, path)

    for module in (marts, tables):
        monkeypatch.setattr(module, "stage", noted)
    events = saved_tables.events.withColumn("event_id", F.monotonically_increasing_id())
    assert _scans(marts.sessions(events), "events") == 0 and written == [1]
    curated = tables.curate(events)
    assert _scans(curated.sessions, "events") == _scans(curated.users, "events") == 0 and written == [1, 1]


def test_a_saved_run_reads_events_three_times(spark, make_raw, tmp_path, monkeypatch):
    """Every plan that is written is looked at: what reads the events, and how often."""
    plans = []
    write = type(spark.range(1).write)
    for kind in ("parquet", "json"):
        def noted(self, path, *more, original=getattr(write, kind), **named):
            plans.append(_plan(self._df))
            return original(self, path, *more, **named)
        monkeypatch.setattr(write, kind, noted)
    pipeline.save_curated(sample.raw_events(spark, SF_DIR), sample.employees(spark, SF_DIR), str(tmp_path))
    reads = [line for plan in plans for line in plan.splitlines() if "FileScan" in line and f"{tmp_path}/events]" in line]
    assert len(plans) >= 9 and len(reads) == 3


@pytest.mark.parametrize("name,most", [("kpis", 1), ("insights", 1)])
def test_filtered_figures_read_each_table_once(spark, saved_tables, name, most):
    chosen = explore.apply_filters(saved_tables, ["BUILDING", "MACHINERY"], ["model-1", "model-3"])
    figures = getattr(explore, name)(chosen)
    for table in tables.TABLE_NAMES:
        assert _scans(figures, table) <= most, table
    assert _scans(figures, "api_requests") == 1


def test_packing_places_events_once_after_numbering(spark):
    plan = _plan(batches.pack_batches(sample.raw_events(spark, SF_DIR)))
    exchanges = [line for line in plan.splitlines() if "Exchange" in line and "event_type" in line]
    assert "Exchange rangepartitioning(batch_id" in plan
    assert "hashpartitioning(batch_id" not in plan and len(exchanges) <= 1


def test_saved_events_lie_in_time_order_when_the_list_is_joined_by_shuffling(spark, tmp_path):
    raw, staff = sample.raw_events(spark, SF_DIR), sample.employees(spark, SF_DIR)
    off = {"spark.sql.autoBroadcastJoinThreshold": "1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
           "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for key, value in off.items():
        spark.conf.set(key, value)
    try:
        saved = pipeline.save_curated(raw, staff, str(tmp_path)).events
        spans = sorted(tuple(r) for r in saved.groupBy(F.input_file_name()).agg(
            F.min("event_id"), F.max("event_id"), F.count("*")).select(
            "min(event_id)", "max(event_id)", "count(1)").collect())
    finally:
        for key in off:
            spark.conf.unset(key)
    assert len(spans) > 2 and all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
    assert all(high - low + 1 == n for low, high, n in spans)


def test_statistics_of_the_catalog_reach_the_plan(spark, tmp_path):
    raw = sample.raw_events(spark, SF_DIR)
    pipeline.save_curated(raw, None, str(tmp_path))
    named = tables.add_to_catalog(spark, str(tmp_path), "known")
    spark.conf.set("spark.sql.cbo.enabled", "true")
    try:
        whole = named.events.count()
        some = named.events.where("event_id <= 100")._jdf.queryExecution().optimizedPlan().stats()
        assert 90 < int(some.rowCount().get()) < 110 < whole
        grouped = views.cost_by_model(named)._jdf.queryExecution().optimizedPlan().stats()
        assert grouped.rowCount().isDefined()
    finally:
        spark.conf.unset("spark.sql.cbo.enabled")
    again = tables.add_to_catalog(spark, str(tmp_path), "known")  # naming them anew keeps the files
    assert again.events.count() == whole


def test_partitioned_events_are_found_through_the_catalog(spark, make_raw, tmp_path):
    raw = make_raw({}, {"timestamp": "2025-01-08T10:00:00Z"}, {"timestamp": "never"})
    pipeline.save_curated(raw, None, str(tmp_path), partition_events_by="event_date")
    assert tables.add_to_catalog(spark, str(tmp_path), "by_day").events.count() == 3


def test_small_dimension_is_broadcast_and_a_large_one_is_not(spark, tmp_path):
    events = standardize(sample.raw_events(spark, SF_DIR))
    sample.employees(spark, SF_DIR).write.parquet(str(tmp_path / "staff"))
    staff = spark.read.parquet(str(tmp_path / "staff"))
    assert "BroadcastHashJoin" in _plan(enrich(events, staff))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        assert "SortMergeJoin" in _plan(enrich(events, staff))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_activity_is_a_hash_aggregation(spark):
    events = enrich(standardize(sample.raw_events(spark, SF_DIR)), None, keep_sent_practice=True)
    plan = _plan(marts.activity(events))
    assert "SortAggregate" not in plan and "partial_" in plan


def test_views_read_few_columns_and_push_the_filter(spark, tmp_path):
    raw, staff = sample.raw_events(spark, SF_DIR), sample.employees(spark, SF_DIR)
    tables.build_tables(raw, staff).api_requests.write.parquet(str(tmp_path / "api_requests"))
    saved = tables.read_tables(spark, str(tmp_path))
    plan = _plan(views.cost_by_model(saved))
    assert "ReadSchema: struct<model:string,cost_usd:double,total_tokens:double>" in plan
    assert "Not(EqualTo(model,))" in plan


def test_rankings_keep_only_the_top(spark):
    assert "TakeOrderedAndProject" in _plan(QUERIES["top_users_by_cost"](spark, SF_DIR))


@pytest.mark.parametrize("name", [
    "kpis", "tokens_by_practice", "cost_by_model", "usage_by_hour", "daily_usage", "usage_by_weekday",
    "tool_performance", "top_tools", "error_rate_by_model", "top_users", "sessions_by_practice", "session_outliers"])
def test_filters_reach_the_saved_files(spark, saved_tables, name):
    chosen = explore.apply_filters(saved_tables, ["BUILDING", "MACHINERY"], ["model-1", "model-3"])
    plan = _plan(getattr(explore, name)(chosen))
    scans = [line for line in plan.splitlines() if "PushedFilters" in line or "FileScan" in line]
    assert scans and all("In(practice, [BUILDING,MACHINERY])" in s for s in scans)
    assert any("In(model, [model-1,model-3])" in s for s in scans)


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Kolkata"])
def test_days_and_hours_do_not_depend_on_the_session(spark, make_raw, zone):
    raw = make_raw({"timestamp": "2025-01-06T02:30:00Z"}, {"timestamp": "2025-01-06T02:30:00"},
                   {"timestamp": "2025-01-06"}, {"timestamp": "2025-01-06T02:30:00+05:00"})
    columns = ["hour", "weekday", "month_label", "year", "month", "is_weekend"]
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = standardize(raw).selectExpr("unix_micros(timestamp) at", "unix_micros(event_date) day", *columns).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    day = 1_736_121_600_000_000
    assert sorted((r["at"] - day) // 60_000_000 for r in rows) == [-150, 0, 150]
    assert sorted((r["hour"], r["weekday"], (r["day"] - day) // 86_400_000_000) for r in rows) == [
        (0, "Monday", 0), (2, "Monday", 0), (21, "Sunday", -1)]
