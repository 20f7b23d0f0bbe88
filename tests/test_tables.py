"""Curated tables, views and filtered summaries."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from usagelens.operators import marts, quality
from usagelens.operators.enrich import enrich
from usagelens.operators.numbering import number_events
from usagelens.operators.standardize import clean, conform, derive, standardize
from usagelens.plans import explore, tables, views
from checks import sample

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def given(spark):
    return sample.raw_events(spark, SF_DIR), sample.employees(spark, SF_DIR)


@pytest.fixture(scope="module")
def curated(given):
    return tables.build_tables(*given).persist()


def _rows(df):
    rounded = [F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    return sorted(map(str, df.select(*rounded).collect()))


def test_tables_do_not_depend_on_numbers_copies_or_arrival_order(given, curated):
    raw, staff = given
    shuffled = raw.union(raw).repartition(5, "cost_usd").sortWithinPartitions(F.desc("timestamp"))
    numbered = tables.curate(enrich(derive(number_events(clean(raw))), staff))
    again = tables.build_tables(shuffled, staff)
    for name in ("sessions", "users"):
        want = _rows(getattr(curated, name))
        assert _rows(getattr(again, name)) == want
        assert _rows(getattr(numbered, name)) == want


def test_events_need_an_order(given):
    with pytest.raises(ValueError, match="event_id"):
        marts.sessions(enrich(standardize(given[0]), given[1]))


def test_requests_without_tokens_have_zero_ratios(make_raw):
    t = tables.build_tables(make_raw({"cost_usd": "1"}, {
        "cost_usd": "2", "input_tokens": "500", "cache_read_tokens": "500"}), None)
    got = {r["cost_usd"]: (r["cost_per_1k_tokens"], r["cache_ratio"])
           for r in t.api_requests.collect()}
    assert got == {1.0: (0.0, 0.0), 2.0: (4.0, 0.5)}


def test_no_requests_keep_the_schema(make_raw):
    t = tables.build_tables(make_raw({"event_name": "user_prompt", "prompt_length": "7"}), None)
    assert t.api_requests.count() == 0 and "cache_ratio" in t.api_requests.columns
    s = t.sessions.first()
    assert (s["session_total_tokens"], s["unique_models"], s["primary_model"],
            s["most_used_tool"], s["tool_success_rate"], s["avg_prompt_length"]) == (
        0.0, 0, "Unknown", "Unknown", 0.0, 7.0)
    assert s["events_per_minute"] == 1.0
    u = t.users.first()
    assert (u["total_sessions"], u["total_api_requests"], u["preferred_model"]) == (
        1, 0, "Unknown")


def test_session_takes_first_filled_and_most_frequent(make_raw):
    at = "2025-01-06T10:00:0{}Z".format
    raw = make_raw(
        {"timestamp": at(0), "user_id": "", "organization_id": ""},
        {"timestamp": at(1), "user_id": "u2", "organization_id": "late", "model": "b"},
        {"timestamp": at(2), "user_id": "u1", "organization_id": "later", "model": "a"},
        {"timestamp": at(3), "model": "", "user_id": "u1"},
        {"timestamp": "junk", "model": "", "user_id": "u0"})
    s = tables.build_tables(raw, None).sessions.first()
    assert (s["user_id"], s["organization_id"]) == ("u2", "late")
    # "m", "a" and "b" occur once each: the smallest wins; blank is a model of its own.
    assert (s["primary_model"], s["unique_models"], s["total_events"]) == ("a", 4, 5)
    assert s["session_duration_seconds"] == 3.0 and s["events_per_minute"] == pytest.approx(100)


def test_a_session_holding_most_rows(spark, make_raw):
    """A blank session id on most rows: checked against counting in plain Python."""
    many = make_raw({"session_id": None, "event_name": "tool_result"}).drop(
        "tool_name", "duration_ms", "timestamp").join(spark.range(3000).select(
            F.concat(F.lit("t"), (F.col("id") % 700).cast("string")).alias("tool_name"),
            F.col("id").cast("string").alias("duration_ms"),
            F.concat(F.lit("2025-01-06T10:00:0"), (F.col("id") % 10).cast("string"),
                     F.lit("Z")).alias("timestamp")))
    rows = many.unionByName(make_raw({"session_id": "s2"}))
    got = {r["session_id"]: r for r in tables.build_tables(rows, None).sessions.collect()}
    counts = Counter(f"t{i % 700}" for i in range(3000))
    usual = min(counts, key=lambda tool: (-counts[tool], tool))
    hot = got[""]
    assert (hot["total_events"], hot["unique_tools"], hot["most_used_tool"]) == (
        3000, 700, usual)
    assert hot["avg_tool_duration_ms"] == 2999 / 2 and got["s2"]["total_events"] == 1


def test_session_counts_for_its_first_user_only(make_raw):
    raw = make_raw({"user_id": "u1"}, {"user_id": "u2", "timestamp": "2025-01-06T11:00:00Z"})
    got = {r["user_id"]: r["total_sessions"]
           for r in tables.build_tables(raw, None).users.collect()}
    assert got == {"u1": 1, "u2": 0}


def test_duplicate_employees_count_events_twice(make_raw, make_staff):
    staff = make_staff(("a@x", "Ann", "P", "L1", "R"), ("a@x", "Zoe", "P", "L1", "R"))
    t = tables.build_tables(make_raw({"input_tokens": "10"}), staff)
    s = t.sessions.first()
    assert (s["total_events"], s["session_total_tokens"], s["full_name"]) == (2, 20.0, "Ann")


def test_crosstab_counts_other_kinds_on_request(make_raw):
    events = standardize(make_raw({}, {"event_name": "odd"}, {"session_id": "s2"}))
    plain = {r["session_id"]: r for r in marts.session_event_crosstab(events).collect()}
    assert plain["s1"]["count_other"] == 1 and plain["s1"]["count_api_request"] == 1 and plain["s2"]["count_api_error"] == 0
    more = marts.session_event_crosstab(events, ["api_request", "odd"])
    assert {r["session_id"]: r["odd"] for r in more.collect()} == {"s1": 1, "s2": 0}


def test_totals_agree_across_views(curated):
    def total(df, column):
        return df.agg(F.sum(column)).first()[0]

    o = views.overview(curated).first()
    for view in (views.usage_by_hour, views.usage_by_weekday, views.daily_usage):
        assert total(view(curated), "event_count") == o["total_events"]
    assert total(views.token_usage_by_practice(curated), "api_requests") == o[
        "total_api_requests"]
    assert total(views.token_usage_by_practice(curated), "total_tokens") == o["total_tokens"]
    assert total(views.sessions_by_practice(curated), "total_sessions") == o["total_sessions"]
    assert total(views.sessions_by_practice(curated), "total_cost_usd") == pytest.approx(
        o["total_cost_usd"], abs=0.05)
    assert total(curated.sessions, "session_total_tokens") == o["total_tokens"]
    assert total(curated.users, "total_tokens") == o["total_tokens"]
    assert total(curated.users, "total_sessions") == o["total_sessions"]
    named = curated.api_requests.where("model <> ''").count()
    assert total(views.cost_by_model(curated), "api_requests") == named
    assert total(views.error_rate_by_model(curated), "api_requests") == named
    assert {r["table_name"]: r["row_count"] for r in tables.table_counts(curated).collect()}[
        "events"] == o["total_events"]
    assert views.top_users_by_cost(curated).count() <= 15


def test_overview_of_nothing_is_zeros(make_raw):
    t = tables.build_tables(make_raw({}).limit(0), None)
    assert set(views.overview(t).first()) == {0}
    assert tables.run_totals(t).first()["total_cost_usd"] == 0.0


def test_registered_views_answer_sql(spark, curated):
    tables.register_tables(curated)
    views.register_views(curated)
    got = spark.sql("SELECT total_events, (SELECT count(*) FROM events) n "
                    "FROM analytics_overview").first()
    assert got[0] == got[1]


def test_report(given, curated):
    raw, _ = given
    row = quality.quality_report(conform(raw), curated.events, curated.sessions,
                                 curated.users).first()
    s, v = row["summary"], row["validation"]
    assert s["raw_row_count"] - s["duplicate_rows_removed"] == s["clean_row_count"]
    assert sum(v["event_name_distribution"].values()) == s["clean_row_count"]
    assert s["total_sessions"] == curated.sessions.count()
    assert v["null_counts"]["timestamp"] > 0 and v["null_counts"]["model"] == 0


def test_report_lists_the_kinds_that_occur_known_or_not(make_raw):
    raw = make_raw({}, {"event_name": "odd"})
    t = tables.build_tables(raw, None)
    row = quality.quality_report(conform(raw), t.events, t.sessions, t.users).first()
    # One entry for all unknown kinds, however many senders invent; the table lists each.
    assert row["validation"]["event_name_distribution"] == {
        "api_request": 1, "other": 1}
    assert t.sessions.first()["count_other"] == 1
    assert row["summary"]["invalid_event_name_count"] == 1
    assert {r[0]: r[1] for r in quality.event_distribution(t.events).collect()} == {
        "api_request": 1, "odd": 1}


# --- filters ---------------------------------------------------------------------

def test_empty_choice_filters_nothing(curated):
    t = explore.apply_filters(curated, [], [])
    assert explore.kpis(t).first()["total_events"] == curated.events.count()


def test_all_models_leave_out_sessions_without_a_request(make_raw):
    raw = make_raw({"session_id": "s1"}, {"session_id": "s1", "event_name": "user_prompt"},
                   {"session_id": "s2", "event_name": "user_prompt", "user_id": "u2"})
    t = explore.apply_filters(tables.build_tables(raw, None), [], ["m"])
    k = explore.kpis(t).first()
    assert (k["total_events"], k["total_sessions"], k["total_users"]) == (2, 1, 1)


def test_practice_choice_narrows_every_table(curated):
    t = explore.apply_filters(curated, ["BUILDING"], None)
    for _, df in t.items():
        assert {r[0] for r in df.select("practice").distinct().collect()} <= {"BUILDING"}


def test_no_match_gives_empty_summaries(curated):
    t = explore.apply_filters(curated, ["nowhere"], ["none"])
    assert set(explore.kpis(t).first()) == {0}
    assert explore.insights(t).count() == 0
    assert explore.tool_performance(t).count() == 0


def test_longest_session_fills_in(make_raw):
    raw = make_raw({"input_tokens": "1500", "cost_usd": "1234.5"},
                   {"timestamp": "2025-01-06T11:30:00Z", "event_name": "user_prompt"})
    got = [r["insight"] for r in explore.insights(
        explore.apply_filters(tables.build_tables(raw, None))).collect()]
    assert got == [
        "The highest token usage currently comes from P with 1,500 tokens.",
        "The highest cost is generated by m with a total of $1,234.50.",
        "Peak activity occurs around 10:00 with 1 events.",
        "The longest session in the current view lasts 90.00 minutes."]


def test_prepare_conforms_a_table_from_elsewhere(spark, make_raw):
    df = spark.createDataFrame([(" x ", "Yes", "12", None)],
                               "practice string, success string, cost_usd string, hour int")
    row = explore.prepare(df, tables.build_tables(make_raw({}), None).events.schema).first()
    assert (row["practice"], row["success"], row["cost_usd"], row["hour"], row["model"]) == (
        "x", True, 12.0, 0, "")


def test_error_rates_differ_between_view_and_filter(make_raw):
    raw = make_raw({"model": ""}, {"model": "", "event_name": "api_error"},
                   {"model": "only-errors", "event_name": "api_error"},
                   {"model": "m"}, {"model": "m", "session_id": "s2"},
                   {"model": "m", "session_id": "s3"}, {"model": "m", "event_name": "api_error"})
    t = tables.build_tables(raw, None)
    assert [tuple(r) for r in views.error_rate_by_model(t).collect()] == [("m", 3, 1, 33.33)]
    got = [tuple(r) for r in explore.error_rate_by_model(explore.apply_filters(t)).collect()]
    assert got == [("", 1, 1, 100.0), ("m", 3, 1, pytest.approx(100 / 3))]


def test_filter_options(make_raw):
    t = tables.build_tables(make_raw({"model": "b"}, {"model": ""}, {"model": "a"}), None)
    assert [tuple(r) for r in explore.filter_options(t).collect()] == [
        ("model", "a"), ("model", "b"), ("practice", "P")]


def test_model_filters_look_up_the_same_sessions_and_users_in_saved_keys(curated, given):
    keys = marts.request_keys(marts.activity(curated.events))
    saved = curated.change(request_keys=lambda _: keys)
    for models in (["model-1"], ["model-1", "model-3"], ["none"]):
        want, got = (explore.apply_filters(t, ["BUILDING"], models) for t in (curated, saved))
        for name in ("events", "sessions", "users", "tool_results"):
            assert _rows(getattr(got, name)) == _rows(getattr(want, name))


def test_insights_settle_ties_by_name(make_raw):
    raw = make_raw(*[{"practice": p, "model": m, "input_tokens": "5", "cost_usd": "1"}
                     for p, m in (("B", "y"), ("A", "z"), ("B", "x"), ("A", "x"), ("A", "y"), ("B", "z"))])
    got = [r["insight"] for r in explore.insights(tables.build_tables(raw, None)).collect()]
    assert got[0].endswith("from A with 15 tokens.") and "generated by x" in got[1]


# --- order of what is shown --------------------------------------------------------

@pytest.mark.parametrize("name,key", [
    ("token_usage_by_practice", lambda r: (-r["total_tokens"], r["practice"])),
    ("cost_by_model", lambda r: (-r["total_cost_usd"], r["model"])),
    ("usage_by_hour", lambda r: (r["hour"] is None, r["hour"] or 0)),
    ("usage_by_weekday", lambda r: (r["weekday_num"] is None, r["weekday_num"] or 0)),
    ("daily_usage", lambda r: (r["event_date"] is None, str(r["event_date"]))),
    ("sessions_by_practice", lambda r: (-r["total_sessions"], r["practice"])),
    ("top_users_by_tokens", lambda r: (-r["total_tokens"], r["user_id"])),
    ("top_users_by_cost", lambda r: (-r["total_cost_usd"], r["user_id"])),
    ("error_rate_by_model", lambda r: (-r["error_rate_pct"], -r["api_requests"], r["model"])),
    ("tool_performance", lambda r: (-r["total_runs"], r["tool_name"])),
    ("session_outliers", lambda r: (-r["session_total_tokens"], r["session_id"]))])
def test_views_are_in_order(curated, name, key):
    rows = views.VIEWS[name](curated).collect()
    assert len(rows) > 1 and rows == sorted(rows, key=key)


def test_weekdays_are_shown_from_monday(curated):
    days = [r["weekday"] for r in explore.usage_by_weekday(explore.apply_filters(curated)).collect()]
    week = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
    assert days == [d for d in week if d in days] and len(days) > 3


def test_sessions_and_users_as_listed(curated):
    starts = [r[0] for r in tables.listed_sessions(curated).select("session_start").collect()]
    dated = [s for s in starts if s is not None]
    assert dated == sorted(dated) and starts[:len(dated)] == dated
    rows = [(r["practice"], -r["total_tokens"], r["user_id"]) for r in tables.listed_users(curated).collect()]
    assert rows == sorted(rows) and len(rows) == curated.users.count()
