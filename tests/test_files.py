"""Log files, saved tables and exports."""

import glob
import json

import pytest
from pyspark.sql import functions as F

from usagelens.operators.batches import pack_batches
from usagelens.plans import pipeline, tables, views
from usagelens.schemas import RAW_COLUMNS
from usagelens.session import staging_folder
from usagelens.sources import logs
from usagelens.sources.employees import read_employees
from checks import sample

SF_DIR = "/root/testdata/sf0.001"


def _line(*messages, **more):
    return json.dumps({"logEvents": [{"id": "1", "timestamp": 1, "message": m}
                                     for m in messages], **more})


def _write(tmp_path, *lines):
    path = tmp_path / "logs.jsonl"
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def _shown(df):
    # The last bits of a sum of doubles depend on the order of its terms.
    return [[round(v, 6) if isinstance(v, float) else v for v in r] for r in df.collect()]


GOOD = json.dumps({"body": "b", "attributes": {"event.name": "api_request", "input_tokens": 5,
                                               "user.id": "u"}, "resource": {"user.practice": "P"}})


def test_edge_lines(spark, tmp_path):
    path = _write(tmp_path, _line(GOOD), json.dumps({"owner": "x"}), _line(),
                  _line(json.dumps({"body": "only"})),
                  _line(json.dumps({"attributes": {"model": "m"}})))
    rows = logs.ingest(spark, path).collect()
    assert [(r["event_type"], r["event_name"], r["input_tokens"], r["practice"], r["model"])
            for r in rows] == [("b", "api_request", "5", "P", None),
                               ("only", None, None, None, None),
                               (None, None, None, None, "m")]
    assert rows[0].asDict().keys() == set(RAW_COLUMNS)


@pytest.mark.parametrize("bad", ["{not json", _line("{not json"), json.dumps(
    {"logEvents": [{"id": "1"}]})])
def test_malformed_input_stops_a_strict_read(spark, tmp_path, bad):
    with pytest.raises(Exception):
        logs.ingest(spark, _write(tmp_path, _line(GOOD), bad)).collect()


def test_lenient_read_sets_malformed_input_aside(spark, tmp_path):
    path = _write(tmp_path, _line(GOOD, "{bad message"), "{bad line")
    batches = logs.read_log_batches(spark, path, strict=False)
    assert logs.flatten_batches(batches, strict=False).count() == 1
    assert sorted(tuple(r) for r in logs.rejected(batches).collect()) == [
        ("line", "{bad line"), ("message", "{bad message")]


def test_batches_hold_consecutive_events(spark, tmp_path):
    raw = sample.raw_events(spark, SF_DIR)
    packed = pack_batches(raw, batch_size=7)
    sizes = [r[0] for r in packed.orderBy("batch_id").select(F.size("logEvents")).collect()]
    assert set(sizes[:-1]) == {7} and sum(sizes) == raw.count()
    path = str(tmp_path / "by_day")
    logs.write_log_batches(packed, path, partitioned=True)
    flat = logs.ingest(spark, path)
    assert flat.exceptAll(raw).count() == 0 and raw.exceptAll(flat).count() == 0
    assert spark.read.json(path).where("year = 2024 and month = 1").count() > 0


def test_whole_run_from_files(spark, tmp_path):
    raw = sample.raw_events(spark, SF_DIR)
    log_path, out = str(tmp_path / "logs"), str(tmp_path / "out")
    logs.write_log_batches(pack_batches(raw), log_path)
    staff = sample.employees(spark, SF_DIR)
    staff.coalesce(1).write.csv(str(tmp_path / "staff"), header=True)

    pipeline.run(spark, log_path, str(tmp_path / "staff"), out)
    saved = tables.read_tables(spark, out)
    lazy = tables.build_tables(raw, staff)
    assert saved.events.agg(F.max("event_id")).first()[0] == lazy.events.count()
    for name, view in views.VIEWS.items():
        assert _shown(view(saved)) == _shown(view(lazy)), name

    header = spark.read.csv(f"{out}/metrics/cost_by_model", header=True)
    assert header.columns[0] == "model" and header.count() > 0
    overview = spark.read.json(f"{out}/metrics/overview_json").first()
    assert overview["total_events"] == lazy.events.count()
    report = spark.read.json(f"{out}/data_quality_report")
    assert report.count() == 1
    assert report.first()["summary"]["raw_row_count"] == raw.count()


def test_events_by_date_are_pruned(spark, tmp_path):
    raw = sample.raw_events(spark, SF_DIR)
    saved = pipeline.save_curated(raw, None, str(tmp_path), partition_events_by="event_date")
    one_day = saved.events.where("event_date = timestamp'2024-01-05 00:00:00Z'")
    plan = one_day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    want = saved.events.where(F.to_date("timestamp") == "2024-01-05").count()
    assert one_day.count() == want > 0


def test_saved_tables_have_statistics(spark, make_raw, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS curated")
    t = tables.build_tables(make_raw({}, {"session_id": "s2"}), None)
    tables.save_as_tables(t, "curated", str(tmp_path / "managed"))
    described = {r[0]: r[1] for r in spark.sql(
        "DESCRIBE EXTENDED curated.sessions").collect()}
    assert "2 rows" in described["Statistics"]


def test_a_saved_run_leaves_no_staged_rows(spark, make_raw, tmp_path):
    before = set(glob.glob(f"{staging_folder(spark)}/*/*"))
    saved = pipeline.save_curated(make_raw({}, {}, {"session_id": "s2"}), None, str(tmp_path / "out"))
    assert saved.events.count() == 2 and "copies" not in saved.events.columns
    assert set(glob.glob(f"{staging_folder(spark)}/*/*")) == before
    summary = spark.read.json(str(tmp_path / "out" / "data_quality_report")).first()["summary"]
    assert (summary["raw_row_count"], summary["duplicate_rows_removed"]) == (3, 1)


def test_awkward_employee_lists(spark, tmp_path, make_raw):
    path = tmp_path / "staff.csv"
    path.write_text('Email,Full_Name,practice,level,location,model\n'
                    'a@x,"Ann ""Q"" Lee",P,L1,"Oslo,\nNorway",laptop\n'
                    'b@x,NULL,n/a,,nan,\n')
    staff = read_employees(spark, str(path))
    rows = {r["email"]: tuple(r[c] for c in ("full_name", "practice", "level", "location")) for r in staff.collect()}
    assert rows == {"a@x": ('Ann "Q" Lee', "P", "L1", "Oslo,\nNorway"), "b@x": ("", "", "", "")}
    event = tables.build_tables(make_raw({"model": "m"}), staff).events.first()
    assert (event["full_name"], event["model"]) == ('Ann "Q" Lee', "m")


def test_a_lenient_run_keeps_and_counts_what_it_rejects(spark, tmp_path):
    path = _write(tmp_path, _line(GOOD, "{bad message"), "{bad line", _line(GOOD.replace('"u"', '"v"')),
                  json.dumps({"logEvents": [{"id": "1"}]}))
    good = json.loads(GOOD)
    good["attributes"] |= {"session.id": "s", "user.email": "e@x", "event.timestamp": "2025-01-06T10:00:00Z"}
    with open(path, "a") as lines:
        lines.write(_line(json.dumps(good)) + "\n")
    saved = pipeline.run(spark, path, str(tmp_path / "nobody.csv"), str(tmp_path / "out"), strict=False)
    assert saved.events.count() == 3
    found = spark.read.parquet(str(tmp_path / "out" / "ingested")).where("outcome <> 'event'")
    assert sorted((r["outcome"], r["text"] or "") for r in found.collect()) == [
        ("line", "{bad line"), ("message", ""), ("message", "{bad message")]
    summary = spark.read.json(str(tmp_path / "out" / "data_quality_report")).first()["summary"]
    assert (summary["rejected_lines"], summary["rejected_messages"], summary["raw_row_count"]) == (1, 2, 3)


def test_lenient_and_strict_runs_agree_on_good_files(spark, tmp_path):
    raw = sample.raw_events(spark, SF_DIR)
    logs.write_log_batches(pack_batches(raw), str(tmp_path / "logs"))
    for strict in (True, False):
        pipeline.run(spark, str(tmp_path / "logs"), str(tmp_path / "none"), str(tmp_path / str(strict)), strict=strict)
    strict, lenient = (tables.read_tables(spark, str(tmp_path / str(s))) for s in (True, False))
    for (name, a), (_, b) in zip(strict.items(), lenient.items()):
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name


def test_files_of_nothing_but_rejects(spark, tmp_path):
    path = _write(tmp_path, "{bad", "{worse")
    saved = pipeline.run(spark, path, str(tmp_path / "none"), str(tmp_path / "out"), strict=False)
    assert saved.events.count() == 0 and saved.sessions.count() == 0
    assert spark.read.json(str(tmp_path / "out" / "data_quality_report")).first()["summary"]["rejected_lines"] == 2


def test_employees_listed_twice_are_reported(spark, make_raw, make_staff, tmp_path):
    staff = make_staff(("a@x", "Ann", "P", "L1", "R"), ("a@x", "Zoe", "P", "L1", "R"), ("b@x", "Bo", "P", "L1", "R"))
    saved = pipeline.save_curated(make_raw({}), staff, str(tmp_path))
    assert saved.events.count() == 2
    summary = spark.read.json(str(tmp_path / "data_quality_report")).first()["summary"]
    assert summary["duplicate_employee_emails"] == 1


def test_a_run_into_the_catalog(spark, tmp_path):
    path = _write(tmp_path, _line(GOOD))
    saved = pipeline.run(spark, path, str(tmp_path / "none"), str(tmp_path / "out"), database="whole_run")
    assert saved.events.count() == spark.table("whole_run.events").count() == 1
    known = {r["column_name"]: r["greatest"] for r in tables.column_statistics(
        spark, "whole_run", "events", "input_tokens").collect()}
    assert known == {"input_tokens": "5.0"}
