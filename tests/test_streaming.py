import json

import pytest
from pyspark.sql import functions as F

from usagelens.operators.batches import pack_batches
from usagelens.operators.standardize import standardize
from usagelens.sources import logs
from checks import sample
from usagelens.streaming import live as streaming
from usagelens.streaming.live import DAY, ROW_ID, UNDATED, append_events, stream_events

SF_DIR = "/root/testdata/sf0.001"


def _run(spark, tmp_path):
    live = stream_events(spark, str(tmp_path / "logs"))
    append_events(live, str(tmp_path / "out"), str(tmp_path / "state"), availableNow=True).awaitTermination()
    return spark.read.schema(live.schema).parquet(str(tmp_path / "out"))


def test_stream_gives_the_batch_result(spark, tmp_path):
    raw = sample.raw_events(spark, SF_DIR)
    logs.write_log_batches(pack_batches(raw, 50), str(tmp_path / "logs"))
    got = _run(spark, tmp_path).drop(ROW_ID, DAY)
    want = standardize(raw)
    assert got.count() == want.count()
    assert got.exceptAll(want.select(*got.columns)).count() == 0


def test_late_and_repeated_files_lose_and_double_nothing(spark, tmp_path, make_raw):
    files = [make_raw({"timestamp": "2025-01-20T10:00:00Z"}, {"timestamp": "never"}),
             make_raw({"timestamp": "2025-01-10T10:00:00Z"}),
             make_raw({"timestamp": "2025-01-20T11:00:00Z"}, {"timestamp": "2025-01-20T10:00:00Z"}, {"timestamp": "never"}),
             make_raw({"timestamp": "2025-01-10T10:00:00Z"}, {"timestamp": "2025-01-10T10:00:00Z", "cost_usd": "0"})]
    seen = []
    for i, file in enumerate(files):
        path = str(tmp_path / f"file{i}")
        logs.write_log_batches(pack_batches(file, 10), path)
        spark.read.text(path).write.mode("append").text(str(tmp_path / "logs"))
        rows = _run(spark, tmp_path)
        seen.append(rows.count())
    assert seen == [2, 3, 4, 5]  # an absent cost and a zero are two events, as in a batch run
    assert sorted(r[DAY] for r in rows.select(DAY).distinct().collect()) == ["2025-01-10", "2025-01-20", UNDATED]
    assert rows.where(F.col("timestamp").isNull()).count() == 1


def _append(spark, tmp_path, number, raw):
    path = str(tmp_path / f"part{number}")
    logs.write_log_batches(pack_batches(raw, 10), path)
    spark.read.text(path).write.mode("append").text(str(tmp_path / "logs"))


def test_only_the_days_of_a_trigger_are_read_again(spark, tmp_path, make_raw, monkeypatch):
    plans = []
    held = streaming._held

    def noted(*args):
        df = held(*args)
        if df is not None:
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df

    monkeypatch.setattr(streaming, "_held", noted)
    for number, day in enumerate(("20", "10", "20")):
        _append(spark, tmp_path, number, make_raw({"timestamp": f"2025-01-{day}T1{number}:00:00Z"}))
        rows = _run(spark, tmp_path)
    assert rows.count() == 3 and len(plans) == 2
    filters = [next(part for part in p.split("PartitionFilters: ")[1:]) for p in plans]
    assert "2025-01-10" in filters[0] and "2025-01-20" not in filters[0].split("]")[0]
    assert "2025-01-20" in filters[1].split("]")[0]
    monkeypatch.setattr(streaming, "MAX_DAYS", 0)  # more days than are listed: all are read
    _append(spark, tmp_path, 9, make_raw({"timestamp": "2025-01-10T11:00:00Z"}))
    assert _run(spark, tmp_path).count() == 3


def test_a_lenient_stream_sets_rejects_aside(spark, tmp_path, make_raw):
    _append(spark, tmp_path, 0, make_raw({}, {"session_id": "s2"}))
    bad = [("{torn",), (json.dumps({"logEvents": [{"id": "1", "timestamp": 1, "message": "{no"}]}),)]
    spark.createDataFrame(bad, "value string").coalesce(1).write.mode("append").text(str(tmp_path / "logs"))
    live = stream_events(spark, str(tmp_path / "logs"), strict=False)
    with pytest.raises(ValueError, match="rejects"):
        append_events(live, str(tmp_path / "out"), str(tmp_path / "state"))
    append_events(live, str(tmp_path / "out"), str(tmp_path / "state"), str(tmp_path / "bad"),
                  availableNow=True).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2
    found = spark.read.parquet(str(tmp_path / "bad"))
    assert sorted((r["reason"], r["text"]) for r in found.collect()) == [("line", "{torn"), ("message", "{no")]
    strict = stream_events(spark, str(tmp_path / "logs")).columns
    assert set(live.columns) - set(strict) == {"outcome", "text"}
