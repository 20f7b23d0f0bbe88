import glob
import os

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from usagelens.operators.enrich import SENT_PRACTICE, enrich
from usagelens.operators.numbering import number_events, number_rows
from usagelens.operators.standardize import clean, conform, redelivery_summary, standardize
from usagelens.schemas import EVENT_ORDER, REQUIRED_COLUMNS
from usagelens.session import staging_folder
from checks import sample
from usagelens.sources.employees import conform_employees, duplicate_keys, read_employees

SF_DIR = "/root/testdata/sf0.001"


def test_missing_required_columns_are_named(spark):
    with pytest.raises(ValueError, match="email.*user_id"):
        conform(spark.createDataFrame([("a", "b", "c", "d")],
                                      "event_type string, event_name string, "
                                      "timestamp string, session_id string"))


def test_optional_columns_are_added_and_others_kept(spark):
    df = spark.createDataFrame([("t", "api_request", "2025-01-01T00:00:00Z", "s", "u", "e", 5)],
                               ", ".join(f" {c} string" for c in REQUIRED_COLUMNS) + ", extra int")
    row = standardize(df).first().asDict()
    assert (row["model"], row["cost_usd"], row["success"], row["extra"]) == ("", 0.0, False, 5)


def test_column_names_are_stripped(spark):
    df = spark.range(1).select(*[F.lit("x").alias(f" {c} ") for c in REQUIRED_COLUMNS])
    assert standardize(df).count() == 1


def test_blanks_do_not_keep_copies_apart_but_absent_numbers_do(make_raw):
    raw = make_raw({"email": " a@x "}, {"email": "a@x"}, {"input_tokens": "0"},
                   {"input_tokens": "abc"})
    clean = standardize(raw)
    assert clean.count() == 2 and clean.distinct().count() == 1
    summary = redelivery_summary(conform(raw)).first()
    assert tuple(summary) == (4, 2, 2, 0, 0)


def test_summary_counts_bad_rows(make_raw):
    raw = make_raw({"timestamp": "junk"}, {"timestamp": "junk"}, {"event_name": "odd"},
                   {"event_name": None})
    assert tuple(redelivery_summary(conform(raw)).first()) == (4, 3, 1, 2, 2)


def test_summary_of_nothing_is_zeros(make_raw):
    assert tuple(redelivery_summary(conform(make_raw({}).limit(0))).first()) == (0, 0, 0, 0, 0)


def test_rows_without_a_time_keep_false_flags(make_raw):
    row = standardize(make_raw({"timestamp": "junk"})).first()
    assert row["hour"] is None and row["is_weekend"] is False


def test_numbers_match_a_global_row_number(spark):
    events = clean(sample.raw_events(spark, SF_DIR))
    order = [F.col(c).asc_nulls_last() for c in EVENT_ORDER]
    want = events.withColumn("want", F.row_number().over(W.orderBy(*order)))
    key = F.xxhash64(*EVENT_ORDER)
    got = number_events(events, partitions=7)
    assert got.count() == events.count()
    joined = got.select(key.alias("k"), "event_id").join(want.select(key.alias("k"), "want"), "k")
    assert joined.where("event_id <> want").count() == 0
    assert got.where("timestamp is null").agg(F.min("event_id")).first()[0] > got.where(
        "timestamp is not null").agg(F.max("event_id")).first()[0]


def test_one_timestamp_spreads_over_partitions(spark, make_raw):
    base = make_raw({"timestamp": "junk"})
    many = base.drop("user_id").crossJoin(
        spark.range(2000).select(F.concat(F.lit("u"), "id").alias("user_id")))
    got = number_events(standardize(many), partitions=4)
    assert got.agg(F.min("event_id"), F.max("event_id"),
                   F.count_distinct("event_id")).first() == (1, 2000, 2000)
    staged = max(glob.glob(f"{staging_folder(spark)}/*/event_id-*"), key=os.path.getmtime)
    files = spark.read.parquet(staged).groupBy(F.input_file_name()).count()
    sizes = [r["count"] for r in files.collect()]
    assert len(sizes) == 4 and max(sizes) < 1500


def test_numbering_survives_shuffled_input(spark):
    df = spark.range(500).select((F.col("id") % 50).alias("a"), "id")
    one = number_rows(df, ["a", "id"], "n", 3).orderBy("id").collect()
    two = number_rows(df.repartition(9, "id"), ["a", "id"], "n", 5).orderBy("id").collect()
    assert one == two


def test_staging_uses_the_named_folder(spark):
    assert staging_folder(spark) == spark.conf.get("spark.checkpoint.dir")


# --- enrichment ------------------------------------------------------------------

def test_employee_practice_wins_even_when_blank(make_raw, make_staff):
    staff = make_staff(("a@x", "Ann", "Data", "L1", "Rome"), ("b@x", "Bob", "  ", None, ""))
    raw = make_raw({"email": "a@x", "practice": "sent"}, {"email": "b@x", "practice": "sent"},
                   {"email": "c@x", "practice": "sent"}, {"email": "d@x", "practice": " "})
    got = {r["email"]: (r["practice"], r["full_name"], r["level"], r["location"])
           for r in enrich(standardize(raw), staff).collect()}
    assert got == {"a@x": ("Data", "Ann", "L1", "Rome"),
                   "b@x": ("Unknown", "Bob", "Unknown", "Unknown"),
                   "c@x": ("sent", "Unknown", "Unknown", "Unknown"),
                   "d@x": ("Unknown", "Unknown", "Unknown", "Unknown")}


def test_without_employees(make_raw):
    row = enrich(standardize(make_raw({"practice": ""})), None).first()
    assert (row["practice"], row["full_name"]) == ("Unknown", "Unknown")
    assert SENT_PRACTICE not in row.asDict()


def test_duplicate_employees_multiply_events(make_raw, make_staff):
    staff = make_staff(("a@x", "Ann", "P", "L1", "R"), ("a@x", "Anna", "P", "L1", "R"))
    assert enrich(standardize(make_raw({})), staff).count() == 2
    assert [tuple(r) for r in duplicate_keys(staff).collect()] == [("a@x", 2)]


def test_employee_file(spark, tmp_path):
    path = tmp_path / "staff.csv"
    path.write_text(" Email ,FULL_NAME,Practice,level\n a@x , Ann ,,L1\n")
    with pytest.warns(UserWarning, match="location"):
        staff = read_employees(spark, str(path))
    assert [tuple(r) for r in staff.collect()] == [("a@x", "Ann", "", "L1")]
    with pytest.warns(UserWarning, match="not found"):
        assert read_employees(spark, str(tmp_path / "none.csv")) is None


def test_partial_dimension(make_raw, spark):
    with pytest.warns(UserWarning):
        staff = conform_employees(
            spark.createDataFrame([("a@x", "Ann")], "email string, full_name string"))
        row = enrich(standardize(make_raw({"practice": "sent"})), staff).first()
    assert (row["practice"], row["full_name"], row["level"]) == ("sent", "Ann", "Unknown")
