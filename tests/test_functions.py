from datetime import datetime

from pyspark.sql import functions as F

from usagelens import functions as fn
from usagelens.functions.calendar import weekday_position
from usagelens.functions.clean import WHITESPACE, strip
from usagelens.functions.measures import round_even


def test_white_space_is_every_unicode_space():
    assert set(WHITESPACE) == {chr(i) for i in range(0x110000) if chr(i).isspace()}


def test_clean_text(evaluate):
    assert evaluate(fn.clean_text, None, "", "  a b ", "\t x　\n", "é ", "\x1cz") == [
        "", "", "a b", "x", "é", "z"]
    assert evaluate(lambda c: fn.clean_wire_text("x"), None, "", "  a b ", "\t x\u3000\n", "é ",
                    "\x1cz") == ["", "", "a b", "x", "é", "z"]
    assert evaluate(strip, None) == [None]
    assert evaluate(fn.or_unknown, "", None, "L1") == ["Unknown", "Unknown", "L1"]


def test_clean_number(evaluate):
    assert evaluate(fn.clean_number, "12", " 1.5 ", "-1e3", ".5", "inf", "-Infinity") == [
        12.0, 1.5, -1000.0, 0.5, float("inf"), float("-inf")]
    assert evaluate(fn.clean_number, None, "", "abc", "nan", "1.0d", "2F", "0x1p3", "1_000",
                    "true") == [None] * 9


def test_clean_bool(evaluate):
    assert evaluate(fn.clean_bool, "true", " YES ", "1", "True\t") == [True] * 4
    assert evaluate(fn.clean_bool, None, "", "1.0", "no", "0", "nan", "y", "none") == [False] * 8


def test_clean_timestamp(evaluate):
    text = lambda c: F.date_format(fn.clean_timestamp(c), "yyyy-MM-dd HH:mm:ss.SSS")
    assert evaluate(text, "2025-01-01T00:30:00.123Z", "2025-01-01T00:30:00+01:00",
                    "2025-01-01 00:30:00", " 2025-01-01 ") == [
        "2025-01-01 00:30:00.123", "2024-12-31 23:30:00.000", "2025-01-01 00:30:00.000",
        "2025-01-01 00:00:00.000"]
    assert evaluate(text, None, "", "not-a-time", "10:30:00", "T10:30:00.000000", "2025",
                    "2025-13-01T00:00:00Z") == [None] * 7


def test_calendar(spark):
    rows = spark.sql("""
        SELECT * FROM VALUES (TIMESTAMP'2025-01-05 17:59:00Z'), (TIMESTAMP'2025-01-06 18:00:00Z'),
        (CAST(NULL AS TIMESTAMP)) t(ts)""").select(
        "ts", *[c.alias(n) for n, c in fn.calendar_columns(F.col("ts")).items()]).collect()
    sunday, monday, unknown = [r.asDict() for r in rows]
    assert (sunday["weekday"], sunday["weekday_num"], sunday["is_weekend"]) == ("Sunday", 6, True)
    assert sunday["is_business_hour"] and sunday["month_label"] == "2025-01"
    assert (monday["weekday_num"], monday["is_weekend"], monday["is_business_hour"]) == (
        0, False, False)
    assert [n for n, v in unknown.items() if v is not None] == ["is_weekend", "is_business_hour"]
    assert unknown["is_weekend"] is False and unknown["is_business_hour"] is False


def test_spans_keep_fractions(spark):
    row = spark.sql("SELECT TIMESTAMP'2025-01-01 00:00:00Z' a, "
                    "TIMESTAMP'2025-01-01 00:01:30.5Z' b, CAST(NULL AS TIMESTAMP) c").select(
        fn.seconds_between(F.col("a"), F.col("b")), fn.minutes_between(F.col("a"), F.col("b")),
        fn.minutes_between(F.col("a"), F.col("c"))).first()
    assert tuple(row) == (90.5, 90.5 / 60, 0.0)


def test_rounding(spark):
    df = spark.createDataFrame([(1.005,), (2.675,), (0.285,), (2.5,), (-2.5,)], "x double")
    got = [tuple(r) for r in df.select(
        fn.round_to(F.col("x"), 2), fn.round_to(F.col("x"), 0), round_even(F.col("x"), 0)
    ).collect()]
    assert [g[0] for g in got[:3]] == [1.0, 2.68, 0.28] or [g[0] for g in got[:3]] == [
        round(1.005 * 100) / 100, round(2.675 * 100) / 100, round(0.285 * 100) / 100]
    assert got[3][1:] == (3.0, 2.0) and got[4][1:] == (-3.0, -2.0)


def test_division_by_zero_takes_the_default(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 4000.0)], "a double, b double")
    assert [r[0] for r in df.select(fn.per_thousand(F.col("a"), F.col("b"))).collect()] == [
        0.0, 0.25]
    assert df.select(fn.ratio_or(F.col("a"), F.col("b"), F.col("a"))).first()[0] == 1.0


def test_first_filled_and_most_frequent(spark):
    df = spark.createDataFrame(
        [(1, "", 9), (3, "c", 2), (2, "b", 2), (2, "a", 1), (4, "", 7)],
        "at int, v string, n long")
    row = df.agg(fn.first_filled(F.col("v"), F.col("at")),
                 fn.most_frequent(F.col("v"), F.col("n"))).first()
    assert tuple(row) == ("a", "b")
    assert df.where("v = ''").agg(fn.first_filled(F.col("v"), F.col("at"))).first()[0] == ""


def test_weekdays_sort_from_monday(evaluate):
    assert evaluate(weekday_position, "Monday", "Sunday", "x") == [1, 7, 0]


def test_session_zone_is_utc(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert datetime.fromisoformat("2025-01-01").year == 2025
