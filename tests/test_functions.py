import datetime as dt

import pytest
from pyspark.sql import functions as F

from mediaspark.functions import numeric, temporal, text
from tests.helpers import frame


def one(spark, schema, values, column):
    return [row[0] for row in frame(spark, schema, *[(v,) for v in values]).select(column).collect()]


def test_device_system_takes_the_first_pattern(spark):
    agents = {
        "iPhone; CPU iPhone OS 17": "iOS",
        "okhttp/4 IOS": "iOS",
        "Linux; Android 13": "Android",
        "Windows NT 10.0": "Windows",
        "Macintosh; Intel": "macOS",
        "mac os x": "macOS",
        "X11; Linux x86_64": "Linux",
        "SMART-TV; Tizen 6": "Linux",
        "Roku/DVP": "Other",
        "Fire TV": "Other",
        "": "Other",
        None: "Other",
    }
    assert one(spark, "a string", agents, text.device_system(F.col("a"))) == list(agents.values())


def test_email_form(spark):
    cases = {"a@b.in": True, "a.b+c@d-e.co": True, "a@b": False, "a b@c.de": False, "@c.de": False, "a@b.c": False, None: None}
    assert one(spark, "a string", cases, text.is_email(F.col("a"))) == list(cases.values())


def test_genres_of_mixed_separators(spark):
    cases = {
        "Action,Drama": ["Action", "Drama"],
        "Action, Drama": ["Action", "Drama"],
        "Action | Drama|Comedy": ["Action", "Drama", "Comedy"],
        "Solo": ["Solo"],
        "A,,B": ["A", "", "B"],
        " A , B ": [" A", "B "],
        ",A": ["", "A"],
        None: None,
    }
    assert one(spark, "g string", cases, text.genre_list(F.col("g"))) == list(cases.values())


def test_titles_keep_tabs_unless_asked(spark):
    assert one(spark, "t string", ["  A b ", "\tC "], text.tidy_title(F.col("t"))) == ["A b", "\tC"]
    assert one(spark, "t string", ["  A b ", "\tC "], text.tidy_title(F.col("t"), True)) == ["A b", "C"]


def test_budgets(spark):
    cases = {
        "5000000": (5000000, "INR"),
        "USD 38988255": (38988255, "USD"),
        "USD abc": (None, "USD"),
        "Eur12": (12, "Eur"),
        "120.75": (120, "INR"),
        "-7": (-7, "INR"),
        "1 2": (None, "INR"),
        "": (None, "INR"),
        "99999999999999999999": (None, "INR"),
        None: (None, "INR"),
    }
    amounts = one(spark, "b string", cases, text.budget_amount(F.col("b")))
    currencies = one(spark, "b string", cases, text.budget_currency(F.col("b")))
    assert list(zip(amounts, currencies)) == list(cases.values())


def test_runtime_is_cut_to_whole_minutes(spark):
    rows = [(59, "seconds"), (119, "seconds"), (120, "seconds"), (90, "minutes"), (45, None), (None, "seconds")]
    df = frame(spark, "v int, u string", *rows).select(numeric.runtime_minutes(F.col("v"), F.col("u")))
    assert [row[0] for row in df.collect()] == [0, 1, 2, 90, 45, None]


def test_broken_times_are_null(spark):
    found = one(spark, "t string", ["bad", "", None, "2025-03-15T20:31:05.123Z"], temporal.instant(F.col("t")).isNull())
    assert found == [True, True, True, False]


@pytest.mark.parametrize("session_zone", ["UTC", "Asia/Kolkata", "America/New_York"])
def test_date_is_cut_in_the_named_zone(spark, session_zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", session_zone)
    try:
        texts = ["2025-03-15T20:31:05.123Z", "2025-03-15T18:29:59Z", "2025-11-02T05:30:00Z", "1969-12-31T23:00:00Z"]
        column = temporal.local_date(temporal.instant(F.col("t")), "Asia/Kolkata").cast("string")
        assert one(spark, "t string", texts, column) == ["2025-03-16", "2025-03-15", "2025-11-02", "1970-01-01"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_as_date_takes_text_dates_and_columns(spark):
    day = dt.date(2024, 2, 29)
    row = spark.range(1).select(
        temporal.as_date("2024-02-29"), temporal.as_date(day), temporal.as_date(F.lit(day)),
        temporal.as_date(None) == F.current_date(),
    ).first()
    assert tuple(row) == (day, day, day, True)


def test_bins_hold_both_ends(spark):
    bins = one(spark, "x double", [0.0, 0.99, 1.0, 9.99, 10.0], numeric.bin_number(F.col("x"), F.lit(0.0), F.lit(10.0), 10))
    assert bins == [1, 1, 2, 10, 10]
    assert one(spark, "x double", [3.0], numeric.bin_number(F.col("x"), F.lit(3.0), F.lit(3.0), 10)) == [1]


def test_numbers_from_text(spark):
    assert one(spark, "x string", ["4.5", "n/a", None], numeric.number_or_null(F.col("x"))) == [4.5, None, None]
