import datetime as dt

import pytest
from pyspark.sql import functions as F

from mediaspark.operators import quality as q
from mediaspark.plans import layer_checks
from mediaspark.layout import LakeLayout
from mediaspark.sinks.measures import overwrite_measured, read_measures
from mediaspark.sources.tables import read_table
from tests.helpers import collected, frame, plan_of


def verdicts(df, *rules):
    return dict(collected(q.checks(df, rules), "name", "passed"))


def test_rules(spark):
    df = frame(spark, "k int, v double, s string, e string", (1, 0.0, "x", None), (1, 5.0, "x", "e"), (None, None, None, None))
    found = verdicts(
        df,
        q.rows_between("rows", 1, 3), q.rows_between("rows few", 4, 9), q.not_empty("some"),
        q.no_nulls("nulls", "k"), q.no_nulls("nulls where", "s", F.col("e").isNotNull()),
        q.unique("unique", "k"), q.unique("unique pair", "k", "v"),
        q.within("range", "v", 0, 5), q.within("range tight", "v", 1, 5), q.at_least("least", "v", 0),
        q.always_equals("tag", "s", "x"), q.has_like("like", "s", "k", "x%"), q.has_like("like none", "s", "k", "y%"),
        q.has_column("column", df, "k"), q.has_column("no column", df, "z"), q.has_columns("columns", df, ["k", "z"]),
    )
    assert found == {
        "rows": True, "rows few": False, "some": True, "nulls": False, "nulls where": True, "unique": False,
        "unique pair": True, "range": True, "range tight": False, "least": True, "tag": False, "like": True,
        "like none": False, "column": True, "no column": False, "columns": False,
    }


def test_empty_tables_have_nothing_out_of_range(spark):
    empty = frame(spark, "k int, v double", (1, 2.0)).limit(0)
    assert verdicts(empty, q.within("range", "v", 0, 5), q.at_least("least", "v", 1), q.no_nulls("nulls", "k"),
                    q.unique("unique", "k"), q.not_empty("some")) == {
        "range": True, "least": True, "nulls": True, "unique": True, "some": False,
    }


def test_rules_against_another_table(spark):
    two, three = spark.range(2), spark.range(3)
    plans = frame(spark, "plan string", ("a",), ("a",), (None,))
    assert verdicts(two, q.same_rows("same", two), q.same_rows("not same", three), q.no_more_rows("fewer", three),
                    q.share_of("share", three, 0.6), q.share_of("share high", three, 0.99),
                    q.one_row_per("per plan", plans, "plan")) == {
        "same": True, "not same": False, "fewer": True, "share": True, "share high": False, "per plan": True,
    }


def test_all_rules_of_a_table_are_one_pass(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).selectExpr("id as k", "id * 1.0 as v").write.parquet(path)
    df = spark.read.parquet(path)
    plan = plan_of(q.checks(df, [q.not_empty("a"), q.no_nulls("b", "k"), q.within("c", "v", 0, 9), q.unique("d", "k")]))
    assert plan.count("FileScan") == 1


def test_duplicates_references_and_nulls(spark):
    facts = frame(spark, "k int, v int", (1, 1), (1, 1), (2, 1), (3, None), (None, None))
    assert collected(q.duplicate_keys(facts, "k", "v")) == [(1, 1, 2)]
    keys = frame(spark, "k int", (1,), (1,), (2,), (None,))
    assert collected(q.references(facts, keys, "k")) == [(3, 1, 1)]
    assert collected(q.references(facts.limit(0), keys, "k")) == [(0, 0, 0)]
    assert collected(q.null_counts(facts)) == [("k", 1), ("v", 2)]


def test_missing_tables_fail_and_the_rest_is_checked(spark):
    users = frame(spark, "user_id string, _ingested_at string, _source string", ("u", "now", "mysql"), ("v", "now", "csv"))
    expected = {"users": (2, 2, "mysql"), "ratings": (1, 2, "postgres")}
    found = dict(collected(layer_checks.bronze(spark, {"users": users}, expected), "name", "passed"))
    assert found == {
        "bronze/users row count": True, "bronze/users has _ingested_at": True, "bronze/users source tag": False,
        "bronze/ratings present": False, "bronze/viewing_events present": False,
    }
    assert not any(passed for _, passed in collected(layer_checks.silver(spark, {}, {}), "name", "passed"))
    assert not any(passed for _, passed in collected(layer_checks.gold(spark, {}, {}), "name", "passed"))


def test_null_email_does_not_fail_the_silver_check(spark):
    now = dt.datetime(2024, 1, 1)
    users = frame(
        spark, "user_id string, email string, is_valid_email boolean, device_os string, _silver_processed_at timestamp",
        ("u", None, None, "iOS", now), ("v", "v@w.in", True, "iOS", now),
    )
    found = dict(collected(layer_checks.silver(spark, {"users": users}, {"users": users}), "name", "passed"))
    assert found["silver/users is_valid_email where an email is given"] and found["silver/users keeps all rows"]


@pytest.mark.parametrize("top,passed", [("India", True), ("US", False)])
def test_source_profile(spark, top, passed):
    users = frame(spark, "user_id string, country string", ("u1", top), ("u2", top), ("u3", "Aland"))
    ratings = frame(spark, "user_id string, content_id string", ("USR-1", "c"), ("USR-1", "c"))
    found = dict(collected(layer_checks.source_profile(users, users, users, ratings), "name", "passed"))
    assert found["source users top country"] is passed
    assert found["source ratings have repeats"] and found["source ratings user_id form"]
    assert not found["source users"] and not found["source ratings"]


def test_stored_measures_give_the_verdicts_of_the_table(spark, tmp_path):
    import datetime as dt

    lake = LakeLayout(str(tmp_path / "lake"))
    df = frame(
        spark, "k string, v double, d date, n int, e string, a array<int>, tag string",
        ("x", 1.0, dt.date(2024, 1, 1), 9, None, [1], "t"), ("x", None, None, 10, "e", None, "t"), (None, -2.5, dt.date(2023, 1, 1), 100, "f", [], "t"),
    )
    rows = overwrite_measured(df, lake, "silver", "t", conditions={"odd": "k IS NULL AND e IS NOT NULL"}, keys=[("k",), ("k", "n")])
    assert rows == 3
    stored = q.Stored(read_table(spark, lake, "silver", "t"), read_measures(spark, lake, "silver", "t"))
    rules = [
        q.rows_between("rows", 1, 2), q.not_empty("some"), q.no_nulls("k", "k"), q.no_nulls("n", "n"), q.unique("unique", "k"), q.unique("pair", "k", "n"),
        q.within("v", "v", -3, 1), q.within("n", "n", 9, 99), q.at_least("n least", "n", 10), q.always_equals("tag", "tag", "t"), q.always_equals("e", "e", "e"),
        q.none_broken("odd", "k IS NULL AND e IS NOT NULL", "odd", "rows"), q.same_rows("same", stored), q.one_row_per("per", stored, "k"), q.share_of("share", stored, 0.5),
    ]
    found = q.checks(stored, rules)
    assert collected(found) == collected(q.checks(df, rules))
    plan = plan_of(found)
    assert plan.count("Scan parquet") >= 1 and f"{lake.silver('t')}]" not in plan and "measures" in plan
    empty = df.limit(0)
    overwrite_measured(empty, lake, "silver", "t", conditions={"odd": "false"}, keys=[("k",), ("k", "n")])
    again = q.Stored(read_table(spark, lake, "silver", "t"), read_measures(spark, lake, "silver", "t"))
    some = [r for r in rules if r.name in ("some", "k", "v", "tag", "unique", "n least")]
    assert collected(q.checks(again, some)) == collected(q.checks(empty, some))


def test_measures_do_not_slow_the_write(spark, tmp_path, monkeypatch):
    """They are taken from the written files, also of a table by folders without a row; no row is observed on its way."""
    from pyspark.sql import DataFrame

    monkeypatch.setattr(DataFrame, "observe", lambda *_: pytest.fail("a row is observed"))
    lake = LakeLayout(str(tmp_path / "lake"))
    df = frame(spark, "k string, d string, n int", ("a", "x", 1), ("b", "y", None), (None, "x", 10))
    assert overwrite_measured(df, lake, "silver", "t", ["d"], conditions={"no n": "n IS NULL"}) == 3
    (row,) = read_measures(spark, lake, "silver", "t").collect()
    assert (row["nulls"], row["least"], row["greatest"], row["broken"]) == (
        {"k": 1, "d": 0, "n": 1}, {"k": "a", "d": "x", "n": "1"}, {"k": "b", "d": "y", "n": "10"}, {"no n": 1},
    )
    assert overwrite_measured(df.limit(0), lake, "silver", "t", ["d"]) == 0
    assert read_measures(spark, lake, "silver", "t").first()["least"] == {"k": None, "d": None, "n": None}


def test_measures_are_kept_for_nothing_else(spark, tmp_path):
    lake = LakeLayout(str(tmp_path / "lake"))
    assert read_measures(spark, lake, "silver", "t") is None
