"""The general operators on small tables of their own (column names are arguments)."""

from datetime import date

from pyspark.sql import functions as F

from conftest import rows
from coursematch.operators import (current_or_future, dedupe_by_key, lag_marker, latest_version,
                                   running_cutoff, top1)


def test_latest_version_keeps_ties_and_null_first(spark):
    df = spark.createDataFrame([("a", date(2020, 1, 1), 1), ("a", date(2021, 1, 1), 2), ("a", date(2021, 1, 1), 3),
                                ("b", None, 4), ("b", date(2030, 1, 1), 5)], "k string, effdt date, v int")
    assert [r[0] for r in rows(latest_version(df, ["k"]), "v")] == [2, 3, 4]


def test_current_or_future_keeps_both_bounds_and_ties(spark):
    df = spark.createDataFrame([("a", date(2019, 1, 1), 1), ("a", date(2020, 1, 1), 2), ("a", date(2020, 1, 1), 3),
                                ("a", date(2031, 1, 1), 4), ("a", date(2032, 1, 1), 5), ("b", None, 6),
                                ("c", date(2040, 1, 1), 7)], "k string, effdt date, v int")
    got = [r[0] for r in rows(current_or_future(df, ["k"], date(2025, 1, 1)), "v")]
    assert got == [2, 3, 5, 7]


def test_dedupe_by_key_survivor_is_first_with_nulls_last(spark):
    df = spark.createDataFrame([(1, None, "z"), (1, "b", "y"), (1, "a", "x"), (2, None, "w")],
                               "k int, a string, b string")
    assert rows(dedupe_by_key(df, ["k"])) == [(1, "a", "x"), (2, None, "w")]


def test_top1_with_explicit_descending_order(spark):
    df = spark.createDataFrame([(1, 5), (1, 9), (2, 3)], "k int, v int")
    assert rows(top1(df, ["k"], [F.col("v").desc()])) == [(1, 9), (2, 3)]


def test_running_cutoff_and_lag_marker(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "stop"), (1, 3, "a"), (2, 1, "a"), (2, 2, "a")],
                               "g int, o int, t string")
    cut = running_cutoff(df, ["g"], ["o"], F.col("t") == "stop", "c")
    assert rows(cut.filter("c = 0"), "g", "o") == [(1, 1), (2, 1), (2, 2)]
    lagged = lag_marker(df, ["g"], ["o"], "t", "prev")
    assert rows(lagged, "g", "o", "prev") == [(1, 1, None), (1, 2, "a"), (1, 3, "stop"), (2, 1, None), (2, 2, "a")]
