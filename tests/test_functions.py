import datetime as dt
import math

from helpers import rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from arrivals.functions import nth_part, relabel, remove_chars, sas_date, trim_blank_edges, trim_leading_spaces


def dates(spark, numbers, kind="double"):
    df = spark.createDataFrame(list(enumerate(numbers)), f"i int, d {kind}")
    return [r["iso"] for r in df.select("i", sas_date(F.col("d")).alias("iso")).orderBy("i").collect()]


def test_sas_date_cases(spark):
    numbers = [None, 0.0, -0.0, math.nan, 20566.0, 20566.9, -1.0, -1.5, 0.5]
    expected = [None, None, None, None, "2016-04-22", "2016-04-22", "1959-12-31", "1959-12-30", "1960-01-01"]
    assert dates(spark, numbers) == expected


def test_sas_date_limits(spark):
    numbers = [-715509.0, -715510.0, 2936549.0, 2936550.0, math.inf, -math.inf, 1e300]
    assert dates(spark, numbers) == ["0001-01-01", None, "9999-12-31", None, None, None, None]


def test_sas_date_of_text_and_integers(spark):
    assert dates(spark, ["20566.0", " 20566", "x", ""], "string") == ["2016-04-22", "2016-04-22", None, None]
    assert dates(spark, [20566, 0, None], "bigint") == ["2016-04-22", None, None]


def test_sas_date_does_not_depend_on_the_time_zone(spark, conf):
    conf(spark__sql__session__timeZone="America/Sao_Paulo")
    assert dates(spark, [20566.0, -1.0, 21491.0]) == ["2016-04-22", "1959-12-31", "2018-11-03"]


@settings(max_examples=20, deadline=None)
@given(st.lists(st.integers(-700000, 2900000).map(lambda quarter: quarter + 0.25) | st.integers(-700000, 2900000)))
def test_sas_date_agrees_with_calendar(spark, numbers):
    numbers = [float(n) for n in numbers]
    epoch = dt.date(1960, 1, 1)
    expected = [(epoch + dt.timedelta(n)).isoformat() if n else None for n in numbers]
    assert dates(spark, numbers) == expected if numbers else True


def test_nth_part(spark):
    df = spark.createDataFrame([("US-A-B",), ("US",), ("",), (None,)], "v string")
    part = df.select("v", nth_part(F.col("v"), "-", 1).alias("p"))
    assert rows(part) == [(None, None), ("", None), ("US", None), ("US-A-B", "A")]


def test_nth_part_takes_the_separator_literally(spark):
    df = spark.createDataFrame([("a.b|c",)], "v string")
    v = F.col("v")
    assert rows(df.select(nth_part(v, ".", 0), nth_part(v, "|", 1), nth_part(v, ".|", 1))) == [("a", "c", None)]


def test_nth_part_limit_keeps_later_separators(spark):
    df = spark.createDataFrame([("a, b, c",)], "v string")
    assert rows(df.select(nth_part(F.col("v"), ", ", 1, limit=2))) == [("b, c",)]


def test_text_edits(spark):
    df = spark.createDataFrame([("\t 'O''X' \t",)], "v string")
    v = F.col("v")
    assert rows(df.select(remove_chars(v, "'"))) == [("\t OX \t",)]
    assert rows(df.select(remove_chars(v, "'\t"))) == [(" OX ",)]
    assert rows(df.select(trim_blank_edges(v))) == [("'O''X'",)]
    assert rows(df.select(trim_leading_spaces(v))) == [("\t 'O''X' \t",)]


def test_relabel_replaces_from_the_match_on(spark):
    df = spark.createDataFrame([("X BAD Y",), ("BAD: a\nrest",), ("good",)], "v string")
    assert rows(df.select(relabel(F.col("v"), ("BAD.*", "WORSE.*"), "Other"))) == [
        ("Other\nrest",),
        ("X Other",),
        ("good",),
    ]
