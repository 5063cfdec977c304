"""Scalar functions on the hand-made edge rows of FIXTURES.md §2."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from newsmart.functions import (
    UNKNOWN_AUTHOR,
    contains_match,
    count_matches,
    date_prefix,
    fill_author,
    iso_format,
    page_count,
    parse_timestamp,
    quote_literal,
    split_on_whitespace,
    url_host,
    utc_date,
)


def one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_split_on_unicode_whitespace(spark):
    assert one(spark, F.filter(split_on_whitespace("v"), lambda w: w != ""), "bbbbbb　ccccc\x1cddddd") == ["bbbbbb", "ccccc", "ddddd"]
    assert one(spark, F.filter(split_on_whitespace("v"), lambda w: w != ""), "  a \t b\n\nc  ") == ["a", "b", "c"]
    # The same split Python's str.split() makes.
    text = "x y z\x1fw\u0085v"
    assert one(spark, F.filter(split_on_whitespace("v"), lambda w: w != ""), text) == text.split()


def test_null_author_filled_empty_kept(spark):
    assert one(spark, fill_author("v"), None) == UNKNOWN_AUTHOR
    assert one(spark, fill_author("v"), "") == ""


def test_regex_and_literal_keyword(spark):
    assert one(spark, count_matches("v", "anea."), "aneax anea.") == 2
    assert one(spark, count_matches("v", "anea.", literal=True), "aneax anea.") == 1
    assert one(spark, count_matches("v", "Dengue"), "DENGUE dengue, x") == 2
    assert one(spark, count_matches("v", "x"), None) is None
    assert one(spark, contains_match("v", "den.ue"), "Dengue") is True
    assert quote_literal("a.b") == "\\Qa.b\\E"


def test_page_count(spark):
    df = spark.createDataFrame([(0,), (1,), (100,), (101,)], "t long")
    assert [r[0] for r in df.select(page_count("t")).collect()] == [0, 1, 1, 2]


def test_dates_are_utc_whatever_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        d = one(spark, utc_date(parse_timestamp("v")), "2024-01-01T01:30:00Z")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert d == dt.date(2024, 1, 1)


def test_malformed_timestamp_raises_or_nulls(spark):
    assert one(spark, parse_timestamp("v", lenient=True), "xx") is None
    with pytest.raises(Exception):
        one(spark, parse_timestamp("v"), "xx")


def test_date_helpers(spark):
    assert one(spark, date_prefix("v"), "2024-03-25T00:00:01Z") == "2024-03-25"
    ts = one(spark, iso_format(F.to_timestamp("v")), "2024-03-25T10:11:12Z")
    assert ts == "2024-03-25T10:11:12"


def test_url_host(spark):
    assert one(spark, url_host("v"), "https://User@M.Example.com:8080/x?y") == "m.example.com"
    assert one(spark, url_host("v"), "not a url") is None
