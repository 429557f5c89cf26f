from datetime import date, datetime, timedelta

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plumbline.functions import parsing as P
from plumbline.functions.columns import normalise


def apply(spark, values, function, schema="v string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r["x"] for r in df.select(function(F.col("v")).alias("x")).collect()]


def test_numbers(spark):
    given_values = ["1", " 2.5 ", "-.5", "5.", "1e3", "1d", "0x10", "1_000", "", "inf", "-Infinity", "NaNs", None]
    expected = [1.0, 2.5, -0.5, 5.0, 1000.0, None, None, None, None, float("inf"), float("-inf"), None, None]
    assert apply(spark, given_values, P.to_number) == expected


def test_dates_day_first(spark):
    given_values = [
        "2022-03-04", "04/03/2022", "4.3.2022", "04-03-2022", "2022/03/04", " 2022-03-04 ",
        "2022-03-04 10:11:12", "31/02/2022", "03/25/2022", "2022", "soon", None,
    ]
    day = datetime(2022, 3, 4)
    expected = [day] * 6 + [datetime(2022, 3, 4, 10, 11, 12)] + [None] * 5
    assert apply(spark, given_values, P.to_timestamp) == expected


def test_dates_do_not_depend_on_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
        # midnight did not exist there on that day
        assert apply(spark, ["2018-11-04"], P.to_timestamp) == [datetime(2018, 11, 4)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_patterns(spark):
    values = ["2022-03-04", "04.03.2022", "2022/03/04 x", "2022-03-04x", "AB-1234", "X9-7", "123456", "DEADBEEF-1", "12345"]
    assert apply(spark, values, P.looks_like_date) == [True, True, True, True, False, False, False, False, False]
    assert apply(spark, values, P.looks_like_id) == [False] * 4 + [True, True, True, True, False]


def test_control_characters(spark):
    values = ["plain", "tab\there", "bell\x07", "high\x85", "lost�", "line\nbreak", "é"]
    assert apply(spark, values, P.has_control_characters) == [False, False, True, True, True, False, False]


def test_name_similarity(spark):
    df = spark.createDataFrame(
        [("product-code", "Product_Code"), ("product-code", "code"), ("a", "b"), ("a b", "b-c")], "a string, b string"
    )
    found = [r[0] for r in df.select(P.name_similarity(F.col("a"), F.col("b"))).collect()]
    assert found == [1.0, 0.5, 0.0, 1 / 3]


def test_percent_rounds_half_to_even(spark):
    df = spark.createDataFrame([(1, 800), (3, 800), (0, 0), (1, 3)], "a int, b int")
    assert [r[0] for r in df.select(P.percent(F.col("a"), F.col("b"))).collect()] == [0.12, 0.38, 0.0, 33.33]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(-20000, 40000), st.integers(0, 800)), min_size=30, max_size=60))
def test_business_days(spark, pairs):
    start = date(1970, 1, 1)
    rows = [(start + timedelta(a), start + timedelta(a + d)) for a, d in pairs]
    df = spark.createDataFrame(rows, "a date, b date")
    found = [r[0] for r in df.select(P.business_days(F.col("a"), F.col("b"))).collect()]
    assert found == [int(np.busday_count(a, b)) for a, b in rows]


def test_nan_becomes_null(spark):
    df = normalise(spark.createDataFrame([(float("nan"), 1), (2.0, None)], "`a-b` double, c int"))
    assert [tuple(r) for r in df.collect()] == [(None, 1), (2.0, None)]
