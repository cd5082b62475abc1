import datetime as dt

import pytest
from pyspark.sql import functions as F

from inciscope import config
from inciscope.functions import metrics, rules, temporal, text


def evaluate(spark, values, expr, schema="v string"):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {schema}")
    return [r[0] for r in frame.orderBy("i").select(expr(F.col("v"))).collect()]


def test_is_blank(spark):
    assert evaluate(spark, [None, "", "  ", " a "], text.is_blank) == [True, True, True, False]


def test_parse_flag(spark):
    values = ["TRUE", " false ", "True", "maybe", "", None, "1"]
    assert evaluate(spark, values, text.parse_flag) == [True, False, True, None, None, None, None]
    assert evaluate(spark, values, text.is_bad_flag) == [False, False, False, True, False, False, True]


def test_numeric_text_to_int(spark):
    values = ["1.0", " 12.9", "x", "", None, "-3", "1e3", "99999999999.0"]
    assert evaluate(spark, values, text.numeric_text_to_int) == [1, 12, None, None, None, -3, 1000, None]


@pytest.mark.parametrize("data_type", ["int", "bigint"])
def test_cast_or_null_equals_try_cast(spark, data_type):
    values = [
        "1", " 1 ", "\t1\n", "+7", "-7", "--7", "1.0", "1e3", "", " ", None, "abc", "2147483648", "-2147483648",
        "9223372036854775808", "1 2", "0x10", "１", "+", "1\x01", "007",
    ]
    expected = evaluate(spark, values, lambda c: c.try_cast(data_type))
    assert evaluate(spark, values, lambda c: text.cast_or_null(c, data_type)) == expected


def test_parse_timestamp_formats(spark):
    values = [
        "01/02/2003 11:04:05 PM", "01/02/2003 12:04:05 am", "1/2/2003 23:04", "12/31/2003 3:04", " 1/2/2003 0:00 ",
        "13/02/2003 11:04:05 PM", "garbage", "", None, "01/02/2003 23:04:05 PM", "1/2/2003", "at 12:00 PM",
    ]
    plain = [(f, None) for f, _ in config.TIMESTAMP_FORMATS]
    expected = evaluate(spark, values, lambda c: temporal.parse_timestamp(c, plain))
    assert evaluate(spark, values, temporal.parse_timestamp) == expected
    assert expected[:5] == [
        dt.datetime(2003, 1, 2, 23, 4, 5),
        dt.datetime(2003, 1, 2, 0, 4, 5),
        dt.datetime(2003, 1, 2, 23, 4),
        dt.datetime(2003, 12, 31, 3, 4),
        dt.datetime(2003, 1, 2, 0, 0),
    ]
    assert expected[5:] == [None] * 7


def test_calendar(spark):
    days = [dt.date(2017, 1, 1), dt.date(2016, 2, 29), dt.date(2015, 12, 31)]
    assert evaluate(spark, days, temporal.date_key, "v date") == [20170101, 20160229, 20151231]
    assert evaluate(spark, days, temporal.day_name, "v date") == ["Sunday", "Monday", "Thursday"]
    assert evaluate(spark, days, temporal.month_name, "v date") == ["January", "February", "December"]
    assert evaluate(spark, days, temporal.quarter_label, "v date") == ["Q1", "Q1", "Q4"]
    assert evaluate(spark, days, temporal.weekday_type, "v date") == ["Weekend", "Weekday", "Weekday"]
    assert evaluate(spark, days, lambda c: temporal.date_parts(c)["dayofweek"], "v date") == [1, 2, 5]


def test_coordinates_from_text(spark):
    values = ["(41.8, -87.6)", " (41.8,-87.6) ", "41.8, -87.6", "(a, b)", "", None]
    assert evaluate(spark, values, text.latitude_from_text) == [41.8, 41.8, None, None, None, None]
    assert evaluate(spark, values, text.longitude_from_text) == [-87.6, -87.6, None, None, None, None]


def test_pad_code(spark):
    assert evaluate(spark, ["4", " 04", "004", None], lambda c: text.pad_code(c, 3)) == ["004", "004", "004", None]


def test_first_rule_wins(spark):
    kinds = ["ROBBERY", "THEFT", "GAMBLING", None]
    classified = evaluate(spark, kinds, lambda c: rules.classify(c, config.CATEGORY_RULES, config.OTHER))
    assert classified == ["VIOLENT", "PROPERTY", "OTHER", "OTHER"]
    places = ["DRIVEWAY RESIDENTIAL", "HOSPITAL BUILDING / GROUNDS", "LIBRARY", "MOON"]
    assert evaluate(spark, places, lambda c: rules.classify(c, config.PLACE_RULES, config.OTHER)) == [
        "OUTDOOR / TRANSPORT", "COMMERCIAL", "INSTITUTIONAL", "OTHER",
    ]
    files = ["x_2001_to_2004.csv", "x_2012_to_2017.csv", "other", None]
    assert evaluate(spark, files, lambda c: rules.first_like(c, config.SOURCE_PERIODS, "UNKNOWN")) == [
        "2001_2004", "2012_2017", "UNKNOWN", "UNKNOWN",
    ]


def test_map_values(spark):
    mapped = evaluate(spark, ["a", "b", None], lambda c: rules.map_values(c, {"a": "first"}, F.concat(F.lit("? "), c)))
    assert mapped == ["first", "? b", None]
    assert evaluate(spark, ["a", "b"], lambda c: rules.map_values(c, {"a": "first"})) == ["first", None]


def test_rates_round_half_up(spark):
    frame = spark.createDataFrame([(201, 20000), (1, 800), (0, 0), (-1, 3)], "num int, den int")
    rates = [r[0] for r in frame.select(metrics.safe_pct(F.col("num"), F.col("den"))).collect()]
    assert rates == [1.01, 0.13, None, -33.33]


def test_conditional_counts_ignore_null(spark):
    frame = spark.createDataFrame([(True,), (False,), (None,), (True,)], "flag boolean")
    row = frame.agg(metrics.count_if(F.col("flag")), metrics.count_if(~F.col("flag")), metrics.rate_pct(F.col("flag"))).first()
    assert tuple(row) == (2, 1, 50.0)


def test_mode_takes_smallest_tie(spark):
    frame = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,), (None,), (None,)], "v string")
    assert frame.agg(metrics.mode_of(F.col("v"))).first()[0] == "a"


def test_average_of_rates_is_decimal(spark):
    frame = spark.createDataFrame([(20.01,)] * 7 + [(19.97,)], "v double")
    assert frame.agg(metrics.avg_of_rates(F.col("v"))).first()[0] == 20.01  # 20.005 exactly
