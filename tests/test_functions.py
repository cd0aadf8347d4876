import datetime as dt

import pytest
from pyspark.sql import functions as F

from millrace.functions import cleansing, dates, text
from millrace.functions.durations import iso_duration_seconds


def one(spark, value, expression, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expression(F.col("x"))).first()[0]


@pytest.mark.parametrize("given, seconds, legacy", [
    ("PT8H0M0S", 28800, 28800),
    ("PT8H8M0S", 29280, 960),
    ("PT5H0M5S", 18005, 10),
    ("P1DT2H", 7200, 7200),
    ("PT8H30M0.5S", 30600, 30600),
    ("PT90M", 5400, 5400),
    ("P2D", 0, 0),
    ("PT7H7M7S", 25627, 21),
    ("PT9999999999H0M0S", 35999999996400, 35999999996400),
    ("", None, None),
    ("8 hours", None, None),
    (None, None, None),
])
def test_durations(spark, given, seconds, legacy):
    assert one(spark, given, iso_duration_seconds) == seconds
    assert one(spark, given, lambda c: iso_duration_seconds(c, legacy=True)) == legacy


@pytest.mark.parametrize("given", ["", "a", "Zürich 12", "tab\tline\n", "8 bits!!", "€ wide", "🙂", "x" * 100, "é" * 17])
def test_bits(spark, given):
    assert one(spark, given, cleansing.string_to_bits) == "".join(format(ord(c), "08b") for c in given)


def test_bits_of_null(spark):
    assert one(spark, None, cleansing.string_to_bits) is None


@pytest.mark.parametrize("given, canonical", [
    ("datetime2", "DATETIME"), ("TIMESTAMP", "DATETIME"), ("decimal", "NUMERIC"), ("int", "INTEGER"),
    ("tinyint", "BIT"), ("sql_variant", "BLOB"), ("nchar", "VARCHAR"), ("double", "FLOAT"), ("money", "MONEY"),
])
def test_types(spark, given, canonical):
    assert one(spark, given, cleansing.standardise_type) == canonical


def test_dates(spark):
    assert one(spark, "2024-02-03T04:05:06", dates.cast_datetime) == dt.datetime(2024, 2, 3, 4, 5, 6)
    assert one(spark, "soon", dates.cast_datetime) is None
    assert one(spark, "0", dates.zero_to_null_date) is None
    assert one(spark, " ", dates.blank_date_to_sentinel) == "2999-12-31"
    assert one(spark, "2999-12-31", dates.date_sentinel_roundtrip) is None
    moment = dt.datetime(2024, 3, 1, 12, 0, 0, 123456)
    assert one(spark, moment, dates.format_seconds, "timestamp_ntz") == "2024-03-01 12:00:00"
    assert str(one(spark, moment, dates.epoch_seconds, "timestamp_ntz")) == "1709294400.123456"
    assert one(spark, moment, dates.day_end, "timestamp_ntz") == dt.datetime(2024, 3, 1, 23, 59, 59, 999999)
    assert one(spark, moment, dates.previous_day_end, "timestamp_ntz") == dt.datetime(2024, 2, 29, 23, 59, 59, 999999)
    early = dt.datetime(1969, 12, 31, 23, 59, 59, 500000)
    assert str(one(spark, early, dates.epoch_seconds, "timestamp_ntz")) == "-0.500000"


def test_epoch_seconds_ignores_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        moment = dt.datetime(2024, 3, 10, 12, 0, 0)
        assert str(one(spark, moment, dates.epoch_seconds, "timestamp_ntz")) == "1710072000.000000"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_file_names(spark):
    name = "/in/MS_PR000001_01_20240101.xml"
    assert one(spark, name, cleansing.base_name) == "MS_PR000001_01_20240101.xml"
    assert one(spark, name, cleansing.file_stem) == "MS_PR000001_01_20240101"
    assert one(spark, name, lambda c: cleansing.file_segment(c, 2)) == "PR000001"
    assert one(spark, name, lambda c: cleansing.file_segment(c, 9)) is None
    assert one(spark, "MS_PR000001_01_20240101.xml", cleansing.substring_project_id) == "PR000001"


@pytest.mark.parametrize("given, tag, rest", [
    (":a: hello", ":a:", "hello"),
    ("hello :a: and :b:", ":b:", "hello  and "),       # two tags: the last one wins
    (":a::b:x", ":b:", "x"),
    (":ab: x", "", ":ab: x"),                            # a code only matches whole
    ("x_y", "", "x_y"),
    (None, "", None),
])
def test_last_tag(spark, given, tag, rest):
    got = one(spark, given, lambda c: text.strip_last_tag(c, [":a:", ":b:"]))
    assert (got["tag"], got["text"]) == (tag, rest)


def test_codes_are_literal(spark):
    # An underscore is no wildcard.
    assert one(spark, "axb", lambda c: text.strip_last_tag(c, ["a_b"]))["tag"] == ""
    assert one(spark, "a_b", lambda c: text.strip_last_tag(c, ["a_b"]))["tag"] == "a_b"


def test_overlapping_codes_see_the_edited_text(spark):
    # Cutting "bc" out of "abcd" leaves "ad": the next code is found only then.
    got = one(spark, "abcd", lambda c: text.strip_all_values(c, ["bc", "ad"]))
    assert (got["text"], got["values"]) == ("", ["bc", "ad"])
    assert one(spark, "abcd", lambda c: text.reversed_pipe_list(
        text.strip_all_values(c, ["bc", "ad"])["values"])) == "ad|bc|"


def test_no_codes(spark):
    assert one(spark, "abc", lambda c: text.strip_all_values(c, []))["values"] == []


def test_mentions(spark):
    given = "hi <@U00000001> and <@W00000002>\n thanks "
    assert one(spark, given, text.mention_ids) == ["U00000001", "W00000002"]
    assert one(spark, given, text.text_after_mentions).strip() == "thanks"
    assert one(spark, "plain", text.mention_ids) == []
    assert one(spark, "plain", text.text_after_mentions) == "plain"
    assert one(spark, "plain", lambda c: text.text_after_mentions(c, legacy=True)) is None


@pytest.mark.parametrize("user_id, valid, legacy", [
    ("U1234567A", True, False), ("W12345678", True, False), ("AU2345678", False, True),
    ("U123", False, False), ("u12345678", False, False), ("U1234567W", True, True),
])
def test_user_ids(spark, user_id, valid, legacy):
    assert one(spark, user_id, text.valid_user_id) is valid
    assert one(spark, user_id, lambda c: text.valid_user_id(c, legacy=True)) is legacy


@pytest.mark.parametrize("to, values, message", [
    (["a"], ["v"], "@a :t: hi v"),
    (["a", "b"], ["v"], "@a @b :t: hi v"),
    (["a"], ["v", "w"], "@a :t: hi v w"),
    (["a", "b"], [" "], "@a @b :t: hi  "),
])
def test_composed_message(spark, to, values, message):
    df = spark.createDataFrame([(to, values)], "t array<string>, v array<string>")
    got = df.select(text.compose_message(F.col("t"), F.lit(":t:"), F.lit("hi"), F.col("v"))).first()[0]
    assert got == message


def test_reactions(spark):
    df = spark.createDataFrame([([":v:", ":w:"],), ([" "],)], "v array<string>")
    got = [r[0] for r in df.select(text.reactions(F.lit(":t:"), F.col("v"))).collect()]
    assert got == [["t", "v", "t", "w"], ["t"]]
