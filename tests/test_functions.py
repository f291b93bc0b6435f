from __future__ import annotations

from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from headway.functions import semantic as S
from headway.functions import times


def one(spark, value, build, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(build(F.col("x")).alias("y")).first()[0]


GOLDEN = [
    (S.color, "0039a6", "0039A6"),
    (S.color, "#0039A6", None),
    (S.color, "ZZZZZZ", None),
    (S.currency_code, "eur", "EUR"),
    (S.currency_code, "EURO", None),
    (S.service_date, "20180913", date(2018, 9, 13)),
    (S.service_date, " 2018-09-13\n", date(2018, 9, 13)),
    (S.service_date, "20180230", None),
    (S.service_date, "00000101", None),
    (S.service_date, "2018", None),
    (S.gtfs_time, "1:05:00", 3900),
    (S.gtfs_time, "25:35:00", 92100),
    (S.gtfs_time, "125:05:00", 450300),
    (S.gtfs_time, "\t7:00:00 ", 25200),
    (S.gtfs_time, "1000:00:00", None),
    (S.gtfs_time, "1:60:00", None),
    (S.gtfs_time, "1:5:00", None),
    (S.gtfs_time, "x", None),
    (S.gtfs_time, "  ", None),
    (S.local_time, "23:59:59", "23:59:59"),
    (S.local_time, "24:00:00", None),
    (S.local_time, "    7:00:00    ", "07:00:00"),
    (S.language, "en", "en"),
    (S.language, "en-US", "en-US"),
    (S.language, "en_US", None),
    (S.language, "en\n", None),
    (S.timezone, "America/Los Angeles", None),
    (S.timezone, "UTC", "UTC"),
    (S.timezone, "../x", None),
    (S.timezone, "America", None),
    (S.timezone, "+05:00", None),
    (S.latitude, "90", Decimal(90)),
    (S.latitude, "-90", Decimal(-90)),
    (S.latitude, "90.000001", None),
    (S.longitude, "180", Decimal(180)),
    (S.longitude, "-180.000001", None),
    (S.latitude, "9.1234567", None),
    (S.latitude, "north", None),
    (S.phone, "+506 2222-3333", "+506 2222-3333"),
    (S.phone, "abc", None),
    (S.email, "a.b@example.org", "a.b@example.org"),
    (S.email, "a@@example.org", None),
    (S.email, "a..b@example.org", None),
    (S.url, "https://example.org:8080/a?b#c", "https://example.org:8080/a?b#c"),
    (S.url, "example.org", None),
    (S.url, "http://a b.org", None),
    (S.text, "x" * 255, "x" * 255),
    (S.text, "x" * 256, None),
    (S.boolean, "1", True),
    (S.boolean, "False", False),
    (S.boolean, "2", None),
    (S.json_text, '{"a": 1}', '{"a": 1}'),
    (S.json_text, "{", None),
]


@pytest.mark.parametrize(("kind", "value", "expected"), GOLDEN)
def test_golden(spark, kind, value, expected):
    assert one(spark, value, kind().parse) == (expected.quantize(Decimal("0.000001")) if isinstance(expected, Decimal) else expected)
    assert (one(spark, value, kind().violation) is None) == (expected is not None)


@pytest.mark.parametrize("kind", [k for k, _, _ in {g[0]: g for g in GOLDEN}.values()])
def test_absent_values_break_no_rule(spark, kind):
    assert one(spark, None, kind().violation) is None
    assert one(spark, "", kind().violation) is None
    assert one(spark, None, kind().parse) is None


def test_identifiers(spark):
    assert one(spark, "stop 1", S.identifier(printable_ascii=True).violation) is None
    assert one(spark, "parada-ñ", S.identifier(printable_ascii=True).violation) == "invalid"
    assert one(spark, "parada-ñ", S.identifier().violation) is None


def test_enumerations(spark):
    assert one(spark, "3", S.enum_int([1, 3]).parse) == 3
    assert one(spark, "2", S.enum_int([1, 3]).violation) == "choice"
    assert one(spark, "x", S.enum_int([1, 3]).violation) == "invalid"
    assert one(spark, "b", S.enum_str(["a"]).violation) == "choice"
    for make in (S.enum_int, S.enum_str):
        with pytest.raises(TypeError):
            make([])


def test_decimals_are_not_rounded(spark):
    assert one(spark, "1.2345", S.decimal(6, 4).parse) == Decimal("1.2345")
    assert one(spark, "1.23456", S.decimal(6, 4).violation) == "max_decimal_places"
    assert one(spark, "100.5", S.decimal(6, 4).violation) == "max_digits"
    assert one(spark, "-3.5", S.currency_amount().parse) == Decimal("-3.500000")


def test_rendering(spark):
    assert one(spark, 450300, S.gtfs_time().render, "int") == "125:05:00"
    assert one(spark, None, S.gtfs_time().render, "int") == ""
    assert one(spark, date(2018, 9, 13), S.service_date().render, "date") == "20180913"
    assert one(spark, None, S.service_date().render, "date") == ""
    assert one(spark, True, S.boolean().render, "boolean") == "1"


def test_durations(spark):
    assert one(spark, "25:35:00", times.time_to_interval) == timedelta(hours=25, minutes=35)
    assert one(spark, timedelta(hours=25, minutes=35), times.format_interval, "interval day to second") == "25:35:00"
    assert one(spark, -1, times.format_seconds, "int") is None
    assert one(spark, -0.5, times.format_seconds, "double") == "00:00:00"
    assert one(spark, 1.9, times.format_seconds, "double") == "00:00:01"


def test_service_instant_counts_from_noon(spark):
    """On the day that clocks go forward, a service day begins at 23:00 of the day before."""
    row = spark.createDataFrame([(date(2024, 3, 31), 8 * 3600)], "d date, s int")
    got = row.select(times.service_instant(F.col("d"), F.col("s"), F.lit("Europe/Berlin")).cast("string")).first()[0]
    assert datetime.fromisoformat(got) == datetime(2024, 3, 31, 6)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 3_599_999), min_size=200, max_size=400))
def test_seconds_round_trip(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x int")
    text = times.format_seconds(F.col("x"))
    assert df.where(~times.time_to_seconds(text).eqNullSafe(F.col("x"))).count() == 0
    assert df.where(~times.normalize_time(text).eqNullSafe(text)).count() == 0
