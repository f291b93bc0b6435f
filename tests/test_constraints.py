from __future__ import annotations

from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

from headway import catalog
from headway.operators import constraints, service


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1), (None, 2)], "k string, n int")
    assert rows(constraints.duplicate_keys(df, ["k", "n"])) == [("a", 1, 2)]
    assert constraints.null_keys(df, ["k"]).count() == 1


def test_orphans(spark):
    parent = spark.createDataFrame([("a",), (None,)], "id string")
    child = spark.createDataFrame([("a", 1), ("x", 2), (None, 3)], "p string, n int")
    assert rows(constraints.orphans(child, parent, ["p"], ["id"])) == [("x", 2), (None, 3)]
    assert rows(constraints.orphans(child, parent, ["p"], ["id"], nullable=True)) == [("x", 2)]


def test_cascade_runs_through_all_tables(spark):
    tables = {
        "feed_message": spark.createDataFrame([("m1",), ("m2",)], "feed_message_id string"),
        "trip_update": spark.createDataFrame([("e1", "m1"), ("e1", "m2")], "entity_id string, feed_message string"),
        "stop_time_update": spark.createDataFrame([("m1", "e1", 1), ("m2", "e1", 1)], "feed_message string, trip_update string, stop_sequence int"),
        "vehicle_position": spark.createDataFrame([("v1", "m1"), ("v2", None)], "entity_id string, feed_message string"),
    }
    gone = spark.createDataFrame([("m1",)], "feed_message_id string")
    left = constraints.delete_cascade(tables, "feed_message", gone)
    assert rows(left["feed_message"]) == [("m2",)]
    assert rows(left["trip_update"]) == [("m2", "e1")] or rows(left["trip_update"]) == [("e1", "m2")]
    assert rows(left["stop_time_update"].select("feed_message")) == [("m2",)]
    assert rows(left["vehicle_position"].select("entity_id")) == [("v2",)]


def test_latest_and_order(spark):
    old = spark.createDataFrame([("a", 1, "x"), ("b", 5, "y")], "k string, t int, v string")
    new = spark.createDataFrame([("a", 2, "z"), ("b", 4, None)], "k string, t int, v string")
    assert rows(constraints.upsert(old, new, ["k"], "t")) == [("a", 2, "z"), ("b", 5, "y")]
    stamped = spark.createDataFrame([(1,), (3,), (2,)], "timestamp int")
    assert [r[0] for r in constraints.ordered(stamped, catalog.FEED_MESSAGE).collect()] == [3, 2, 1]


def test_mixed_kinds(spark):
    df = spark.createDataFrame([("m", "trip_update"), ("m", "vehicle"), ("n", "alert"), ("n", "alert")], "m string, kind string")
    assert rows(constraints.mixed_kinds(df, "m", "kind")) == [("m", 2)]


def test_service_days(spark):
    calendar = spark.createDataFrame([("s", *[i < 5 for i in range(7)], date(2024, 1, 1), date(2024, 1, 7)), ("t", *[True] * 7, date(2024, 1, 2), date(2024, 1, 1))], catalog.CALENDAR.schema())
    exceptions = spark.createDataFrame([("s", date(2024, 1, 2), 2), ("s", date(2024, 1, 6), 1), ("u", date(2024, 1, 1), 1)], "service_id string, date date, exception_type int")
    got = rows(service.service_days(calendar, exceptions))
    assert got == [("s", date(2024, 1, d)) for d in (1, 3, 4, 5, 6)] + [("u", date(2024, 1, 1))]


def test_stop_time_estimates(spark):
    kind = "trip_id string, stop_sequence int, arrival_time int, departure_time int, shape_dist_traveled decimal(18,6)"
    d = Decimal
    given = [("a", 1, 100, 110, d(0)), ("a", 2, None, None, d(1)), ("a", 3, 210, None, d(4)), ("a", 4, None, None, d(5)), ("b", 1, 0, 0, None), ("b", 3, None, None, None), ("b", 5, 100, 100, None)]
    got = service.estimate_stop_times(spark.createDataFrame(given, kind)).orderBy("trip_id", "stop_sequence").select("estimated_arrival", "estimated_departure")
    assert [tuple(r) for r in got.collect()] == [(100, 110), (135, 135), (210, 210), (None, None), (0, 0), (50, 50), (100, 100)]


def test_delays(spark):
    plan = spark.createDataFrame([("t", 1, 100, 110), ("t", 2, 200, 210)], "trip_id string, stop_sequence int, arrival_time int, departure_time int")
    live = spark.createDataFrame([("t", 2, 30, None), ("x", 1, 5, 5)], "trip_trip_id string, stop_sequence int, arrival_delay int, departure_delay int")
    got = service.delays(plan, live).orderBy("stop_sequence").select("expected_arrival", "expected_departure").collect()
    assert [tuple(r) for r in got] == [(100, 110), (230, 210)]
    assert service.delays(plan, live).where(F.col("arrival_delay").isNotNull()).count() == 1
