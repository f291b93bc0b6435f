"""Registered queries of whole feeds: messages made, encoded, decoded and flattened; schedules written, read and checked."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..catalog import CALENDAR, STOP_TIMES, STOPS
from ..config import show_settings
from ..operators import flatten
from ..sources import realtime, schedule, wire
from ..storage import shared_dir
from .queries import query, table
from .validation import feed_violations, summary

_MESSAGE = wire.schema()


def _shaped(kind: T.DataType, given: object) -> Column:
    """A value of a nested type: dictionaries are structs, other fields are absent."""
    if given is None:
        return F.lit(None).cast(kind)
    if isinstance(given, dict):
        return F.struct(*(_shaped(f.dataType, given.get(f.name)).alias(f.name) for f in kind.fields))
    return given if isinstance(given, Column) else F.lit(given).cast(kind)


def _entity(given: dict) -> Column:
    return _shaped(_MESSAGE["entity"].dataType.elementType, given)


def _messages(rows: DataFrame, entity: Column) -> DataFrame:
    """A message for each row, of one entity."""
    header = {"gtfs_realtime_version": "2.0", "incrementality": F.when(F.col("k") % 3 > 0, "FULL_DATASET"), "timestamp": F.col("k") + 1_700_000_000}
    message = F.struct(_shaped(_MESSAGE["header"].dataType, header).alias("header"), F.array(entity).alias("entity"))
    return rows.select(F.concat(F.lit("m"), F.col("k")).alias("feed_message_id"), message.alias("message"))


def _trip_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as trips, with their lines as stops; odd ones without a vehicle."""
    update = _MESSAGE["entity"].dataType.elementType["trip_update"].dataType["stop_time_update"].dataType.elementType
    stop = _shaped(update, {"stop_sequence": F.col("l_linenumber").cast("long"), "stop_id": F.concat(F.lit("s"), F.col("l_suppkey")), "arrival": {"delay": F.col("l_quantity").cast("long"), "time": F.col("l_partkey") + 1_700_000_000}, "schedule_relationship": F.when(F.col("l_returnflag") == "R", "SKIPPED")})
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.collect_list(stop).alias("stops"))
    rows = table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "k").join(lines, "k")
    trip = {"trip_id": F.concat(F.lit("t"), F.col("k")), "start_time": F.format_string("%d:%02d:00", F.col("k") % 40, F.col("k") % 70), "start_date": F.date_format("o_orderdate", "yyyyMMdd"), "schedule_relationship": "ADDED", "route_id": F.col("o_custkey").cast("string"), "direction_id": F.col("k") % 2}
    vehicle = _shaped(_MESSAGE["entity"].dataType.elementType["trip_update"].dataType["vehicle"].dataType, {"id": F.concat(F.lit("v"), F.col("o_custkey")), "label": F.col("o_orderpriority")})
    given = {"trip": trip, "vehicle": F.when(F.col("k") % 2 == 0, vehicle), "timestamp": F.col("k") + 1_600_000_000, "delay": F.col("k") % 600 - 300, "stop_time_update": F.col("stops")}
    return _messages(rows, _entity({"id": F.concat(F.lit("e"), F.col("k")), "trip_update": given}))


def _vehicle_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as vehicles."""
    rows = table(spark, sf_dir, "supplier").withColumnRenamed("s_suppkey", "k")
    given = {"trip": {"trip_id": F.concat(F.lit("t"), F.col("k"))}, "position": {"latitude": F.floor("s_acctbal").cast("double") / 128, "bearing": (F.col("k") % 360).cast("double")}, "current_stop_sequence": F.col("k") % 50, "stop_id": F.col("s_name"), "current_status": "STOPPED_AT", "timestamp": F.col("k") + 1_650_000_000, "vehicle": {"id": F.concat(F.lit("v"), F.col("s_nationkey"))}, "occupancy_percentage": F.col("k") % 101}
    return _messages(rows, _entity({"id": F.concat(F.lit("e"), F.col("k")), "vehicle": given}))


_SQL_HEADER = "'FULL_DATASET' AS incrementality, '2.0' AS gtfs_realtime_version, CAST(k + 1700000000 AS BIGINT) AS stamp"  # the default where the header has none


@query(f"""
SELECT 'm' || k AS feed_message_id, 'trip_update' AS entity_type, {_SQL_HEADER} FROM (SELECT DISTINCT l_orderkey AS k FROM lineitem)
UNION ALL SELECT 'm' || s_suppkey, 'vehicle', {_SQL_HEADER.replace("k +", "s_suppkey +")} FROM supplier
""")
def realtime_feed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _trip_messages(spark, sf_dir).unionByName(_vehicle_messages(spark, sf_dir))
    return flatten.feed_messages(rows).select("feed_message_id", "entity_type", "incrementality", "gtfs_realtime_version", F.unix_seconds("header_timestamp").alias("stamp"))


@query("""
SELECT 'e' || k AS entity_id, 'm' || k AS feed_message, 't' || k AS trip_trip_id, CAST(o_custkey AS VARCHAR) AS trip_route_id, CAST(k % 2 AS BIGINT) AS trip_direction_id,
  CASE WHEN k % 70 < 60 THEN CAST(k % 40 * 3600 + k % 70 * 60 AS INTEGER) END AS trip_start_time, CAST(o_orderdate AS DATE) AS trip_start_date, 'ADDED' AS trip_schedule_relationship,
  CASE WHEN k % 2 = 0 THEN 'v' || o_custkey END AS vehicle_id, CASE WHEN k % 2 = 0 THEN o_orderpriority END AS vehicle_label, CAST(k + 1600000000 AS BIGINT) AS stamp, CAST(k % 600 - 300 AS BIGINT) AS delay
FROM (SELECT *, o_orderkey AS k FROM orders) WHERE k IN (SELECT l_orderkey FROM lineitem)
""")
def realtime_trip_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = flatten.trip_updates(_trip_messages(spark, sf_dir))
    return flat.withColumn("stamp", F.unix_seconds("timestamp")).drop("timestamp", "vehicle_license_plate", "vehicle_wheelchair_accessible")


_SQL_STOPS = """
SELECT 'e' || l_orderkey AS trip_update, CAST(l_linenumber AS BIGINT) AS stop_sequence, 's' || l_suppkey AS stop_id, CAST(l_quantity AS BIGINT) AS arrival_delay,
  CAST(l_partkey + 1700000000 AS BIGINT) AS stamp, CASE WHEN l_returnflag = 'R' THEN 'SKIPPED' END AS schedule_relationship
FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders)
"""


def _stops(messages: DataFrame) -> DataFrame:
    flat = flatten.stop_time_updates(messages)
    return flat.select("trip_update", "stop_sequence", "stop_id", "arrival_delay", F.unix_seconds("arrival_time").alias("stamp"), "schedule_relationship")


@query(_SQL_STOPS)
def flatten_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines gathered to a message for each order, and flattened again."""
    return _stops(_trip_messages(spark, sf_dir))


@query(_SQL_STOPS)
def realtime_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same messages as bytes of the wire format, decoded."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([wire.encode(m) for m in batch.column("message").to_pylist()], pa.binary())], ["payload"])

    return _stops(realtime.decode_messages(_trip_messages(spark, sf_dir).mapInArrow(run, "payload binary")))


@query("""
SELECT 'e' || s_suppkey AS entity_id, 'm' || s_suppkey AS feed_message, 't' || s_suppkey AS vehicle_trip_trip_id, 'v' || s_nationkey AS vehicle_vehicle_id, CAST(floor(s_acctbal) AS BIGINT) AS latitude,
  CAST(s_suppkey % 360 AS BIGINT) AS bearing, CAST(s_suppkey % 50 AS BIGINT) AS vehicle_current_stop_sequence, s_name AS vehicle_stop_id, 'STOPPED_AT' AS vehicle_current_status, CAST(s_suppkey + 1650000000 AS BIGINT) AS stamp, CAST(s_suppkey % 101 AS BIGINT) AS percentage
FROM supplier
""")
def realtime_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = flatten.vehicle_positions(_vehicle_messages(spark, sf_dir))
    numbers = [(F.col("vehicle_position_latitude") * 128).cast("long").alias("latitude"), F.col("vehicle_position_bearing").cast("long").alias("bearing"), F.unix_seconds("vehicle_timestamp").alias("stamp"), F.col("vehicle_occupancy_percentage").cast("long").alias("percentage")]
    return flat.select("entity_id", "feed_message", "vehicle_trip_trip_id", "vehicle_vehicle_id", "vehicle_current_stop_sequence", "vehicle_stop_id", "vehicle_current_status", *numbers)


@query("SELECT false AS validation_enabled, CAST(NULL AS VARCHAR) AS reference_source")
def settings_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = show_settings(spark)
    return spark.createDataFrame([tuple(found.values())], "validation_enabled boolean, reference_source string")


def _filled(df: DataFrame, spec, **given: Column) -> DataFrame:
    return df.select(*(given.get(c.name, F.lit(None)).cast(c.kind.spark_type).alias(c.name) for c in spec.columns))


@query("""
SELECT CAST(o_orderkey AS VARCHAR) AS trip_id, CAST(o_orderkey % 9 AS INTEGER) AS stop_sequence, CASE WHEN o_orderkey % 4 > 0 THEN CAST(o_orderkey * 37 % 100000 AS INTEGER) END AS arrival_time,
  CAST(o_orderkey % 990000 AS BIGINT) AS distance, o_orderkey % 2 = 0 AS timepoint, CASE WHEN s_suppkey % 2 = 0 THEN 'Stop "' || s_suppkey || '", north' ELSE 'Stop ' || s_suppkey END AS stop_name,
  CASE WHEN s_suppkey % 3 > 0 THEN CAST(floor(s_acctbal) AS BIGINT) END AS latitude, DATE '2024-01-01' + CAST(s_suppkey % 300 AS INTEGER) AS start_date, s_suppkey % 2 = 0 AS sunday
FROM orders JOIN supplier ON s_suppkey = o_orderkey % 10 + 1
""")
def schedule_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed written to an archive, imported from it, stored by feed and loaded; its tables joined again."""
    k, o = F.col("s_suppkey"), F.col("o_orderkey")
    suppliers, orders = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "orders")
    name = F.when(k % 2 == 0, F.concat(F.lit('Stop "'), k, F.lit('", north'))).otherwise(F.concat(F.lit("Stop "), k))
    days = {d: F.lit(True) for d in ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday")} | {"sunday": k % 2 == 0}
    tables = {
        "stops": _filled(suppliers, STOPS, stop_id=k, stop_name=name, stop_lat=F.when(k % 3 > 0, F.floor("s_acctbal") / 1000), parent_station=F.lit(""), stop_timezone=F.lit(""), platform_code=F.lit("")),
        "calendar": _filled(suppliers, CALENDAR, service_id=k, start_date=F.date_add(F.lit("2024-01-01").cast("date"), (k % 300).cast("int")), end_date=F.lit("2025-01-01"), **days),
        "stop_times": _filled(orders, STOP_TIMES, trip_id=o, stop_id=o % 10 + 1, stop_sequence=o % 9, arrival_time=F.when(o % 4 > 0, o * 37 % 100000), pickup_type=F.lit(0), drop_off_type=F.lit(0), shape_dist_traveled=(o % 990000) / 10000, timepoint=o % 2 == 0),
    }
    folder = shared_dir(spark)
    schedule.export_schedule(tables, f"{folder}/feed.zip")
    schedule.save(schedule.import_schedule(spark, f"{folder}/feed.zip", "feed"), f"{folder}/store")
    found = schedule.load(spark, f"{folder}/store")
    stops, calendar, at = (found[t].where("feed_id = 'feed'") for t in ("stops", "calendar", "stop_times"))
    joined = at.join(stops, "stop_id").join(calendar.withColumnRenamed("service_id", "stop_id"), "stop_id")
    return joined.select("trip_id", "stop_sequence", "arrival_time", (F.col("shape_dist_traveled") * 10000).cast("long").alias("distance"), "timepoint", "stop_name", F.round(F.col("stop_lat") * 1000).cast("long").alias("latitude"), "start_date", "sunday")


@query("""
WITH s AS (SELECT CAST(s_suppkey // 3 AS VARCHAR) AS stop_id, s_suppkey AS k FROM supplier
), t AS (SELECT CAST(o_custkey AS VARCHAR) AS trip_id, CAST(o_orderkey % 4 - 1 AS VARCHAR) AS stop_sequence, CAST(o_orderkey % 60 AS VARCHAR) AS stop_id, o_orderkey AS k FROM orders
), v AS (
  SELECT 'stops' AS "table", 'stop_id' AS "column", 'unique' AS code FROM s GROUP BY stop_id HAVING count(*) > 1
  UNION ALL SELECT 'stops', 'parent_station', 'reference' FROM s WHERE k % 5 = 0
  UNION ALL SELECT 'stop_times', 'trip_id/stop_sequence', 'unique' FROM t GROUP BY trip_id, stop_sequence HAVING count(*) > 1
  UNION ALL SELECT 'stop_times', 'stop_id', 'reference' FROM t WHERE stop_id NOT IN (SELECT stop_id FROM s)
  UNION ALL SELECT 'stop_times', 'stop_sequence', 'min_value' FROM t WHERE stop_sequence = '-1'
  UNION ALL SELECT 'stop_times', 'arrival_time', 'invalid' FROM t WHERE k % 11 = 0
)
SELECT "table", "column", code, count(*) AS n FROM v GROUP BY ALL
""")
def feed_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells, keys and references of two tables of texts."""
    k, o = F.col("s_suppkey"), F.col("o_orderkey")
    text = lambda df, spec, **given: df.select(*(given.get(c.name, F.lit(None)).cast("string").alias(c.name) for c in spec.columns))
    raw = {
        "stops": text(table(spark, sf_dir, "supplier"), STOPS, stop_id=F.expr("s_suppkey div 3"), stop_name=F.lit("x"), parent_station=F.when(k % 5 == 0, "nowhere").otherwise("")),
        "stop_times": text(table(spark, sf_dir, "orders"), STOP_TIMES, trip_id=F.col("o_custkey"), stop_id=o % 60, stop_sequence=o % 4 - 1, arrival_time=F.when(o % 11 == 0, "x").otherwise("1:00:00"), pickup_type=F.lit("0"), drop_off_type=F.lit("0")),
    }
    return summary(feed_violations(raw))
