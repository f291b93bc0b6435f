"""Realtime messages, decoded to nested structs, as flat tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import times


def _entities(messages: DataFrame, kind: str) -> DataFrame:
    return messages.where("message is not null").select("feed_message_id", F.explode("message.entity").alias("e")).where(f"e.{kind} is not null")


def _when(c: str) -> Column:
    return F.timestamp_seconds(F.col(c))


def _trip(path: str, prefix: str) -> list[Column]:
    date, start = F.col(f"{path}.start_date"), F.col(f"{path}.start_time")
    return [
        F.col(f"{path}.trip_id").alias(f"{prefix}trip_id"),
        F.col(f"{path}.route_id").alias(f"{prefix}route_id"),
        F.col(f"{path}.direction_id").alias(f"{prefix}direction_id"),
        times.time_to_seconds(start).alias(f"{prefix}start_time"),
        times.service_date(date).alias(f"{prefix}start_date"),
        F.col(f"{path}.schedule_relationship").alias(f"{prefix}schedule_relationship"),
    ]


def _vehicle(path: str, prefix: str) -> list[Column]:
    return [F.col(f"{path}.{c}").alias(f"{prefix}{c}") for c in ("id", "label", "license_plate", "wheelchair_accessible")]


def feed_messages(messages: DataFrame) -> DataFrame:
    """A row per message, with the header's own time beside that of ingestion; the kind is that of the first entity that has one."""
    kind = lambda e: F.when(e["trip_update"].isNotNull(), "trip_update").when(e["vehicle"].isNotNull(), "vehicle").when(e["alert"].isNotNull(), "alert")
    kinds = F.filter(F.transform("message.entity", kind), lambda k: k.isNotNull())
    return messages.where("message is not null").select(
        "feed_message_id",
        F.get(kinds, F.lit(0)).alias("entity_type"),
        F.current_timestamp().alias("timestamp"),
        F.coalesce("message.header.incrementality", F.lit("FULL_DATASET")).alias("incrementality"),
        F.col("message.header.gtfs_realtime_version").alias("gtfs_realtime_version"),
        _when("message.header.timestamp").alias("header_timestamp"),
    )


def entity_kinds(messages: DataFrame) -> DataFrame:
    """feed_message_id and kind of each entity, for the check that a message has one kind alone."""
    kinds = F.array(*(F.when(F.col(f"e.{k}").isNotNull(), F.lit(k)) for k in ("trip_update", "vehicle", "alert")))
    exploded = messages.where("message is not null").select("feed_message_id", F.explode("message.entity").alias("e"))
    return exploded.select("feed_message_id", F.explode(F.filter(kinds, lambda k: k.isNotNull())).alias("kind"))


def trip_updates(messages: DataFrame) -> DataFrame:
    return _entities(messages, "trip_update").select(
        F.col("e.id").alias("entity_id"),
        F.col("feed_message_id").alias("feed_message"),
        *_trip("e.trip_update.trip", "trip_"),
        *_vehicle("e.trip_update.vehicle", "vehicle_"),
        _when("e.trip_update.timestamp").alias("timestamp"),
        F.col("e.trip_update.delay").alias("delay"),
    )


def stop_time_updates(messages: DataFrame) -> DataFrame:
    updates = _entities(messages, "trip_update").select("feed_message_id", F.col("e.id").alias("entity_id"), F.explode("e.trip_update.stop_time_update").alias("u"))
    event = lambda name: [F.col(f"u.{name}.delay").alias(f"{name}_delay"), _when(f"u.{name}.time").alias(f"{name}_time"), F.col(f"u.{name}.uncertainty").alias(f"{name}_uncertainty")]
    return updates.select(
        F.col("feed_message_id").alias("feed_message"),
        F.col("entity_id").alias("trip_update"),
        F.col("u.stop_sequence").alias("stop_sequence"),
        F.col("u.stop_id").alias("stop_id"),
        *event("arrival"),
        *event("departure"),
        F.col("u.departure_occupancy_status").alias("departure_occupancy_status"),
        F.col("u.schedule_relationship").alias("schedule_relationship"),
    )


def vehicle_positions(messages: DataFrame) -> DataFrame:
    return _entities(messages, "vehicle").select(
        F.col("e.id").alias("entity_id"),
        F.col("feed_message_id").alias("feed_message"),
        *_trip("e.vehicle.trip", "vehicle_trip_"),
        *_vehicle("e.vehicle.vehicle", "vehicle_vehicle_"),
        *(F.col(f"e.vehicle.position.{c}").cast("double").alias(f"vehicle_position_{c}") for c in ("latitude", "longitude", "bearing", "odometer", "speed")),
        F.col("e.vehicle.current_stop_sequence").alias("vehicle_current_stop_sequence"),
        F.col("e.vehicle.stop_id").alias("vehicle_stop_id"),
        F.col("e.vehicle.current_status").alias("vehicle_current_status"),
        _when("e.vehicle.timestamp").alias("vehicle_timestamp"),
        F.col("e.vehicle.congestion_level").alias("vehicle_congestion_level"),
        F.col("e.vehicle.occupancy_status").alias("vehicle_occupancy_status"),
        F.col("e.vehicle.occupancy_percentage").cast("double").alias("vehicle_occupancy_percentage"),
    )
