"""Extensions that follow from the feed format: service days, stop-time estimates, schedule against realtime."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

WEEKDAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")


def service_days(calendar: DataFrame, exceptions: DataFrame | None = None, keys: tuple[str, ...] = ("service_id",)) -> DataFrame:
    """``keys`` and date of every day of service: the weekly pattern, less exceptions of type 2, plus those of type 1."""
    runs = F.array(*(F.col(d) for d in WEEKDAYS))
    days = F.when(F.col("start_date") <= F.col("end_date"), F.sequence("start_date", "end_date"))
    every = calendar.select(*keys, F.explode(F.filter(days, lambda d: F.element_at(runs, F.weekday(d) + 1))).alias("date"))
    if exceptions is None:
        return every.distinct()
    removed = exceptions.where("exception_type = 2").select(*keys, "date")
    added = exceptions.where("exception_type = 1").select(*keys, "date")
    return every.join(removed, [*keys, "date"], "left_anti").unionByName(added).distinct()


def estimate_stop_times(stop_times: DataFrame, keys: tuple[str, ...] = ("trip_id",)) -> DataFrame:
    """Add ``estimated_arrival`` and ``estimated_departure`` (seconds): given times, else interpolated between the nearest given ones
    by distance where the trip has it at all three stops, else by sequence. Before the first and after the last given time: NULL."""
    order = Window.partitionBy(*keys).orderBy("stop_sequence")
    before, after = order.rowsBetween(Window.unboundedPreceding, 0), order.rowsBetween(0, Window.unboundedFollowing)
    at = F.coalesce("arrival_time", "departure_time")
    leave = F.coalesce("departure_time", "arrival_time")
    known = F.when(at.isNotNull(), F.struct(at.alias("at"), leave.alias("leave"), F.col("stop_sequence").alias("n"), F.col("shape_dist_traveled").cast("double").alias("d")))
    rows = stop_times.withColumn("_known", known).withColumn("_from", F.last("_known", True).over(before)).withColumn("_to", F.first("_known", True).over(after))
    here = F.col("shape_dist_traveled").cast("double")
    by_distance = (here - F.col("_from.d")) / F.nullif(F.col("_to.d") - F.col("_from.d"), F.lit(0.0))
    by_sequence = (F.col("stop_sequence") - F.col("_from.n")) / F.nullif(F.col("_to.n") - F.col("_from.n"), F.lit(0))
    share = F.coalesce(by_distance, by_sequence)
    between = F.round(F.col("_from.leave") + share * (F.col("_to.at") - F.col("_from.leave"))).cast("int")
    return rows.withColumn("estimated_arrival", F.coalesce(at, between)).withColumn("estimated_departure", F.coalesce(leave, between)).drop("_known", "_from", "_to")


def delays(stop_times: DataFrame, updates: DataFrame) -> DataFrame:
    """Scheduled stop times with the delay that realtime reports for the same trip and stop sequence, if any.

    stop_times: trip_id, stop_sequence and times in seconds; updates: trip_trip_id, stop_sequence, arrival_delay, departure_delay.
    """
    live = updates.where("trip_trip_id is not null and stop_sequence is not null").groupBy(F.col("trip_trip_id").alias("trip_id"), "stop_sequence")
    live = live.agg(F.max("arrival_delay").alias("arrival_delay"), F.max("departure_delay").alias("departure_delay"))
    joined = stop_times.join(live, ["trip_id", "stop_sequence"], "left")
    return joined.withColumn("expected_arrival", F.col("arrival_time") + F.coalesce("arrival_delay", F.lit(0))).withColumn("expected_departure", F.col("departure_time") + F.coalesce("departure_delay", F.lit(0)))
