"""Structured Streaming over realtime snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from ..operators import flatten
from ..sources.realtime import decode_messages, register

BINARY = "path string, modificationTime timestamp, length long, content binary"


def message_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Messages from files as they appear in a folder. A damaged file has a NULL message and the reason, and stops nothing."""
    files = spark.readStream.format("binaryFile").schema(BINARY).option("pathGlobFilter", "*.pb").load(folder)
    return decode_messages(files.select(F.col("path").alias("url"), F.col("content").alias("payload")), on_error="keep")


def polled_stream(spark: SparkSession, url: str, timeout: float = 10.0, snapshots: str | None = None) -> DataFrame:
    """Messages fetched from addresses at each trigger. With ``snapshots``, a folder of this stream alone beside its checkpoint, batches survive a restart of the driver."""
    register(spark)
    read = spark.readStream.format("transit_realtime").option("url", url).option("timeout", str(timeout))
    return decode_messages((read.option("snapshots", snapshots) if snapshots else read).load(), on_error="keep")


def new_positions(messages: DataFrame, late: str = "10 minutes") -> DataFrame:
    """Vehicle positions, each vehicle and time once, however many snapshots repeat it; state older than ``late`` goes."""
    rows = flatten.vehicle_positions(messages).where("vehicle_timestamp is not null")
    return rows.withWatermark("vehicle_timestamp", late).dropDuplicatesWithinWatermark(["vehicle_vehicle_id", "vehicle_trip_trip_id", "vehicle_timestamp"])


def delay_windows(messages: DataFrame, width: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """Number and mean delay of the trip updates of each route in windows of their own time."""
    rows = flatten.trip_updates(messages).where("timestamp is not null").withWatermark("timestamp", late)
    grouped = rows.groupBy(F.window("timestamp", width), "trip_route_id").agg(F.count("*").alias("updates"), F.avg("delay").alias("mean_delay"))
    return grouped.select(F.col("window.start").alias("window_start"), "trip_route_id", "updates", "mean_delay")


def append_parquet(df: DataFrame, folder: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Append a stream to Parquet, exactly once by its checkpoint (a polled stream needs ``snapshots`` for that); ``once`` takes what is there and ends."""
    out = df.writeStream.format("parquet").outputMode("append").option("path", folder).option("checkpointLocation", checkpoint)
    return (out.trigger(availableNow=True) if once else out).start()
