from __future__ import annotations

import threading
from datetime import date, datetime
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest
from google.protobuf import descriptor_pb2, descriptor_pool, message_factory

from headway.operators import constraints, flatten
from headway.sources import realtime, wire
from headway.streaming import append_parquet, delay_windows, message_stream, new_positions, polled_stream

TRIP = {"trip_id": "T1", "start_time": "25:05:00", "start_date": "20240501", "schedule_relationship": "SCHEDULED", "route_id": "R1", "direction_id": 1}
UPDATES = {
    "header": {"gtfs_realtime_version": "2.0", "incrementality": "FULL_DATASET", "timestamp": 1714521600},
    "entity": [
        {
            "id": "e1",
            "trip_update": {
                "trip": TRIP,
                "vehicle": {"id": "V1", "label": "Bus é", "wheelchair_accessible": "WHEELCHAIR_ACCESSIBLE"},
                "stop_time_update": [{"stop_sequence": 1, "stop_id": "S1", "arrival": {"delay": -30, "time": 1714521700, "uncertainty": 5}, "schedule_relationship": "SKIPPED"}, {"stop_sequence": 2, "departure": {"delay": 60}, "departure_occupancy_status": "FULL"}],
                "timestamp": 1714521650,
                "delay": -30,
            },
        },
        {"id": "e2", "is_deleted": True},
    ],
}
VEHICLES = {
    "header": {"gtfs_realtime_version": "2.0", "timestamp": 1714521600},
    "entity": [{"id": "v1", "vehicle": {"trip": TRIP, "position": {"latitude": 9.5, "longitude": -84.25, "speed": 12.5}, "current_status": "STOPPED_AT", "timestamp": 1714521600, "vehicle": {"id": "V1"}, "occupancy_percentage": 80, "congestion_level": "STOP_AND_GO"}}],
}


def google_class():
    """The same layout as classes of the protobuf library, built at run time."""
    file = descriptor_pb2.FileDescriptorProto(name="rt.proto", package="rt", syntax="proto2")
    field = descriptor_pb2.FieldDescriptorProto

    def add(name, layout):
        m = file.message_type.add(name=name)
        for number, (label, kind) in layout.items():
            f = m.field.add(name=label, number=number, label=field.LABEL_OPTIONAL)
            if isinstance(kind, tuple):
                f.type, f.type_name = field.TYPE_MESSAGE, f".rt.{name}_{label}"
                f.label = field.LABEL_REPEATED if kind[1] else field.LABEL_OPTIONAL
                add(f"{name}_{label}", kind[0])
            else:
                f.type = {"string": field.TYPE_STRING, "number": field.TYPE_FLOAT, "bool": field.TYPE_BOOL}.get(kind if isinstance(kind, str) else "", field.TYPE_INT64)

    add("Message", wire.MESSAGE)
    pool = descriptor_pool.DescriptorPool()
    pool.Add(file)
    return message_factory.GetMessageClass(pool.FindMessageTypeByName("rt.Message"))


def test_wire_format_agrees_with_the_library():
    for message in (UPDATES, VEHICLES):
        data = wire.encode(message)
        theirs = google_class()()
        theirs.ParseFromString(data)
        assert google_class()(**{}).ByteSize() == 0
        assert theirs.header.gtfs_realtime_version == "2.0"
        assert theirs.entity[0].id == message["entity"][0]["id"]
        assert wire.decode(theirs.SerializeToString()) == wire.decode(data)
    update = wire.decode(wire.encode(UPDATES))["entity"][0]["trip_update"]
    assert update["delay"] == -30
    assert update["stop_time_update"][0]["arrival"]["delay"] == -30


def test_unknown_fields_are_skipped_and_damage_is_told():
    data = wire.encode(VEHICLES)
    extra = bytes([0xFA, 0x3E, 3]) + b"abc" + bytes([0x78, 5])
    assert wire.decode(extra + data) == wire.decode(data)
    for bad in (data[:-3], b"\x0a\xff\xff\xff\xff\x0f", b"\x0b", b"\xff" * 12, b"\x00\x01"):
        with pytest.raises(wire.DecodeError):
            wire.decode(bad)


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    path = tmp_path_factory.mktemp("messages")
    (path / "a.pb").write_bytes(wire.encode(UPDATES))
    (path / "b.pb").write_bytes(wire.encode(VEHICLES))
    return path


def test_flat_tables(spark, files):
    messages = realtime.read_messages(spark, str(files)).cache()
    assert {(r["entity_type"], r["incrementality"], r["header_timestamp"]) for r in flatten.feed_messages(messages).collect()} == {("trip_update", "FULL_DATASET", datetime(2024, 5, 1)), ("vehicle", "FULL_DATASET", datetime(2024, 5, 1))}
    trip = flatten.trip_updates(messages).collect()
    assert len(trip) == 1
    assert (trip[0]["trip_start_time"], trip[0]["trip_start_date"], trip[0]["vehicle_label"], trip[0]["delay"], trip[0]["trip_schedule_relationship"]) == (90300, date(2024, 5, 1), "Bus é", -30, "SCHEDULED")
    stops = {r["stop_sequence"]: r for r in flatten.stop_time_updates(messages).collect()}
    assert (stops[1]["arrival_delay"], stops[1]["schedule_relationship"], stops[1]["departure_delay"]) == (-30, "SKIPPED", None)
    assert (stops[2]["departure_delay"], stops[2]["departure_occupancy_status"]) == (60, "FULL")
    position = flatten.vehicle_positions(messages).first()
    assert (position["vehicle_position_latitude"], position["vehicle_current_status"], position["vehicle_occupancy_percentage"]) == (9.5, "STOPPED_AT", 80.0)
    assert constraints.mixed_kinds(flatten.entity_kinds(messages), "feed_message_id", "kind").count() == 0
    messages.unpersist()


def test_damaged_files(spark, tmp_path):
    (tmp_path / "a.pb").write_bytes(wire.encode(UPDATES)[:-3])
    with pytest.raises(Exception, match="over the end"):
        realtime.read_messages(spark, str(tmp_path)).collect()
    kept = realtime.read_messages(spark, str(tmp_path), on_error="keep")
    assert kept.first()["message"] is None
    assert "over the end" in kept.first()["error"]
    assert flatten.trip_updates(kept).count() == 0


@pytest.fixture(scope="module")
def server():
    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            ok = self.path == "/ok" and self.headers.get("X-Key", "k") == "k"
            self.send_response(200 if ok else 503)
            self.end_headers()
            self.wfile.write(wire.encode(VEHICLES) if ok else b"")

        def log_message(self, *_):
            pass

    http = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=http.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{http.server_port}"
    http.shutdown()


def test_fetching(spark, server):
    got = realtime.import_realtime(spark, f"{server}/ok {server}/ok", timeout=5, headers={"X-Key": "k"})
    assert flatten.vehicle_positions(got).count() == 2
    client = realtime.RealtimeClient(server, timeout=5, headers={"X-Key": "k"})
    assert flatten.vehicle_positions(client.messages(spark, "ok", "/ok")).count() == 2
    with pytest.raises(Exception, match="503"):
        realtime.import_realtime(spark, f"{server}/no").collect()
    with pytest.raises(Exception, match="option url"):
        realtime.import_realtime(spark, "").collect()


def test_streaming_from_files(spark, files, tmp_path):
    stream = message_stream(spark, str(files))
    append_parquet(new_positions(stream), str(tmp_path / "positions"), str(tmp_path / "c1")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "positions")).count() == 1
    query = delay_windows(stream).writeStream.format("memory").queryName("delays").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination()
    assert [tuple(r)[1:] for r in spark.sql("SELECT * FROM delays").collect()] == [("R1", 1, -30.0)]


def test_streaming_from_the_web(spark, server, tmp_path):
    query = polled_stream(spark, f"{server}/ok").writeStream.format("memory").queryName("polled").option("checkpointLocation", str(tmp_path)).start()
    try:
        for _ in range(60):
            if spark.sql("SELECT * FROM polled").count():
                break
            query.awaitTermination(1)
    finally:
        query.stop()
    assert spark.sql("SELECT * FROM polled WHERE message IS NOT NULL").count() > 0


def test_a_planned_batch_survives_the_driver(server, tmp_path):
    options = {"url": f"{server}/ok", "snapshots": f"file://{tmp_path}/s"}
    before = realtime._Snapshots(options)
    rows, end = before.read({"snapshot": 0})
    rows = list(rows)
    after = realtime._Snapshots(options)
    assert list(after.readBetweenOffsets({"snapshot": 0}, end)) == rows
    after.commit(end)
    assert list((tmp_path / "s").iterdir()) == []
    forgetful = realtime._Snapshots({"url": f"{server}/ok"})
    with pytest.raises(RuntimeError, match="snapshots"):
        forgetful.readBetweenOffsets({"snapshot": 0}, end)


def test_polling_with_snapshots(spark, server, tmp_path):
    stream = polled_stream(spark, f"{server}/ok", snapshots=f"file://{tmp_path}/s")
    query = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).start()
    try:
        for _ in range(60):
            if len(query.recentProgress) > 2:
                break
            query.awaitTermination(1)
    finally:
        query.stop()
    assert spark.read.parquet(str(tmp_path / "out")).where("message is not null").count() > 0
