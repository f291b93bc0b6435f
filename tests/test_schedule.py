from __future__ import annotations

import zipfile
from datetime import date

import pytest

from headway.__main__ import main
from headway.sources import schedule

FEED = {
    "agency.txt": "﻿agency_id,agency_name,agency_url,agency_timezone,agency_lang\nA,Buses,https://example.org,America/Costa_Rica,es\n",
    "stops.txt": 'stop_name,stop_id,stop_lat,stop_lon,location_type,parent_station,extra\n"Central, north",S1,9.93,-84.08,0,,x\nSouth,S2,95,-84.08,9,S9,y\n',
    "routes.txt": "route_id,agency_id,route_short_name,route_color\nR1,A,1,0039a6\nR2,B,2,#ff0000\n",
    "calendar.txt": "service_id,monday,tuesday,wednesday,thursday,friday,saturday,sunday,start_date,end_date\nW,1,1,1,1,1,0,0,20240101,20241231\n",
    "calendar_dates.txt": "service_id,date,exception_type\nW,20240501,2\n",
    "trips.txt": "route_id,service_id,trip_id,direction_id,wheelchair_accessible,bikes_allowed\nR1,W,T1,0,0,0\nR1,W,T1,1,0,0\n",
    "stop_times.txt": "trip_id,arrival_time,departure_time,stop_id,stop_sequence,pickup_type,drop_off_type,timepoint\nT1,25:10:00,25:11:00,S1,1,0,0,1\nT1,,,S2,2,0,0,\nT9,x,1:00:00,S1,1,0,0,0\n",
}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("feed")
    for name, text in FEED.items():
        (path / name).write_text(text)
    return path


@pytest.fixture(scope="module")
def archive(folder, tmp_path_factory):
    path = tmp_path_factory.mktemp("zip") / "city.zip"
    with zipfile.ZipFile(path, "w") as z:
        for name in FEED:
            z.write(folder / name, f"city/{name}")
    return path


def test_import_from_a_folder_and_an_archive(spark, folder, archive):
    a, b = schedule.import_schedule(spark, str(folder), "f"), schedule.import_schedule(spark, str(archive))
    for name in ("stops", "routes", "stop_times"):
        assert sorted(map(str, a[name].drop("feed_id").collect())) == sorted(map(str, b[name].drop("feed_id").collect()))
    assert b["stops"].first()["feed_id"] == "city"
    stop = {r["stop_id"]: r for r in a["stops"].collect()}
    assert (stop["S1"]["stop_name"], float(stop["S1"]["stop_lat"]), stop["S1"]["parent_station"], stop["S1"]["stop_code"]) == ("Central, north", 9.93, "", None)
    assert (stop["S2"]["stop_lat"], stop["S2"]["location_type"]) == (None, None)
    times = {(r["trip_id"], r["stop_sequence"]): r for r in a["stop_times"].collect()}
    assert (times["T1", 1]["arrival_time"], times["T1", 1]["timepoint"], times["T1", 2]["timepoint"]) == (90600, True, False)
    dates = a["calendar_dates"].first()
    assert (dates["date"], dates["holiday_name"]) == (date(2024, 5, 1), "Feriado")
    assert a["routes"].where("route_id = 'R1'").first()["route_type"] == 3
    assert a["shapes"].count() == 0


def test_violations(spark, folder):
    found = {(r["table"], r["row_key"], r["column"], r["code"]) for r in schedule.import_schedule(spark, str(folder)).violations().collect()}
    assert found == {
        ("stops", "S2", "stop_lat", "max_value"),
        ("stops", "S2", "location_type", "choice"),
        ("stops", "S2", "parent_station", "reference"),
        ("routes", "R2", "agency_id", "reference"),
        ("routes", "R2", "route_color", "invalid"),
        ("trips", "T1", "trip_id", "unique"),
        ("stop_times", "T9/1", "arrival_time", "invalid"),
        ("stop_times", "T9/1", "trip_id", "reference"),
    }


def test_modes(spark, folder):
    load = lambda mode: schedule.import_schedule(spark, str(folder), mode=mode)["routes"]
    assert "violations" not in load("off").columns
    assert {r["route_id"]: len(r["violations"]) for r in load("flag").collect()} == {"R1": 0, "R2": 1}
    assert [r["route_id"] for r in load("drop").collect()] == ["R1"]
    with pytest.raises(Exception, match="route_color"):
        load("fail").collect()
    with pytest.raises(schedule.FeedError, match="mode must be"):
        load("other")


def test_export_and_import_again(spark, folder, tmp_path):
    feed = schedule.import_schedule(spark, str(folder), "f", mode="drop")
    for target in (str(tmp_path / "out.zip"), str(tmp_path / "out")):
        schedule.export_schedule(feed.tables, target)
        again = schedule.import_schedule(spark, target, "f")
        for name, df in feed.tables.items():
            assert sorted(map(str, df.collect())) == sorted(map(str, again[name].collect())), name
    with zipfile.ZipFile(tmp_path / "out.zip") as z:
        assert "25:10:00" in z.read("stop_times.txt").decode()
        assert z.read("calendar.txt").decode().splitlines()[1].endswith("20240101,20241231")


def test_storage_by_feed(spark, folder, tmp_path):
    for name in ("one", "two"):
        schedule.save(schedule.import_schedule(spark, str(folder), name), str(tmp_path))
    tables = schedule.load(spark, str(tmp_path))
    assert tables["stops"].where("feed_id = 'two'").count() == 2
    plan = tables["stops"].where("feed_id = 'two'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(feed_id" in plan


def test_views(spark, folder):
    schedule.import_schedule(spark, str(folder)).create_views("city_")
    assert spark.sql("SELECT count(*) FROM city_trips t JOIN city_routes r ON t.route_id = r.route_id").first()[0] == 2


def test_failures_are_feed_errors(spark, tmp_path):
    with pytest.raises(schedule.FeedError):
        schedule.import_schedule(spark, str(tmp_path))
    (tmp_path / "bad.zip").write_bytes(b"no archive")
    with pytest.raises(schedule.FeedError):
        schedule.import_schedule(spark, str(tmp_path / "bad.zip"))


def test_command_line(spark, folder, tmp_path, capsys):
    assert main(["import", str(folder), str(tmp_path / "store")]) == 0
    assert main(["export", str(tmp_path / "store"), str(tmp_path / "again.zip")]) == 0
    assert main(["validate", str(folder)]) == 0
    assert main(["import", str(tmp_path / "nothing"), str(tmp_path / "x")]) == 1
    assert "Imported" in capsys.readouterr().out


def test_archives_of_several_feeds_are_refused(spark, folder, tmp_path):
    with zipfile.ZipFile(tmp_path / "two.zip", "w") as z:
        for place in ("a", "b"):
            z.write(folder / "stops.txt", f"{place}/stops.txt")
    with pytest.raises(schedule.FeedError, match="several folders: a, b"):
        schedule.import_schedule(spark, str(tmp_path / "two.zip"))


def test_the_command_tells_all_violations(spark, tmp_path, capsys):
    (tmp_path / "stops.txt").write_text("stop_id,stop_name,stop_lat\n" + "".join(f"s{i},x,95\n" for i in range(1500)))
    assert main(["validate", str(tmp_path)]) == 0
    out = capsys.readouterr().out
    assert "1500 x stops.stop_lat: max_value" in out
    assert out.count("\nstops\ts") == 1500
    assert main(["validate", str(tmp_path), "--report", str(tmp_path / "report")]) == 0
    assert spark.read.option("header", True).csv(str(tmp_path / "report")).count() == 1500
