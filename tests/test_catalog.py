from __future__ import annotations

import pytest
from pyspark.sql import types as T

from headway import catalog
from headway.config import show_settings


def test_every_table_is_there():
    assert len(catalog.SCHEDULE) == 11
    assert len(catalog.REALTIME) == 5
    assert sum(len(t.columns) for t in catalog.TABLES.values()) == 160
    assert sum(c.labels is not None for t in catalog.TABLES.values() for c in t.columns) == 13


def test_labels(spark):
    kinds = spark.createDataFrame([(0,), (7,), (None,)], "x int")
    got = [r[0] for r in kinds.select(catalog.ROUTES["route_type"].display(kinds.x)).collect()]
    assert got == ["Tranvía o tren ligero", "Funicular", None]
    with pytest.raises(ValueError, match="no labels"):
        catalog.ROUTES["route_id"].display(kinds.x)


def test_extend_adds_columns_only():
    mine = catalog.STOPS.extend([T.StructField("feed_id", T.StringType(), False)])
    assert mine.schema().names == ["feed_id", *catalog.STOPS.names]
    assert catalog.STOPS.schema().names == catalog.STOPS.names


def test_absent_cells(spark):
    rows = spark.createDataFrame([(None, None, "1"), ("", "", "")], "a string, b string, c string")
    agency, stops, dates = catalog.AGENCY, catalog.STOPS, catalog.CALENDAR_DATES
    got = rows.select(agency["agency_id"].typed(rows.a), stops["stop_code"].typed(rows.a), dates["holiday_name"].typed(rows.b), catalog.ROUTES["route_type"].typed(rows.c)).collect()
    assert [tuple(r) for r in got] == [("", None, "Feriado", 1), ("", None, "Feriado", 3)]
    codes = rows.select(agency["agency_name"].violation(rows.a)).collect()
    assert [r[0] for r in codes] == ["null", "blank"]


def test_settings(spark):
    assert show_settings(spark) == {"validation_enabled": False, "reference_source": None}
    spark.conf.set("headway.validation", "flag")
    spark.conf.set("headway.referenceSource", "somewhere")
    try:
        assert show_settings(spark) == {"validation_enabled": True, "reference_source": "somewhere"}
        spark.conf.set("headway.validation", "perhaps")
        with pytest.raises(ValueError, match="must be one of"):
            show_settings(spark)
    finally:
        spark.conf.unset("headway.validation")
        spark.conf.unset("headway.referenceSource")
