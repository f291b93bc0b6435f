"""Engine settings, read from the session each time."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: off: nothing is checked; flag: violations are added to each row; drop: rows with any go; fail: any row with one fails the query.
MODES = ("off", "flag", "drop", "fail")
VALIDATION = "headway.validation"
REFERENCE_SOURCE = "headway.referenceSource"


def validation_mode(spark: SparkSession) -> str:
    mode = spark.conf.get(VALIDATION, "off")
    if mode not in MODES:
        raise ValueError(f"{VALIDATION} must be one of {', '.join(MODES)}")
    return mode


def show_settings(spark: SparkSession) -> dict[str, bool | str | None]:
    """Is validation on, and the configured reference source of schedules."""
    return {"validation_enabled": validation_mode(spark) != "off", "reference_source": spark.conf.get(REFERENCE_SOURCE, None)}
