"""Checks of rows, keys and references, as one expression per row and one long report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..catalog import SCHEDULE_LINKS, TABLES, TableSpec
from ..config import MODES

#: Columns that name a row in reports.
ROW_KEYS = {
    "agency": ("agency_id",),
    "stops": ("stop_id",),
    "routes": ("route_id",),
    "calendar": ("service_id",),
    "calendar_dates": ("service_id", "date"),
    "shapes": ("shape_id", "shape_pt_sequence"),
    "trips": ("trip_id",),
    "stop_times": ("trip_id", "stop_sequence"),
    "fare_attributes": ("fare_id",),
    "fare_rules": ("fare_id", "route_id"),
    "feed_info": ("feed_publisher_name",),
    "feed_message": ("feed_message_id",),
    "trip_update": ("feed_message", "entity_id"),
    "stop_time_update": ("feed_message", "trip_update", "stop_sequence"),
    "vehicle_position": ("feed_message", "entity_id"),
    "alert": ("alert_id",),
}
#: Tables whose row keys must be unique.
UNIQUE = ("stops", "routes", "calendar", "trips", "stop_times", "calendar_dates", "shapes", "fare_attributes", "feed_message")


def violations(spec: TableSpec) -> Column:
    """array of (column, code, value) of a row of texts, computed in one pass."""
    found = [F.when(c.violation(F.col(c.name)).isNotNull(), F.struct(F.lit(c.name).alias("column"), c.violation(F.col(c.name)).alias("code"), F.col(c.name).alias("value"))) for c in spec.columns]
    return F.filter(F.array(*found), lambda v: v.isNotNull())


def typed(raw: DataFrame, spec: TableSpec, *more: Column) -> DataFrame:
    """The table's typed columns from texts; a refused value is NULL, an absent one what the column says."""
    return raw.select(*(c.typed(F.col(c.name)).alias(c.name) for c in spec.columns), *more)


def checked(raw: DataFrame, spec: TableSpec, mode: str) -> DataFrame:
    """off: typed rows. flag: with a column ``violations``. drop: without rows that have any. fail: the first such row fails the query."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {', '.join(MODES)}")
    if mode == "off":
        return typed(raw, spec)
    flagged = typed(raw, spec, violations(spec).alias("violations"))
    if mode == "flag":
        return flagged
    if mode == "drop":
        return flagged.where(F.size("violations") == 0).drop("violations")
    message = F.concat(F.lit(f"{spec.name}: "), F.to_json("violations"))
    passes = F.when(F.size("violations") > 0, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    return flagged.where(passes).drop("violations")


def _row_key(columns: Sequence[str]) -> Column:
    return F.concat_ws("/", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns))


def row_violations(raw: DataFrame, spec: TableSpec) -> DataFrame:
    """The long form of a table's cell violations: table, row_key, column, code, value."""
    listed = raw.select(_row_key(ROW_KEYS[spec.name]).alias("row_key"), F.explode(violations(spec)).alias("v"))
    return listed.select(F.lit(spec.name).alias("table"), "row_key", "v.column", "v.code", "v.value")


def key_violations(raw: DataFrame, spec: TableSpec) -> DataFrame:
    key = ROW_KEYS[spec.name]
    many = raw.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")
    return many.select(F.lit(spec.name).alias("table"), _row_key(key).alias("row_key"), F.lit("/".join(key)).alias("column"), F.lit("unique").alias("code"), F.col("n").cast("string").alias("value"))


def link_violations(raw: Mapping[str, DataFrame], name: str) -> list[DataFrame]:
    """References of one table to rows that are not there. Empty cells refer to nothing."""
    out = []
    spec = TABLES[name]
    for link in (*SCHEDULE_LINKS.get(name, ()), *spec.foreign_keys):
        if link.parent not in raw:
            continue
        parent = raw[link.parent].select(*(F.col(p).alias(f"_{c}") for c, p in zip(link.columns, link.parent_columns, strict=True)))
        given = raw[name].where(" AND ".join(f"coalesce({c}, '') <> ''" for c in link.columns))
        lost = given.join(parent, [given[c] == parent[f"_{c}"] for c in link.columns], "left_anti")
        out.append(lost.select(F.lit(name).alias("table"), _row_key(ROW_KEYS[name]).alias("row_key"), F.lit("/".join(link.columns)).alias("column"), F.lit("reference").alias("code"), _row_key(link.columns).alias("value")))
    return out


def feed_violations(raw: Mapping[str, DataFrame]) -> DataFrame:
    """All violations of a feed's tables of texts."""
    parts = []
    for name, df in raw.items():
        parts.append(row_violations(df, TABLES[name]))
        if name in UNIQUE:
            parts.append(key_violations(df, TABLES[name]))
        parts += link_violations(raw, name)
    if not parts:
        raise ValueError("no tables")
    return reduce(DataFrame.unionByName, parts)


def summary(found: DataFrame) -> DataFrame:
    return found.groupBy("table", "column", "code").agg(F.count("*").alias("n"))
