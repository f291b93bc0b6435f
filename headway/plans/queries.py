"""Registered queries: each operator over the generic tables, beside the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..catalog import ALERT, DIRECTION, ENTITY_TYPE, FEED_MESSAGE, LOCATION_TYPE, ROUTES
from ..functions import semantic as S
from ..functions import times
from ..operators import constraints, service

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- times ---------------------------------------------------------------------------------------------------------

#: Times of events: hours of 0 to 119 without padding, minutes and seconds of 0 to 69, so some are invalid.
RAW_TIME = "format_string('%d:%02d:%02d', event_id % 120, event_id % 70, (event_id * 7) % 70)"
_SQL_RAW = "SELECT event_id, event_id % 120 AS h, event_id % 70 AS m, (event_id * 7) % 70 AS s FROM events"


def _times(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", F.expr(RAW_TIME).alias("raw"))


@query(f"SELECT event_id, CASE WHEN m < 60 AND s < 60 THEN printf('%02d:%02d:%02d', h, m, s) END AS time FROM ({_SQL_RAW})")
def time_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _times(spark, sf_dir).select("event_id", times.normalize_time(F.col("raw")).alias("time"))


@query(f"SELECT event_id, CASE WHEN m < 60 AND s < 60 THEN CAST(h * 3600 + m * 60 + s AS INTEGER) END AS seconds FROM ({_SQL_RAW})")
def time_to_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _times(spark, sf_dir).select("event_id", times.time_to_seconds(F.col("raw")).alias("seconds"))


@query("SELECT event_id, printf('%02d:%02d:%02d', x // 3600, x % 3600 // 60, x % 60) AS time FROM (SELECT event_id, (event_id * 37) % 400000 AS x FROM events)")
def time_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    seconds = F.col("event_id") * 37 % 400000
    return table(spark, sf_dir, "events").select("event_id", times.format_seconds(seconds).alias("time"))


@query(f"SELECT event_id, CASE WHEN m < 60 AND s < 60 AND h <= 23 THEN printf('%02d:%02d:%02d', h, m, s) END AS time FROM ({_SQL_RAW})")
def time_local_bound(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _times(spark, sf_dir).select("event_id", S.local_time().parse(F.col("raw")).alias("time"))


@query(f"SELECT event_id, CASE WHEN m < 60 AND s < 60 THEN printf('%02d:%02d:%02d', h, m, s) END AS time, CASE WHEN m >= 60 OR s >= 60 THEN 'invalid' END AS violation FROM ({_SQL_RAW})")
def time_base_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times of any hour as texts, with so much white space around some that only the normalized one is short enough."""
    padded = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("      "), "raw", F.lit("\t \n   "))).otherwise(F.col("raw"))
    return _both(_times(spark, sf_dir), F.col("event_id"), S.local_time(None), padded, "time")


@query("SELECT event_id, CASE WHEN x >= 0 THEN printf('%02d:%02d:%02d', x // 3600, x % 3600 // 60, x % 60) END AS time FROM (SELECT event_id, (event_id * 37) % 400000 - 200000 AS x FROM events)")
def duration_sign(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Durations below zero have no text."""
    seconds = F.col("event_id") * 37 % 400000 - 200000
    return table(spark, sf_dir, "events").select("event_id", times.format_interval(times.seconds_to_interval(seconds)).alias("time"))


@query(f"SELECT event_id, CASE WHEN m < 60 AND s < 60 THEN CAST(h * 3600 + m * 60 + s AS BIGINT) END AS seconds, CASE WHEN m < 60 AND s < 60 THEN printf('%02d:%02d:%02d', h, m, s) END AS time FROM ({_SQL_RAW})")
def time_duration_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = _times(spark, sf_dir).select("event_id", times.time_to_interval(F.col("raw")).alias("span"))
    return spans.select("event_id", times.interval_to_seconds(F.col("span")).cast("long").alias("seconds"), times.format_interval(F.col("span")).alias("time"))


# --- dates ---------------------------------------------------------------------------------------------------------


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderdate AS DATE) END AS service_date FROM orders")
def service_date_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.date_format("o_orderdate", "yyyyMMdd")
    broken = F.concat(F.substring(day, 1, 4), F.lit("13"), F.substring(day, 7, 2))
    raw = F.concat(F.lit(" "), F.when(F.col("o_orderkey") % 7 == 0, broken).otherwise(day), F.lit("\t"))
    return table(spark, sf_dir, "orders").select("o_orderkey", S.service_date().parse(raw).alias("service_date"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE strftime(o_orderdate, '%Y%m%d') END AS text FROM orders")
def service_date_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderdate").cast("date"))
    return table(spark, sf_dir, "orders").select("o_orderkey", times.render_date(day).alias("text"))


# --- semantic types ------------------------------------------------------------------------------------------------


def _both(df: DataFrame, key: Column, kind: S.SemanticType, raw: Column, name: str) -> DataFrame:
    return df.select(key, kind.parse(raw).alias(name), kind.violation(raw).alias("violation"))


@query("""
SELECT p_partkey, CASE WHEN p_partkey % 10 <> 3 THEN upper(raw) END AS color, CASE WHEN p_partkey % 10 = 3 THEN 'invalid' END AS violation
FROM (SELECT p_partkey, lpad(lower(hex(p_partkey)), 6, '0') AS raw FROM part)
""")
def color_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    plain = F.lpad(F.lower(F.hex("p_partkey")), 6, "0")
    raw = F.when(F.col("p_partkey") % 10 == 3, F.concat(F.lit("#"), plain)).otherwise(plain)
    return _both(table(spark, sf_dir, "part"), F.col("p_partkey"), S.color(), raw, "color")


@query("""
SELECT c_custkey, CASE WHEN c_custkey % 4 <> 1 THEN upper(substr(c_mktsegment, 1, 3)) END AS code, CASE WHEN c_custkey % 4 = 1 THEN 'invalid' END AS violation
FROM customer
""")
def currency_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.lower(F.when(F.col("c_custkey") % 4 == 1, F.substring("c_mktsegment", 1, 4)).otherwise(F.substring("c_mktsegment", 1, 3)))
    return _both(table(spark, sf_dir, "customer"), F.col("c_custkey"), S.currency_code(), raw, "code")


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(TRY_CAST(raw AS DECIMAL(18, 6)) * 1000000 AS BIGINT) AS micros
FROM (SELECT *, CAST(CAST(round(l_extendedprice * 100) AS BIGINT) // 100 AS VARCHAR) || '.' || lpad(CAST(CAST(round(l_extendedprice * 100) AS BIGINT) % 100 AS VARCHAR), 2, '0') AS raw FROM lineitem)
""")
def currency_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    raw = F.concat(F.floor(cents / 100).cast("string"), F.lit("."), F.lpad((cents % 100).cast("string"), 2, "0"))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", (S.currency_amount().parse(raw) * 1000000).cast("long").alias("micros"))


@query("""
SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN lang WHEN doc_id % 3 = 1 THEN lang || '-US' END AS code, CASE WHEN doc_id % 3 = 2 THEN 'invalid' END AS violation
FROM documents
""")
def language_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    suffix = F.element_at(F.array(F.lit(""), F.lit("-US"), F.lit("_US")), (F.col("doc_id") % 3 + 1).cast("int"))
    return _both(table(spark, sf_dir, "documents"), F.col("doc_id"), S.language(), F.concat("lang", suffix), "code")


@query("""
SELECT c_custkey, CASE WHEN c_custkey % 6 <> 0 THEN raw END AS phone, CASE WHEN c_custkey % 6 = 0 THEN 'invalid' END AS violation
FROM (SELECT c_custkey, '+' || c_nationkey || ' (' || c_custkey % 900 || ') 555-' || c_custkey AS raw FROM customer)
""")
def phone_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.format_string("+%d (%d) 555-%d", "c_nationkey", F.col("c_custkey") % 900, "c_custkey")
    raw = F.when(F.col("c_custkey") % 6 == 0, F.concat(number, F.lit(" x1"))).otherwise(number)
    return _both(table(spark, sf_dir, "customer"), F.col("c_custkey"), S.phone(), raw, "phone")


@query("""
SELECT c_custkey, CASE WHEN c_custkey % 5 <> 2 THEN raw END AS email, CASE WHEN c_custkey % 5 = 2 THEN 'invalid' END AS violation
FROM (SELECT c_custkey, replace(lower(c_name), '#', '.') || '@example.org' AS raw FROM customer)
""")
def email_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    plain = F.concat(F.replace(F.lower("c_name"), F.lit("#"), F.lit(".")), F.lit("@example.org"))
    raw = F.when(F.col("c_custkey") % 5 == 2, F.replace(plain, F.lit("@"), F.lit("@@"))).otherwise(plain)
    return _both(table(spark, sf_dir, "customer"), F.col("c_custkey"), S.email(), raw, "email")


@query("""
SELECT page_id, CASE WHEN page_id % 4 = 1 THEN 'invalid' WHEN length(url) > 200 THEN 'max_length' END AS violation
FROM pages
""")
def url_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.when(F.col("page_id") % 4 == 1, F.regexp_replace("url", "^https?://", "//")).otherwise(F.col("url"))
    return table(spark, sf_dir, "pages").select("page_id", S.url().violation(raw).alias("violation"))


@query(r"SELECT doc_id, CASE WHEN length(text) > 255 THEN 'max_length' WHEN text <> '' AND NOT regexp_full_match(text, '[\x20-\x7E]+') THEN 'invalid' END AS violation FROM documents")
def id_ascii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", S.identifier(printable_ascii=True).violation(F.col("text")).alias("violation"))


@query("SELECT doc_id, CASE WHEN length(text) > 255 THEN 'max_length' END AS violation FROM documents")
def text_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", S.text().violation(F.col("text")).alias("violation"))


def _degree_sql(most: int, name: str) -> str:
    return f"""
SELECT c_custkey, CASE WHEN abs(v) <= {most} THEN CAST(CAST(v AS DECIMAL(9, 6)) * 1000000 AS BIGINT) END AS {name}, CASE WHEN v < -{most} THEN 'min_value' WHEN v > {most} THEN 'max_value' END AS violation
FROM (SELECT c_custkey, CAST(CAST(round(c_acctbal) AS BIGINT) AS DECIMAL(18, 2)) / 50 AS v FROM customer)
"""


def _degrees(spark: SparkSession, sf_dir: str, kind: S.SemanticType) -> DataFrame:
    raw = (F.round("c_acctbal").cast("long").cast("decimal(18,2)") / 50).cast("decimal(18,2)").cast("string")
    found = _both(table(spark, sf_dir, "customer"), F.col("c_custkey"), kind, raw, kind.name)
    return found.withColumn(kind.name, (F.col(kind.name) * 1000000).cast("long"))


@query(_degree_sql(90, "latitude"))
def latitude_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _degrees(spark, sf_dir, S.latitude())


@query(_degree_sql(180, "longitude"))
def longitude_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _degrees(spark, sf_dir, S.longitude())


ZONES = ("UTC", "America/Costa_Rica", "America/Los Angeles", "Europe/Berlin", "Mars/Olympus", "+05:00", "")


@query("""
SELECT n_nationkey, z AS zone, CASE WHEN z IN ('America/Los Angeles', 'Mars/Olympus', '+05:00') THEN 'invalid' END AS violation
FROM (SELECT n_nationkey, ['UTC', 'America/Costa_Rica', 'America/Los Angeles', 'Europe/Berlin', 'Mars/Olympus', '+05:00', ''][n_nationkey % 7 + 1] AS z FROM nation)
""")
def timezone_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    zone = F.element_at(F.array(*map(F.lit, ZONES)), F.col("n_nationkey") % 7 + 1)
    return table(spark, sf_dir, "nation").select("n_nationkey", zone.alias("zone"), S.timezone().violation(zone).alias("violation"))


@query("SELECT p_partkey, CASE WHEN p_size % 10 < 8 THEN p_size % 10 END AS code, CASE WHEN p_size % 10 >= 8 THEN 'choice' END AS violation FROM part")
def enum_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _both(table(spark, sf_dir, "part"), F.col("p_partkey"), ROUTES["route_type"].kind, (F.col("p_size") % 10).cast("string"), "code")


@query("SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS status, CASE WHEN o_orderstatus = 'P' THEN 'choice' END AS violation FROM orders")
def enum_char(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _both(table(spark, sf_dir, "orders"), F.col("o_orderkey"), S.enum_str(["F", "O"]), F.col("o_orderstatus"), "status")


@query("SELECT p_partkey, CASE WHEN p_partkey % 5 <> 4 AND p_size >= 20 THEN p_size - 20 END AS code, CASE WHEN p_partkey % 5 = 4 THEN 'invalid' WHEN p_size < 20 THEN 'min_value' END AS violation FROM part")
def integer_sign(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers that may not be below zero, some with a letter after them."""
    raw = F.concat((F.col("p_size") - 20).cast("string"), F.when(F.col("p_partkey") % 5 == 4, "x").otherwise(""))
    return _both(table(spark, sf_dir, "part"), F.col("p_partkey"), ROUTES["route_sort_order"].kind, raw, "code")


@query(f"""
SELECT p_partkey, CASE p_size % 6 {" ".join(f"WHEN {k} THEN '{v}'" for k, v in LOCATION_TYPE.items())} ELSE CAST(p_size % 6 AS VARCHAR) END AS place,
  CASE p_size % 2 {" ".join(f"WHEN {k} THEN '{v}'" for k, v in DIRECTION.items())} END AS direction
FROM part
""")
def enum_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", S.label(F.col("p_size") % 6, LOCATION_TYPE).alias("place"), S.label(F.col("p_size") % 2, DIRECTION).alias("direction"))


@query("SELECT p_partkey, CASE WHEN p_size % 8 = 2 THEN 3 ELSE p_size % 8 END AS route_type FROM part")
def default_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.nullif(F.col("p_size") % 8, F.lit(2)).cast("string")
    return table(spark, sf_dir, "part").select("p_partkey", ROUTES["route_type"].typed(raw).alias("route_type"))


@query("""
SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN CAST(p_size * 10000 + p_partkey % 10000 AS DECIMAL(18, 0)) / 10000 END AS distance,
  CASE p_partkey % 3 WHEN 1 THEN 'max_decimal_places' WHEN 2 THEN 'max_digits' END AS violation
FROM (SELECT p_partkey, p_size FROM part)
""")
def decimal_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    four = F.format_string("%d.%04d", "p_size", F.col("p_partkey") % 10000)
    raw = F.when(F.col("p_partkey") % 3 == 0, four).when(F.col("p_partkey") % 3 == 1, F.concat(four, F.lit("5"))).otherwise(F.concat(F.lit("1"), F.lpad(four, 7, "0")))
    made = _both(table(spark, sf_dir, "part"), F.col("p_partkey"), S.decimal(6, 4), raw, "distance")
    return made.withColumn("distance", F.col("distance").cast("double"))


# --- keys, references, order ---------------------------------------------------------------------------------------


@query("SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def pk_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return constraints.duplicate_keys(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber"), ["l_orderkey", "l_linenumber"])


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 10 <> 0)")
def fk_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    parents = table(spark, sf_dir, "customer").where("c_custkey % 10 <> 0")
    return constraints.orphans(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), parents, ["o_custkey"], ["c_custkey"])


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey % 4 <> 0 AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 10 <> 0)")
def fk_orphans_nullable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A key that is NULL, here that of every fourth customer, refers to nothing and is no orphan."""
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_custkey") % 4 != 0, F.col("o_custkey")).alias("o_custkey"))
    return constraints.orphans(rows, table(spark, sf_dir, "customer").where("c_custkey % 10 <> 0"), ["o_custkey"], ["c_custkey"], nullable=True)


@query("""
WITH o AS (SELECT * FROM orders WHERE o_custkey % 10 <> 0)
SELECT 'customer' AS name, count(*) AS n, sum(c_custkey) AS keys FROM customer WHERE c_custkey % 10 <> 0
UNION ALL SELECT 'orders', count(*), sum(o_orderkey) FROM o
UNION ALL SELECT 'lineitem', count(*), sum(l_orderkey) FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM o) OR l_orderkey NOT IN (SELECT o_orderkey FROM orders)
""")
def cascade_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..catalog import ForeignKey, TableSpec

    specs = {
        "customer": TableSpec("customer", "", (), ("c_custkey",)),
        "orders": TableSpec("orders", "", (), ("o_orderkey",), (ForeignKey(("o_custkey",), "customer", ("c_custkey",)),)),
        "lineitem": TableSpec("lineitem", "", (), (), (ForeignKey(("l_orderkey",), "orders", ("o_orderkey",)),)),
    }
    columns = {"customer": ["c_custkey"], "orders": ["o_orderkey", "o_custkey"], "lineitem": ["l_orderkey"]}
    tables = {name: table(spark, sf_dir, name).select(*c) for name, c in columns.items()}
    doomed = tables["customer"].where("c_custkey % 10 = 0").select("c_custkey")
    left = constraints.delete_cascade(tables, "customer", doomed, specs)
    parts = [left[name].agg(F.lit(name).alias("name"), F.count("*").alias("n"), F.sum(c[0]).alias("keys")) for name, c in columns.items()]
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


@query("SELECT event_id AS feed_message_id, CAST(row_number() OVER (ORDER BY ts DESC, event_id) - 1 AS BIGINT) AS position FROM events")
def feed_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as messages, in the order that the message table declares: the newest first."""
    rows = table(spark, sf_dir, "events").select(F.col("event_id").alias("feed_message_id"), F.col("ts").alias("timestamp"))
    return constraints.positions(rows, FEED_MESSAGE, "feed_message_id").drop("timestamp")


@query("SELECT user_id, event_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS INTEGER) AS position FROM events")
def order_within_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", "ts")
    return constraints.ranked(rows, ["user_id"], F.desc("ts"), F.asc("event_id")).drop("ts")


@query("SELECT user_id, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1")
def pk_upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", "value", "ts")
    return constraints.latest(rows, ["user_id"], "ts", "event_id").drop("ts")


_KINDS = {"click": "trip_update", "view": "vehicle", "purchase": "alert"}


@query("""
WITH k AS (SELECT user_id, CASE event_type WHEN 'click' THEN 'trip_update' WHEN 'view' THEN 'vehicle' WHEN 'purchase' THEN 'alert' END AS kind FROM events)
SELECT user_id, count(DISTINCT kind) AS kinds FROM k WHERE kind IS NOT NULL GROUP BY user_id HAVING count(DISTINCT kind) > 1
""")
def entity_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = F.create_map(*(F.lit(x) for pair in _KINDS.items() for x in pair))
    kinds = table(spark, sf_dir, "events").select("user_id", F.try_element_at(pairs, F.col("event_type")).alias("kind")).where(F.col("kind").isin(*ENTITY_TYPE))
    return constraints.mixed_kinds(kinds, "user_id", "kind")


# --- validation ----------------------------------------------------------------------------------------------------


@query("""
WITH s AS (
  SELECT CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE c_custkey END AS stop_id, round(c_acctbal / 40, 2) AS lat, c_nationkey % 6 AS kind, c_custkey FROM customer
), v AS (
  SELECT 'stop_id' AS "column", 'null' AS code FROM s WHERE stop_id IS NULL
  UNION ALL SELECT 'stop_lat', CASE WHEN lat < -90 THEN 'min_value' ELSE 'max_value' END FROM s WHERE abs(lat) > 90
  UNION ALL SELECT 'location_type', 'choice' FROM s WHERE kind > 4
  UNION ALL SELECT 'stop_url', 'invalid' FROM s WHERE c_custkey % 4 = 3
  UNION ALL SELECT 'stop_timezone', 'invalid' FROM s WHERE c_custkey % 11 = 5
  UNION ALL SELECT 'stop_name', 'blank' FROM s WHERE c_custkey % 13 = 1
)
SELECT 'stops' AS "table", "column", code, count(*) AS n FROM v GROUP BY ALL
""")
def violations_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers read as stops, with faults of several kinds; all checks of the table in one pass, then counted."""
    from ..catalog import STOPS
    from .validation import row_violations, summary

    k = F.col("c_custkey")
    given = {
        "stop_id": F.when(k % 9 != 0, k.cast("string")),
        "stop_name": F.when(k % 13 == 1, "").otherwise(F.col("c_name")),
        "stop_lat": F.round(F.col("c_acctbal") / 40, 2).cast("decimal(18,2)").cast("string"),
        "location_type": (F.col("c_nationkey") % 6).cast("string"),
        "stop_url": F.when(k % 4 == 3, "no address").otherwise("https://example.org/stops"),
        "stop_timezone": F.when(k % 11 == 5, "Mars/Olympus").otherwise("UTC"),
    }
    raw = table(spark, sf_dir, "customer").select(*(given.get(c, F.lit(None).cast("string")).alias(c) for c in STOPS.names))
    return summary(row_violations(raw, STOPS))


# --- nested values -------------------------------------------------------------------------------------------------


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events")
def json_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What alerts keep as JSON: checked and typed by the column, then queried as a variant."""
    column = ALERT["informed_entity"]
    rows = table(spark, sf_dir, "events").where(column.violation(F.col("props")).isNull())
    return rows.select("event_id", F.try_variant_get(F.try_parse_json(column.typed(F.col("props"))), "$.k", "int").alias("k"))


# --- extensions ----------------------------------------------------------------------------------------------------


@query("""
WITH c AS (SELECT s_suppkey, DATE '2024-01-01' + CAST(s_suppkey % 20 AS INTEGER) AS a, DATE '2024-02-01' + CAST(s_suppkey % 9 AS INTEGER) AS b FROM supplier),
d AS (SELECT s_suppkey, CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS date FROM c)
SELECT s_suppkey AS service_id, date FROM d WHERE isodow(date) <= 5 AND date <> DATE '2024-01-24' AND (s_suppkey % 2 = 0 OR isodow(date) <> 3)
UNION SELECT s_suppkey, DATE '2024-03-02' FROM supplier WHERE s_suppkey % 3 = 0
""")
def service_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekdays of service (odd ones rest on Wednesday), less one removed day, plus one added."""
    k = F.col("s_suppkey")
    suppliers = table(spark, sf_dir, "supplier")
    runs = [(F.lit(i < 5) if i != 2 else k % 2 == 0).alias(d) for i, d in enumerate(service.WEEKDAYS)]
    calendar = suppliers.select(k.alias("service_id"), *runs, F.date_add(F.lit("2024-01-01").cast("date"), (k % 20).cast("int")).alias("start_date"), F.date_add(F.lit("2024-02-01").cast("date"), (k % 9).cast("int")).alias("end_date"))
    removed = suppliers.select(k.alias("service_id"), F.lit("2024-01-24").cast("date").alias("date"), F.lit(2).alias("exception_type"))
    added = suppliers.where("s_suppkey % 3 = 0").select(k.alias("service_id"), F.lit("2024-03-02").cast("date").alias("date"), F.lit(1).alias("exception_type"))
    return service.service_days(calendar, removed.unionByName(added))


@query("""
WITH e AS (
  SELECT user_id, event_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS INTEGER) AS n FROM events
), t AS (SELECT user_id, event_id, n, CASE WHEN n % 4 = 1 THEN n * 120 END AS given FROM e), w AS (
  SELECT *, max(CASE WHEN given IS NOT NULL THEN n END) OVER (PARTITION BY user_id ORDER BY n) AS a, min(CASE WHEN given IS NOT NULL THEN n END) OVER (PARTITION BY user_id ORDER BY n ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS b FROM t
)
SELECT user_id, event_id, CASE WHEN a IS NOT NULL AND b IS NOT NULL THEN n * 120 END AS estimated_arrival FROM w
""")
def stop_time_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fourth time of a trip is given; the others lie between them, by sequence."""
    order = Window.partitionBy("user_id").orderBy("event_id")
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", F.row_number().over(order).alias("stop_sequence"))
    at = F.when(F.col("stop_sequence") % 4 == 1, F.col("stop_sequence") * 120)
    stops = rows.select("*", at.alias("arrival_time"), at.alias("departure_time"), F.lit(None).cast("decimal(18,6)").alias("shape_dist_traveled"))
    return service.estimate_stop_times(stops, ("user_id",)).select("user_id", "event_id", "estimated_arrival")


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)


from . import feeds  # noqa: E402, F401  its queries are registered here
