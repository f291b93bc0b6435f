"""The tables of schedule feeds and realtime messages: columns, types, absent values, enumerations and keys.

A ``TableSpec`` is a template. It gives schemas and column expressions, and creates no storage.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions import semantic as S
from .functions.semantic import SemanticType

#: What a missing or empty cell becomes.
REQUIRED, NULL, BLANK, DEFAULT, GENERATED = "required", "null", "blank", "default", "generated"

# Codes and display texts of the enumerated columns.
LOCATION_TYPE = {0: "Parada o plataforma", 1: "Estación", 2: "Entrada o salida", 3: "Nodo genérico", 4: "Área de abordaje"}
ACCESSIBLE = {0: "No especificado", 1: "Accesible", 2: "No accesible"}
ROUTE_TYPE = {0: "Tranvía o tren ligero", 1: "Subterráneo o metro", 2: "Ferrocarril", 3: "Bus", 4: "Ferry", 5: "Teleférico", 6: "Góndola", 7: "Funicular"}
EXCEPTION_TYPE = {1: "Agregar", 2: "Eliminar"}
DIRECTION = {0: "En un sentido", 1: "En el otro"}
BIKES = {0: "No especificado", 1: "Permitido", 2: "No permitido"}
PAYMENT = {0: "Pago a bordo", 1: "Pago anticipado"}
TRANSFERS = {0: "No permitido", 1: "Permitido una vez", 2: "Permitido dos veces"}
ENTITY_TYPE = {"trip_update": "TripUpdate", "vehicle": "VehiclePosition", "alert": "Alert"}
CAUSE = {1: "Otra causa", 2: "Accidente", 3: "Congestión", 4: "Evento", 5: "Mantenimiento", 6: "Planificado", 7: "Huelga", 8: "Manifestación", 9: "Demora", 10: "Cierre"}
EFFECT = {1: "Otro efecto", 2: "Desviación", 3: "Adelanto", 4: "Cancelación", 5: "Cierre", 6: "Desvío", 7: "Detención", 8: "Desconocido"}
SEVERITY = {1: "Desconocido", 2: "Información", 3: "Advertencia", 4: "Grave", 5: "Muy grave"}


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    kind: SemanticType
    absent: str = REQUIRED
    default: object = None
    labels: dict | None = None

    def typed(self, raw: Column) -> Column:
        """The typed value of a text cell; one that is refused becomes NULL, an absent one what ``absent`` says."""
        given = F.when(raw != "", raw)
        if self.absent == DEFAULT:
            return F.when(given.isNull(), F.lit(self.default).cast(self.kind.spark_type)).otherwise(self.kind.parse(given))
        if self.absent == BLANK:
            return F.when(given.isNull(), F.lit("")).otherwise(self.kind.parse(given))
        if self.absent == GENERATED:
            return F.coalesce(self.kind.parse(given), F.current_timestamp())
        return self.kind.parse(given)

    def violation(self, raw: Column) -> Column:
        """``null`` or ``blank`` for a required cell that is absent, else the code of the first broken rule, else NULL."""
        broken = self.kind.violation(raw)
        if self.absent == REQUIRED:
            return F.when(raw.isNull(), F.lit("null")).when(raw == "", F.lit("blank")).otherwise(broken)
        return broken

    def display(self, c: Column) -> Column:
        """The text of an enumerated value."""
        if self.labels is None:
            raise ValueError(f"{self.name} has no labels")
        return S.label(c, self.labels)


@dataclass(frozen=True)
class ForeignKey:
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]
    nullable: bool = False


@dataclass(frozen=True)
class TableSpec:
    name: str
    source: str
    columns: tuple[ColumnSpec, ...]
    key: tuple[str, ...] = ()
    foreign_keys: tuple[ForeignKey, ...] = ()
    #: (column, descending)
    ordering: tuple[tuple[str, bool], ...] = ()
    #: Consumers add columns of their own; these stand beside the declared ones.
    extra: tuple[T.StructField, ...] = field(default=())

    def __getitem__(self, name: str) -> ColumnSpec:
        return next(c for c in self.columns if c.name == name)

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    def schema(self) -> T.StructType:
        return T.StructType([*self.extra, *(T.StructField(c.name, c.kind.spark_type, c.absent in (REQUIRED, NULL)) for c in self.columns)])

    def extend(self, fields: Iterable[T.StructField]) -> TableSpec:
        """A table with further columns, such as the version key of a feed."""
        return replace(self, extra=self.extra + tuple(fields))

    def order_by(self) -> list[Column]:
        return [F.col(c).desc() if down else F.col(c).asc() for c, down in self.ordering]


def _kinds(labels: dict | None) -> dict[str, Callable[..., SemanticType]]:
    return {
        "id": S.identifier,
        "text": S.text,
        "long_text": S.unbounded_text,
        "url": S.url,
        "email": S.email,
        "phone": S.phone,
        "language": lambda n=35: S.language().checked(S.max_length(n)),
        "timezone": S.timezone,
        "color": S.color,
        "currency": S.currency_code,
        "amount": lambda p, s: S.currency_amount(p, s),
        "decimal": S.decimal,
        "latitude": S.latitude,
        "longitude": S.longitude,
        "date": S.service_date,
        "time": S.gtfs_time,
        "local_time": S.local_time,
        "timestamp": S.timestamp,
        "json": S.json_text,
        "int": S.integer,
        "uint": lambda: S.integer(0),
        "bool": S.boolean,
        "float": S.floating,
        "enum": lambda: (S.enum_int if all(isinstance(k, int) for k in labels or {}) else S.enum_str)(list(labels or {})),
        "degrees": lambda most: S.floating().checked(("min_value", lambda c: c.try_cast("double") < -most), ("max_value", lambda c: c.try_cast("double") > most)),
        "ref": lambda n=63: S.identifier(n),
    }


def _columns(text: str, **labels: dict) -> tuple[ColumnSpec, ...]:
    """Lines of ``name kind[:argument,...] [null|blank|generated|=default]``; ``labels`` has the enumerations by column."""
    out = []
    for line in text.strip().splitlines():
        name, kind, *rest = line.split()
        base, _, given = kind.partition(":")
        arguments = [int(x) for x in given.split(",")] if given else []
        made = _kinds(labels.get(name))[base](*arguments)
        absent = rest[0] if rest else REQUIRED
        default: object = None
        if absent.startswith("="):
            default, absent = absent[1:], DEFAULT
            default = int(default) if str(default).isdigit() else {"false": False, "true": True}.get(str(default), default)
        out.append(ColumnSpec(name, made, absent, default, labels.get(name)))
    return tuple(out)


def _keys(*specs: str) -> tuple[ForeignKey, ...]:
    """Of ``column parent.column`` with a trailing ``?`` where the key may be NULL."""
    out = []
    for spec in specs:
        column, target = spec.rstrip("?").split()
        parent, parent_column = target.split(".")
        out.append(ForeignKey((column,), parent, (parent_column,), spec.endswith("?")))
    return tuple(out)


# The columns of each table in the format's names and order, with their types, absent values and bounds.
AGENCY = TableSpec(
    "agency",
    "agency.txt",
    _columns("""
        agency_id id blank
        agency_name text
        agency_url url
        agency_timezone timezone
        agency_lang language:2 blank
        agency_phone phone null
        agency_fare_url url null
        agency_email email null
    """),
)
STOPS = TableSpec(
    "stops",
    "stops.txt",
    _columns(
        """
        stop_id id
        stop_code id null
        stop_name text
        stop_desc long_text null
        stop_lat latitude null
        stop_lon longitude null
        zone_id id null
        stop_url url null
        location_type enum null
        parent_station id blank
        stop_timezone timezone blank
        wheelchair_boarding enum null
        platform_code text blank
        """,
        location_type=LOCATION_TYPE,
        wheelchair_boarding=ACCESSIBLE,
    ),
)
ROUTES = TableSpec(
    "routes",
    "routes.txt",
    _columns(
        """
        route_id id
        agency_id id:200
        route_short_name text:63 null
        route_long_name text null
        route_desc long_text null
        route_type enum =3
        route_url url null
        route_color color null
        route_text_color color null
        route_sort_order uint null
        """,
        route_type=ROUTE_TYPE,
    ),
)
CALENDAR = TableSpec(
    "calendar",
    "calendar.txt",
    _columns("""
        service_id id
        monday bool
        tuesday bool
        wednesday bool
        thursday bool
        friday bool
        saturday bool
        sunday bool
        start_date date
        end_date date
    """),
)
CALENDAR_DATES = TableSpec(
    "calendar_dates",
    "calendar_dates.txt",
    _columns(
        """
        service_id id
        date date
        exception_type enum
        holiday_name text =Feriado
        """,
        exception_type=EXCEPTION_TYPE,
    ),
)
SHAPES = TableSpec(
    "shapes",
    "shapes.txt",
    _columns("""
        shape_id id
        shape_pt_lat latitude
        shape_pt_lon longitude
        shape_pt_sequence uint
        shape_dist_traveled decimal:6,4 null
    """),
)
TRIPS = TableSpec(
    "trips",
    "trips.txt",
    _columns(
        """
        route_id id:200
        service_id id:200
        trip_id id
        trip_headsign text null
        trip_short_name text null
        direction_id enum
        block_id id null
        shape_id id null
        wheelchair_accessible enum
        bikes_allowed enum
        """,
        direction_id=DIRECTION,
        wheelchair_accessible=ACCESSIBLE,
        bikes_allowed=BIKES,
    ),
)
STOP_TIMES = TableSpec(
    "stop_times",
    "stop_times.txt",
    _columns("""
        trip_id id:200
        arrival_time time null
        departure_time time null
        stop_id id:200
        stop_sequence uint
        stop_headsign text null
        pickup_type uint
        drop_off_type uint
        shape_dist_traveled decimal:6,4 null
        timepoint bool =false
    """),
)
FARE_ATTRIBUTES = TableSpec(
    "fare_attributes",
    "fare_attributes.txt",
    _columns(
        """
        fare_id id
        price amount:6,2
        currency_type currency
        payment_method enum
        transfers enum null
        agency_id id null
        transfer_duration uint null
        """,
        payment_method=PAYMENT,
        transfers=TRANSFERS,
    ),
)
FARE_RULES = TableSpec(
    "fare_rules",
    "fare_rules.txt",
    _columns("""
        fare_id id:200
        route_id id:200
        origin_id id null
        destination_id id null
        contains_id id null
    """),
)
FEED_INFO = TableSpec(
    "feed_info",
    "feed_info.txt",
    _columns("""
        feed_publisher_name text
        feed_publisher_url url null
        feed_lang language:2
        feed_start_date date null
        feed_end_date date null
        feed_version text null
        feed_contact_email email null
        feed_contact_url url null
    """),
)
FEED_MESSAGE = TableSpec(
    "feed_message",
    "FeedMessage",
    _columns(
        """
        feed_message_id id:63
        entity_type enum
        timestamp timestamp generated
        incrementality text:15
        gtfs_realtime_version text:15
        """,
        entity_type=ENTITY_TYPE,
    ),
    key=("feed_message_id",),
    ordering=(("timestamp", True),),
)
TRIP_UPDATE = TableSpec(
    "trip_update",
    "TripUpdate",
    _columns("""
        entity_id id:127
        feed_message ref
        trip_trip_id id null
        trip_route_id id null
        trip_direction_id int null
        trip_start_time time null
        trip_start_date date null
        trip_schedule_relationship text:31 null
        vehicle_id id null
        vehicle_label text null
        vehicle_license_plate text null
        vehicle_wheelchair_accessible text:31 null
        timestamp timestamp null
        delay int null
    """),
    foreign_keys=_keys("feed_message feed_message.feed_message_id"),
)
STOP_TIME_UPDATE = TableSpec(
    "stop_time_update",
    "StopTimeUpdate",
    _columns("""
        feed_message ref
        trip_update ref:191
        stop_sequence int null
        stop_id id:127 null
        arrival_delay int null
        arrival_time timestamp null
        arrival_uncertainty int null
        departure_delay int null
        departure_time timestamp null
        departure_uncertainty int null
        departure_occupancy_status text null
        schedule_relationship text null
    """),
    foreign_keys=(ForeignKey(("feed_message",), "feed_message", ("feed_message_id",)), ForeignKey(("feed_message", "trip_update"), "trip_update", ("feed_message", "entity_id"))),
)
VEHICLE_POSITION = TableSpec(
    "vehicle_position",
    "VehiclePosition",
    _columns("""
        entity_id id:127
        feed_message ref null
        vehicle_trip_trip_id id
        vehicle_trip_route_id id null
        vehicle_trip_direction_id int null
        vehicle_trip_start_time time null
        vehicle_trip_start_date date null
        vehicle_trip_schedule_relationship text:31 null
        vehicle_vehicle_id id null
        vehicle_vehicle_label text null
        vehicle_vehicle_license_plate text null
        vehicle_vehicle_wheelchair_accessible text:31 null
        vehicle_position_latitude degrees:90 null
        vehicle_position_longitude degrees:180 null
        vehicle_position_bearing float null
        vehicle_position_odometer float null
        vehicle_position_speed float null
        vehicle_current_stop_sequence int null
        vehicle_stop_id id null
        vehicle_current_status text null
        vehicle_timestamp timestamp null
        vehicle_congestion_level text null
        vehicle_occupancy_status text null
        vehicle_occupancy_percentage float null
    """),
    foreign_keys=_keys("feed_message feed_message.feed_message_id?"),
)
ALERT = TableSpec(
    "alert",
    "Alert",
    _columns(
        """
        alert_id id
        route_id id
        trip_id id
        service_date date
        service_start_time local_time
        service_end_time local_time
        alert_header text
        alert_description long_text
        alert_url url null
        cause enum
        effect enum
        severity enum
        published timestamp
        updated timestamp
        informed_entity json
        """,
        cause=CAUSE,
        effect=EFFECT,
        severity=SEVERITY,
    ),
)

SCHEDULE = {t.name: t for t in (AGENCY, STOPS, ROUTES, CALENDAR, CALENDAR_DATES, SHAPES, TRIPS, STOP_TIMES, FARE_ATTRIBUTES, FARE_RULES, FEED_INFO)}
REALTIME = {t.name: t for t in (FEED_MESSAGE, TRIP_UPDATE, STOP_TIME_UPDATE, VEHICLE_POSITION, ALERT)}
TABLES = SCHEDULE | REALTIME

#: References between schedule files, which feeds follow by convention; checked on request, within one feed.
SCHEDULE_LINKS = {
    "routes": _keys("agency_id agency.agency_id"),
    "trips": _keys("route_id routes.route_id", "shape_id shapes.shape_id?"),
    "stop_times": _keys("trip_id trips.trip_id", "stop_id stops.stop_id"),
    "stops": _keys("parent_station stops.stop_id?"),
    "fare_rules": _keys("fare_id fare_attributes.fare_id", "route_id routes.route_id"),
}
