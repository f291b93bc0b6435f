"""Semantic types: how a text becomes a typed value, what makes it a violation, and how it is written again.

Each type has three Column builders. ``parse`` gives the typed value, or NULL for one that is refused;
``violation`` names the first rule that a value breaks, or NULL; ``render`` writes the value as feeds have it.
Empty and missing values break no rule here: whether one may be absent is up to the column, not the type.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from functools import lru_cache
from zoneinfo import available_timezones

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import times

Build = Callable[[Column], Column]

# The patterns and bounds that decide what is accepted.
COLOR = r"\A[0-9A-Fa-f]{6}\z"
CURRENCY = r"\A[A-Z]{3}\z"
LANGUAGE = r"\A[A-Za-z]{2,3}(?:-[A-Za-z0-9]{2,8})*\z"
PHONE = r"\A[0-9+()\-.\s]{1,32}\z"
PRINTABLE = r"\A[\x20-\x7E]+\z"
EMAIL = r"\A[A-Za-z0-9!#$%&'*+/=?^_`{|}~-]+(?:\.[A-Za-z0-9!#$%&'*+/=?^_`{|}~-]+)*@(?:(?:[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?\.)+(?:[A-Za-z0-9-]{2,63})|localhost)\z"
URL = r"\A(?:[Hh][Tt][Tt][Pp][Ss]?|[Ff][Tt][Pp][Ss]?)://(?:[^\s:@/]+(?::[^\s:@/]*)?@)?(?:(?:[0-9]{1,3}\.){3}[0-9]{1,3}|\[[0-9A-Fa-f:.]+\]|(?:[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?\.)+[A-Za-z][A-Za-z0-9-]{0,61}[A-Za-z0-9]|localhost)(?::[0-9]{1,5})?(?:[/?#]\S*)?\z"
LATITUDE, LONGITUDE = 90, 180


@dataclass(frozen=True)
class SemanticType:
    name: str
    spark_type: T.DataType
    normalize: Build = lambda c: c
    #: (code, does the text break it?), in the order in which they are tested
    rules: tuple[tuple[str, Build], ...] = ()
    render: Build = lambda c: F.coalesce(c.cast("string"), F.lit(""))

    def violation(self, c: Column) -> Column:
        """Code of the first broken rule; NULL for none, and for NULL and empty values."""
        if not self.rules:
            return F.lit(None).cast("string")
        first = F.coalesce(*(F.when(broken(c), F.lit(code)) for code, broken in self.rules))
        return F.when(c.isNotNull() & (c != ""), first)

    def parse(self, c: Column) -> Column:
        """The normalized, typed value; NULL where a rule is broken."""
        return F.when(self.violation(c).isNull(), self.normalize(c)).cast(self.spark_type)

    def checked(self, *rules: tuple[str, Build]) -> SemanticType:
        """The type with further rules."""
        return replace(self, rules=self.rules + rules)


def max_length(n: int) -> tuple[str, Build]:
    """Code points count, as they do for Python."""
    return "max_length", lambda c: F.char_length(c) > n


def matching(pattern: str, change: Build = lambda c: c) -> tuple[str, Build]:
    return "invalid", lambda c: ~change(c).rlike(pattern)


def parsed(read: Build) -> tuple[str, Build]:
    """What can't be read is invalid."""
    return "invalid", lambda c: read(c).isNull()


def text(n: int = 255) -> SemanticType:
    return SemanticType("text", T.StringType(), rules=(max_length(n),))


def unbounded_text() -> SemanticType:
    return SemanticType("text", T.StringType())


def identifier(n: int = 255, printable_ascii: bool = False) -> SemanticType:
    """Any text of up to ``n`` characters; ``printable_ascii`` allows no others."""
    plain = SemanticType("id", T.StringType(), rules=(max_length(n),))
    return plain.checked(matching(PRINTABLE)) if printable_ascii else plain


def color() -> SemanticType:
    return SemanticType("color", T.StringType(), F.upper, (matching(COLOR), max_length(6)))


def currency_code() -> SemanticType:
    return SemanticType("currency_code", T.StringType(), F.upper, (matching(CURRENCY, F.upper), max_length(3)))


def decimal(precision: int, scale: int, name: str = "decimal") -> SemanticType:
    """Refused if digits or decimal places are too many; nothing is rounded."""
    kind, wide = T.DecimalType(precision, scale), T.DecimalType(38, 18)
    exact = lambda c: c.try_cast(wide) == c.try_cast(kind)
    rules = (parsed(lambda c: c.try_cast("double")), ("max_digits", lambda c: c.try_cast(kind).isNull()), ("max_decimal_places", lambda c: ~exact(c)))
    return SemanticType(name, kind, lambda c: c.try_cast(kind), rules)


def currency_amount(precision: int = 18, scale: int = 6) -> SemanticType:
    return decimal(precision, scale, "currency_amount")


def _degrees(name: str, most: int) -> SemanticType:
    kind = decimal(9, 6, name)
    value = lambda c: c.try_cast("double")
    return kind.checked(("min_value", lambda c: value(c) < -most), ("max_value", lambda c: value(c) > most))


def latitude() -> SemanticType:
    return _degrees("latitude", LATITUDE)


def longitude() -> SemanticType:
    return _degrees("longitude", LONGITUDE)


def service_date() -> SemanticType:
    return SemanticType("service_date", T.DateType(), times.service_date, (parsed(times.service_date),), times.render_date)


def gtfs_time() -> SemanticType:
    """Seconds since the service day began; hours may exceed 24."""
    return SemanticType("gtfs_time", T.IntegerType(), times.time_to_seconds, (parsed(times.time_to_seconds),), lambda c: F.coalesce(times.format_seconds(c), F.lit("")))


def local_time(max_hour: int | None = 23) -> SemanticType:
    """A time as text; white space around it counts for nothing, its length neither, as it is normalized first. Without ``max_hour``, hours of up to three digits."""
    read = lambda c: times.normalize_time(c, max_hour)
    code, longer = max_length(11)
    return SemanticType("local_time", T.StringType(), read, (parsed(read), (code, lambda c: longer(read(c)))))


def email() -> SemanticType:
    return SemanticType("email", T.StringType(), rules=(max_length(254), matching(EMAIL)))


def url(n: int = 200) -> SemanticType:
    return SemanticType("url", T.StringType(), rules=(max_length(n), matching(URL)))


def phone() -> SemanticType:
    return SemanticType("phone", T.StringType(), rules=(matching(PHONE), max_length(32)))


def language() -> SemanticType:
    return SemanticType("language", T.StringType(), rules=(matching(LANGUAGE), max_length(35)))


@lru_cache(maxsize=1)
def timezones() -> tuple[str, ...]:
    """The names of the tz database of this machine; Spark's own parser takes others besides."""
    return tuple(sorted(available_timezones()))


def timezone() -> SemanticType:
    known = ("invalid", lambda c: F.contains(c, F.lit(" ")) | ~c.isin(*timezones()))
    return SemanticType("timezone", T.StringType(), rules=(max_length(64), known))


def enum_int(codes: Sequence[int]) -> SemanticType:
    if not codes:
        raise TypeError("enum_int needs at least one code")
    value = lambda c: times.strip(c).try_cast("int")
    return SemanticType("enum", T.IntegerType(), value, (parsed(value), ("choice", lambda c: ~value(c).isin(*codes))))


def enum_str(codes: Sequence[str]) -> SemanticType:
    if not codes:
        raise TypeError("enum_str needs at least one code")
    return SemanticType("enum", T.StringType(), rules=(("choice", lambda c: ~c.isin(*codes)),))


def integer(least: int | None = None) -> SemanticType:
    value = lambda c: times.strip(c).try_cast("int")
    kind = SemanticType("integer", T.IntegerType(), value, (parsed(value),))
    return kind if least is None else kind.checked(("min_value", lambda c: value(c) < least))


def boolean() -> SemanticType:
    """1, 0, true and false in any case, as feeds and forms have them."""
    value = lambda c: F.when(F.lower(c).isin("1", "true", "t"), F.lit(True)).when(F.lower(c).isin("0", "false", "f"), F.lit(False))
    return SemanticType("boolean", T.BooleanType(), value, (parsed(value),), lambda c: F.when(c, "1").when(~c, "0").otherwise(""))


def floating() -> SemanticType:
    value = lambda c: c.try_cast("double")
    return SemanticType("float", T.DoubleType(), value, (parsed(value),))


def timestamp() -> SemanticType:
    value = lambda c: c.try_cast("timestamp")
    return SemanticType("timestamp", T.TimestampType(), value, (parsed(value),), lambda c: F.coalesce(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ssXXX"), F.lit("")))


def json_text() -> SemanticType:
    """JSON kept as text; ``F.try_parse_json`` makes it a VARIANT where it is queried."""
    return SemanticType("json", T.StringType(), rules=(("invalid", lambda c: F.try_parse_json(c).isNull()),))


def label(c: Column, labels: dict) -> Column:
    """The display text of an enumerated value; an unknown code is its own text."""
    pairs = F.create_map(*(F.lit(x) for pair in labels.items() for x in pair))
    return F.coalesce(F.try_element_at(pairs, c), c.cast("string"))
