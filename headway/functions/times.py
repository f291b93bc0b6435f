"""Transit times and durations as Column expressions. A value that is not valid gives NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: ASCII white space, for trimming; ``trim`` alone takes only spaces.
BLANKS = " \t\n\r\x0b\x0c"
TIME = r"\A[0-9]{1,3}:[0-9]{2}:[0-9]{2}\z"


def strip(c: Column) -> Column:
    return F.trim(c, F.lit(BLANKS))


def _parts(c: Column, max_hour: int | None) -> tuple[Column, Column, Column, Column]:
    """hour, minute, second of the trimmed text, and whether they are a valid time."""
    text = strip(c)
    pieces = F.split(text, ":")
    h, m, s = (F.get(pieces, F.lit(i)).try_cast("int") for i in range(3))
    valid = text.rlike(TIME) & (m <= 59) & (s <= 59)
    return h, m, s, valid & (h <= max_hour) if max_hour is not None else valid


def normalize_time(c: Column, max_hour: int | None = None) -> Column:
    """``H:MM:SS`` with 1 to 3 hour digits to at least two; NULL if it isn't one, or beyond ``max_hour``."""
    h, m, s, valid = _parts(c, max_hour)
    return F.when(valid, F.format_string("%02d:%02d:%02d", h, m, s))


def time_to_seconds(c: Column) -> Column:
    """INT seconds since the service day began; up to 3,599,999."""
    h, m, s, valid = _parts(c, None)
    return F.when(valid, h * 3600 + m * 60 + s)


def time_to_interval(c: Column) -> Column:
    """INTERVAL DAY TO SECOND since the service day began."""
    return seconds_to_interval(time_to_seconds(c))


def seconds_to_interval(seconds: Column) -> Column:
    zero = F.lit(0)
    return F.when(seconds.isNotNull(), F.make_dt_interval(zero, zero, zero, seconds))


def interval_to_seconds(c: Column) -> Column:
    """Total seconds of an INTERVAL DAY TO SECOND, as a decimal that keeps its fraction."""
    days, hours, minutes = (F.extract(F.lit(part), c) for part in ("DAY", "HOUR", "MINUTE"))
    return days * 86400 + hours * 3600 + minutes * 60 + F.extract(F.lit("SECOND"), c)


def format_seconds(seconds: Column) -> Column:
    """Seconds, cut towards zero, as ``HH:MM:SS`` with more hour digits if needed; NULL for less than 0."""
    whole = seconds.cast("long")
    h, rest = F.floor(whole / 3600), F.pmod(whole, F.lit(3600))
    text = F.format_string("%02d:%02d:%02d", h, F.floor(rest / 60), F.pmod(rest, F.lit(60)))
    return F.when(whole >= 0, text)


def format_interval(c: Column) -> Column:
    return format_seconds(interval_to_seconds(c))


def service_date(c: Column) -> Column:
    """``YYYYMMDD`` or ``YYYY-MM-DD`` with white space around it to DATE; NULL for what is no date from year 1 on."""
    text = strip(c)
    compact = F.when(text.rlike(r"\A[0-9]{8}\z") & (text >= "00010101"), F.try_to_date(text, "yyyyMMdd"))
    iso = F.when(text.rlike(r"\A[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}\z") & (text >= "0001"), text.try_cast("date"))
    return F.coalesce(compact, iso)


def render_date(c: Column) -> Column:
    """DATE to ``YYYYMMDD``; NULL to the empty text."""
    return F.coalesce(F.date_format(c, "yyyyMMdd"), F.lit(""))


def service_instant(date: Column, seconds: Column, timezone: Column) -> Column:
    """The UTC timestamp of a time of a service day, which is measured from noon less twelve hours in the agency's zone."""
    noon = F.to_utc_timestamp(date.cast("timestamp_ntz").cast("timestamp") + F.expr("INTERVAL 12 HOURS"), timezone)
    return F.timestamp_seconds(F.unix_seconds(noon) - 43200 + seconds)
