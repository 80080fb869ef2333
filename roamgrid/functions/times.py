"""Dates: parsing, solar local time, text sanity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# The usual form, which a cast reads: a date, alone or with a time to the second, a fraction, and Z or an offset in hours and minutes.
ISO_TEXT = r"^(?!0000)\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}:\d{2}(\.\d{1,9})?(Z|[+-](0\d|1[0-7]):[0-5]\d)?)?\z"
# The other forms of ISO 8601: calendar and week dates with or without hyphens, any separator, hours alone or with minutes and seconds, a
# fraction of the last second, an offset of the same shape. ``Z`` has been written as an offset before.
_CLOCK = r"(\d{2})(?::(\d{2})(?::(\d{2}))?|(\d{2})(\d{2})?)?(?:[.,](\d+))?"
_FORMS = rf"(?s)^(\d{{4}}-\d{{2}}-\d{{2}}|\d{{8}}|\d{{4}}-W\d{{2}}(?:-\d)?|\d{{4}}W\d{{2}}\d?)(?:.{_CLOCK}(?:([+-]){_CLOCK})?)?\z"
# Date, hour, minute, second, fraction, sign of the offset, and its hour, minute, second and fraction.
_FIELDS = "$1|$2|$3$5|$4$6|$7|$8|$9|$10$12|$11$13|$14"
_DAY = 86_400_000_000


def _date(text: Column) -> Column:
    """A calendar or week date; NULL if there is no such day."""
    plain = F.replace(text, F.lit("-"), F.lit(""))
    year = F.substring(plain, 1, 4)
    calendar = F.concat_ws("-", year, F.substring(plain, 5, 2), F.substring(plain, 7, 2)).try_cast("date")
    # Week 1 is the one with the fourth of January; a week without a day means its Monday.
    fourth = F.concat(year, F.lit("-01-04")).try_cast("date")
    week = F.substring(plain, 6, 2).try_cast("int")
    day = F.coalesce(F.substring(plain, 8, 1).try_cast("int"), F.lit(1))
    monday = F.date_add(F.date_sub(fourth, F.weekday(fourth)), (week - 1) * 7)
    by_week = F.when((F.weekofyear(monday) == week) & day.between(1, 7), F.date_add(monday, day - 1))
    return F.when(year != "0000", F.when(F.substring(plain, 5, 1) == "W", by_week).otherwise(calendar))


def _micros(hour: Column, minute: Column, second: Column, fraction: Column) -> Column:
    """Microseconds of the fields of a clock, empty ones as 0; digits after the sixth of the fraction are cut off."""
    def number(text: Column) -> Column:
        return F.coalesce(text.try_cast("long"), F.lit(0))

    return ((number(hour) * 60 + number(minute)) * 60 + number(second)) * 1_000_000 + number(F.rpad(F.substring(fraction, 1, 6), 6, "0"))


def _any_form(text: Column) -> Column:
    field = F.split(F.regexp_replace(F.replace(text, F.lit("Z"), F.lit("+00:00")), _FORMS, _FIELDS), r"\|", -1)

    def at(i: int) -> Column:
        return F.get(field, i)

    day, clock, offset = _date(at(0)), _micros(at(1), at(2), at(3), at(4)), _micros(at(6), at(7), at(8), at(9))
    small = ~(F.coalesce(at(1).try_cast("int"), F.lit(0)) > 23) & ~(F.coalesce(at(2).try_cast("int"), F.lit(0)) > 59) \
        & ~(F.coalesce(at(3).try_cast("int"), F.lit(0)) > 59) & (offset < _DAY)
    instant = F.unix_date(day).cast("long") * _DAY + clock - F.when(at(5) == "-", -offset).otherwise(offset)
    return F.when((F.size(field) == 10) & day.isNotNull() & small, F.timestamp_micros(instant))


def parse_utc(text: Column) -> Column:
    """ISO 8601 text to a UTC instant; text without an offset is UTC. The session time zone must be UTC.

    The cast alone would also accept a bare year, a time of day, one-digit fields, blanks around the text and names of zones, so the
    whole text must have the usual form first. Rarer forms are taken apart by columns, and only they pay for it.
    """
    return F.when(text.rlike(ISO_TEXT), text.try_cast("timestamp")).when(
        F.replace(text, F.lit("Z"), F.lit("+00:00")).rlike(_FORMS), _any_form(text))


def solar_local(utc: Column, lng: Column) -> Column:
    """UTC plus four minutes per degree, rounded half to even."""
    return F.timestamp_add("MINUTE", F.rint(lng * 4).cast("int"), utc)


def local_columns(utc: Column, lng: Column) -> dict[str, Column]:
    local = solar_local(utc, lng)
    return {"appeared_local": local, "local_hour": F.hour(local), "local_dow": F.weekday(local)}


def local_date(local: Column) -> Column:
    return F.date_format(local, "yyyy-MM-dd")


def iso_z(utc: Column) -> Column:
    """ISO text with ``Z``: microseconds only where there are any."""
    return F.concat(
        F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss"),
        F.when(F.unix_micros(utc) % 1_000_000 != 0, F.date_format(utc, ".SSSSSS")).otherwise(F.lit("")),
        F.lit("Z"),
    )


def sane_date_text(text: Column) -> Column:
    """The text itself when it looks like a full date and time, else NULL."""
    return F.when((F.length(text) >= 19) & (F.substring(text, 5, 1) == "-"), text)


def offset_minutes(local_time: Column, iso_utc: Column) -> Column:
    """Minutes from UTC to the local clock text, folded to (-10 h, +14 h]; NULL when a part is not a number."""
    def two_digits(text: Column, start: int) -> Column:
        return F.substring(text, start, 2).try_cast("int")

    local = two_digits(local_time, 1) * 60 + two_digits(local_time, 4)
    utc = two_digits(iso_utc, 12) * 60 + two_digits(iso_utc, 15)
    diff = F.pmod(local - utc, F.lit(1440))
    return F.when(diff > 840, diff - 1440).otherwise(diff)


def hour_key(hour: Column) -> Column:
    return F.lpad(hour.cast("string"), 2, "0")
