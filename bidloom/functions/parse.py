"""Scalar parsers: dates, times, money, numbers. Anything unparsable becomes null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import blank_to_null, let, rx, squeeze, strip

MONEY = "decimal(18,2)"

# English month names and their three-letter forms, as accepted by %B and %b.
MONTHS = [
    "january", "february", "march", "april", "may", "june",
    "july", "august", "september", "october", "november", "december",
]


def _month_number(name: Column) -> Column:
    wanted = F.lower(name)
    full = F.array_position(F.array(*(F.lit(m) for m in MONTHS)), wanted)
    short = F.array_position(F.array(*(F.lit(m[:3]) for m in MONTHS)), wanted)
    return F.greatest(full, short)


def _ymd(parts: Column, year: int, month: int, day: int) -> Column:
    two = lambda c: F.lpad(c, 2, "0")
    return F.concat_ws("-", parts[year], two(parts[month]), two(parts[day])).try_cast("date")


def _named_date(parts: Column) -> Column:
    """(month name, day, year); an unknown name gives month 0, hence null."""
    number = F.lpad(_month_number(parts[0]).cast("string"), 2, "0")
    return F.concat_ws("-", parts[2], number, F.lpad(parts[1], 2, "0")).try_cast("date")


def parse_date(value: Column) -> Column:
    """`Month d yyyy` (full or short name, comma optional), `m/d/yyyy` or `yyyy-mm-dd`."""
    return let(squeeze(F.replace(value, F.lit(","), F.lit(""))), lambda t: (
        F.when(t.rlike(r"^[A-Za-z]+ [0-9]{1,2} [0-9]{4}$"), let(F.split(t, " "), _named_date))
        .when(t.rlike(r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$"), let(F.split(t, "/"), lambda p: _ymd(p, 2, 0, 1)))
        .when(t.rlike(r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"), let(F.split(t, "-"), lambda p: _ymd(p, 0, 1, 2)))
    ))


def parse_datetime(date_text: Column, time_text: Column) -> Column:
    """Date as above plus a twelve-hour clock; the clock and AM/PM must be apart (`2:00PM` is null)."""

    def stamp(x: Column) -> Column:
        hour, minute = x["clock"][0].try_cast("int"), x["clock"][1]
        hour24 = hour % 12 + F.when(x["clock"][2] == "PM", 12).otherwise(0)
        text = F.concat(
            x["day"].cast("string"), F.lit(" "), F.lpad(hour24.cast("string"), 2, "0"), F.lit(":"), minute, F.lit(":00")
        )
        return F.when((F.size(x["clock"]) == 3) & hour.between(1, 12), text.try_cast("timestamp_ntz"))

    clock = F.regexp_replace(F.upper(squeeze(time_text)), r"^([0-9]{1,2}):([0-9]{2}) ([AP]M)$", "$1 $2 $3")
    return let(F.struct(parse_date(date_text).alias("day"), F.split(clock, " ").alias("clock")), stamp)


def parse_iso_timestamp(value: Column) -> Column:
    """ISO date or date-time without zone; other shapes are null."""
    shape = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([T ][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?)?$"
    return F.when(value.rlike(shape), value.try_cast("timestamp_ntz"))


def _digits(value: Column) -> Column:
    return blank_to_null(strip(F.replace(value, F.lit(","), F.lit(""))))


def parse_money(value: Column) -> Column:
    return _digits(value).try_cast(MONEY)


def parse_quantity(value: Column) -> Column:
    return _digits(value).try_cast("decimal(18,3)")


def parse_number(value: Column) -> Column:
    return _digits(value).try_cast("double")


def parse_int(value: Column) -> Column:
    return blank_to_null(value).try_cast("int")


def percent_in(line: Column) -> Column:
    """First number directly followed by a percent sign. Lines without the sign, which are most, are not searched, and no empty text
    is cast: that costs an exception."""
    found = F.regexp_extract(line, rx(r"([-+]?\d+(?:\.\d+)?)\s*%"), 1)
    return F.when(line.contains("%"), blank_to_null(found).try_cast("double"))


def percent_text(part: Column, whole: Column) -> Column:
    """`96.0%`, ties to even; a zero whole gives `0%`."""
    return F.when(whole > 0, F.format_string("%.1f%%", F.bround(part / whole * 100, 1))).otherwise("0%")


def money_text(amount: Column) -> Column:
    """Shortest decimal text with at least one digit after the point: 100.0, 1387101.46."""
    return F.regexp_replace(amount.cast(MONEY).cast("string"), r"(\.[0-9])0$", "$1")


def falsy(col: Column, kind: str = "number") -> Column:
    """Null, zero or empty counts as missing."""
    empty = {"number": lambda: col == 0, "text": lambda: col == "", "list": lambda: F.size(col) == 0}[kind]()
    return col.isNull() | empty


def utc_iso(stamp: Column) -> Column:
    """Timestamp as ISO text in UTC, whatever the session zone."""
    return F.date_format(F.to_utc_timestamp(stamp, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
