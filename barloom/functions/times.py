"""Date and time column functions. All times are UTC."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column
from pyspark.sql import functions as F

# English names of months and days, known by their first three letters.
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
WEEKDAYS = ("mon", "tue", "wed", "thu", "fri", "sat", "sun")

# What a time of day, its zone, and a date may look like, in lower case.
_CLOCK = r"(?<![0-9])(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,](\d{1,9}))?)?\s*([ap])?(?:\.?m\.?)?(?![0-9:a-y])"
_COMPACT_CLOCK = r"^\d{8}[t ]?(\d{2})(\d{2})(\d{2})$"
_ZONE = r"\s*(z|utc|gmt|[+-]\d{2}:?\d{2})$"
_MONTH = f"({'|'.join(MONTHS)})[a-z]*"
_DAY, _YEAR, _GAP = r"(\d{1,2})(?:st|nd|rd|th)?", r"(\d{4}|\d{2})", r"[-\s./]+"
# pattern, and which of its groups are year, month and day; `first` and `second` are month and day unless that cannot be
_DATES = (
    (r"^(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})$", ("year", "month", "day")),
    (r"^(\d{4})(\d{2})(\d{2})(?:[t ]?\d{6})?$", ("year", "month", "day")),
    (r"^(\d{1,2})[-/.](\d{1,2})[-/.](\d{4}|\d{2})$", ("first", "second", "year")),
    (f"^{_DAY}{_GAP}{_MONTH}{_GAP}{_YEAR}$", ("day", "month", "year")),
    (f"^{_MONTH}{_GAP}{_DAY}{_GAP}{_YEAR}$", ("month", "day", "year")),
    (f"^(\\d{{4}}){_GAP}{_MONTH}{_GAP}{_DAY}$", ("year", "month", "day")),
    (f"^{_MONTH}{_GAP}(\\d{{4}})$", ("month", "year")),
    (r"^(\d{4})[-/](\d{1,2})$", ("year", "month")),
    (r"^(\d{1,2})[-/](\d{4})$", ("month", "year")),
    (r"^(\d{4})$", ("year",)),
)
# two digits of a year: up to this one of 2000, from the next on of 1900
_PIVOT = 68


def utc_naive(value: Column) -> Column:
    """Instant to the wall clock of UTC, without a zone."""
    return F.convert_timezone(None, F.lit("UTC"), value.cast("timestamp_ntz"))


def local_naive(value: Column, zone: str = "UTC") -> Column:
    """Instant to the wall clock of `zone`: the zone label is dropped, the time is kept."""
    return F.convert_timezone(None, F.lit(zone), value.cast("timestamp_ntz"))


def _number(text: Column) -> Column:
    return F.when(text != "", text).cast("int")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    return F.element_at(F.transform(F.array(value), body), 1)


_PARTS = ("year", "month", "day", "first", "second")


def _date_texts(text: Column) -> Column:
    """Struct of the parts of a text without time of day, as texts; null where no pattern fits. No text fits two of them, and
    only the one that fits is taken apart."""
    absent = F.lit(None).cast("string")
    found = F
    for pattern, names in _DATES:
        parts = (F.regexp_extract(text, pattern, names.index(n) + 1) if n in names else absent for n in _PARTS)
        found = found.when(text.rlike(pattern), F.struct(*(part.alias(n) for n, part in zip(_PARTS, parts))))
    return found


def _date_parts(texts: Column) -> Column:
    """Struct of year, month and day as numbers."""

    def month_number(text: Column) -> Column:
        place = F.array_position(F.array(*(F.lit(name) for name in MONTHS)), text)
        return F.when(text.rlike("^[a-z]"), place.cast("int")).otherwise(text.try_cast("int"))

    year = texts["year"]
    short = year.cast("int") + F.when(year.cast("int") <= _PIVOT, 2000).otherwise(1900)
    first, second = texts["first"].cast("int"), texts["second"].cast("int")
    swapped = first > 12
    return F.struct(
        F.when(F.length(year) == 2, short).otherwise(year.cast("int")).alias("year"),
        F.coalesce(F.when(swapped, second).otherwise(first), month_number(texts["month"]), F.when(year.isNotNull(), 1)).alias("month"),
        F.coalesce(F.when(swapped, first).otherwise(second), texts["day"].cast("int"), F.when(year.isNotNull(), 1)).alias("day"),
    )


def _zone_parts(text: Column, has_clock: Column) -> Column:
    """Struct of the text without zone, and the zone."""
    zone = F.when(has_clock, F.regexp_extract(text, _ZONE, 1)).otherwise("")
    bare = F.when(has_clock, F.regexp_replace(text, _ZONE, "")).otherwise(text)
    return F.struct(bare.alias("bare"), zone.alias("zone"))


def _clock_parts(bare: Column, has_clock: Column) -> Column:
    """Struct of the texts of hour, minute, second, fraction and half of the day."""
    compact = [F.regexp_extract(bare, _COMPACT_CLOCK, i) for i in (1, 2, 3)]
    clock = [F.when(has_clock, F.regexp_extract(bare, _CLOCK, i + 1)).otherwise(other) for i, other in enumerate((*compact, "", ""))]
    return F.struct(*(c.alias(n) for n, c in zip(("hour", "minute", "second", "fraction", "half"), clock)))


def _general_time(value: Column) -> Column:
    """Text with a date in one of many forms, with or without time of day and zone. Each step is bound to a name, as an
    expression that others repeat is computed again for each."""
    return _let(F.lower(F.trim(F.regexp_replace(value, "[,\\s]+", " "))), lambda text: _let(text.rlike(_CLOCK), partial(_time_of, text)))


def _time_of(text: Column, has_clock: Column) -> Column:
    def placed(z: Column, c: Column) -> Column:
        hour, half = F.coalesce(_number(c["hour"]), F.lit(0)), c["half"]
        hour = F.when(half == "", hour).when((hour < 1) | (hour > 12), None).otherwise(hour % 12 + F.when(half == "p", 12).otherwise(0))
        minute = F.coalesce(_number(c["minute"]), F.lit(0))
        second = F.coalesce(F.nullif(c["second"], F.lit("")), F.lit("0"))
        exact = F.concat(second, F.lit("."), F.rpad(F.left(c["fraction"], F.lit(6)), 6, "0")).cast("decimal(8,6)")
        dated = F.when(has_clock, F.regexp_replace(z["bare"], r"[t\s]*" + _CLOCK, "")).otherwise(text)
        day = F.trim(F.regexp_replace(dated, f"^({'|'.join(WEEKDAYS)})[a-z]*\\.?\\s+", ""))
        hours, minutes = (F.substring(F.replace(z["zone"], F.lit(":")), start, 2) for start in (2, 4))
        sign = F.concat(F.left(z["zone"], F.lit(1)), F.lit("1")).cast("int")
        ahead = F.when(z["zone"].rlike("^[+-]"), sign * (hours.cast("int") * 60 + minutes.cast("int")))

        def made(d: Column) -> Column:
            return F.try_make_timestamp(d["year"], d["month"], d["day"], hour, minute, exact)

        time = _let(_let(_let(day, _date_texts), _date_parts), made)
        return time - F.make_dt_interval(mins=F.coalesce(ahead, F.lit(0)))

    return _let(_zone_parts(text, has_clock), lambda z: _let(_clock_parts(z["bare"], has_clock), partial(placed, z)))


def to_time(value: Column) -> Column:
    """Text with a date in any common form to a timestamp, null when it has none.

    Year, month and day in this order, or month, day and year (day first where the first cannot be a month), month
    names, dates without day (the first), a time of day with seconds, fraction and AM or PM, and a zone (Z, UTC, GMT or an
    offset); texts without zone are UTC. A time of day without a date is none.
    """
    text = value.cast("string")
    # the common form needs no patterns
    plain = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}:\d{2}(\.\d{1,6})?)?$"), F.try_to_timestamp(text))
    return F.coalesce(plain, _general_time(text))


def day_start(value: Column) -> Column:
    return F.date_trunc("DAY", value)


def day_end(value: Column) -> Column:
    """Start of the next day: the open end of the day range."""
    return F.date_trunc("DAY", value) + F.expr("INTERVAL 1 DAY")


def utc_midnight(text: Column, strict: bool = True) -> Column:
    """`YYYY-MM-DD` to midnight; strict form fails on bad text, the other gives null."""
    parsed = F.when(text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), F.try_to_timestamp(text, F.lit("yyyy-M-d")))
    if not strict:
        return parsed
    message = F.concat(F.lit("not a YYYY-MM-DD date: "), text)
    return F.when(text.isNotNull() & parsed.isNull(), F.raise_error(message)).otherwise(parsed)


def rfc3339(value: Column) -> Column:
    """Date as `...T00:00:00Z`; a time of day is dropped."""
    return F.date_format(F.to_date(value), "yyyy-MM-dd'T00:00:00Z'")


def date_text(value: Column, form: str = "yyyy-MM-dd") -> Column:
    return F.date_format(value, form)
