"""Column helpers. All are native expressions, so they stay in generated code and can be pushed down where Spark can."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ZONE = "America/Sao_Paulo"
EARTH_M = 6_371_010.0


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Text to typed values


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(col(c), F.lit(""))


def strict(c: Column | str, kind: str) -> Column:
    """Empty text is null; malformed text fails the job."""
    return blank_to_null(c).cast(kind)


def lenient(c: Column | str, kind: str) -> Column:
    """Malformed text is null."""
    return blank_to_null(c).try_cast(kind)


def comma_decimal(c: Column | str, kind: str = "double") -> Column:
    """Text with a decimal comma, possibly without its leading zero, to a number."""
    text = F.replace(blank_to_null(c), F.lit(","), F.lit("."))
    return text.cast(kind)


def month_from_text(c: Column | str) -> Column:
    """yyyyMM to the first of the month."""
    return F.to_date(col(c), "yyyyMM")


def instant_from_text(day: Column | str, hour: Column | str) -> Column:
    """'2021/01/31' and '0300 UTC' to a wall-clock time in UTC."""
    text = F.concat(col(day), F.lit(" "), F.substring(col(hour), 1, 4))
    return F.to_timestamp_ntz(text, F.lit("yyyy/MM/dd HHmm"))


def wall_clock(year: Column, month: Column, day: Column, hour: Column) -> Column:
    """Numbers, or texts such as '1' and '01', to a wall-clock time."""
    number = lambda c: c.cast("int")
    return F.make_timestamp_ntz(number(year), number(month), number(day), number(hour), F.lit(0), F.lit(0))


# Time


def to_utc(local: Column | str, zone: str = ZONE) -> Column:
    """Wall-clock time in a named zone to wall-clock time in UTC; doesn't depend on the session's zone."""
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), col(local).cast("timestamp_ntz"))


def to_local(utc: Column | str, zone: str = ZONE) -> Column:
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), col(utc).cast("timestamp_ntz"))


def local_exists(local: Column | str, zone: str = ZONE) -> Column:
    """False for wall-clock times that the zone's clocks skipped: they don't survive the way to UTC and back."""
    return to_local(to_utc(local, zone), zone) == col(local).cast("timestamp_ntz")


def month_of(c: Column | str) -> Column:
    return F.trunc(col(c).cast("date"), "month")


def month_index(c: Column | str) -> Column:
    """Months since year 0; differences count month boundaries."""
    return F.year(col(c)) * 12 + F.month(col(c)) - 1


def iso_weekday(c: Column | str) -> Column:
    """Monday 1 to Sunday 7."""
    return F.weekday(col(c).cast("date")) + 1


def hours_in_month(c: Column | str) -> Column:
    return F.day(F.last_day(col(c).cast("date"))) * 24


def hours_between(start: Column | str, end: Column | str) -> Column:
    return F.timestamp_diff("HOUR", col(start), col(end))


def utc_offset_hours(utc: Column | str, zone: str = ZONE) -> Column:
    return F.timestamp_diff("HOUR", col(utc).cast("timestamp_ntz"), to_local(utc, zone))


def easter(year: Column | str) -> Column:
    """Easter Sunday by the anonymous Gregorian computus, in integer arithmetic."""
    y = col(year).cast("int")
    div = lambda a, b: F.floor(a / b).cast("int")
    golden, century = y % 19, div(y, 100)
    leap = century - div(century, 4) - div(8 * century + 13, 25)
    epact = (leap + 19 * golden + 15) % 30
    moon = epact - div(epact, 28) * (1 - div(epact, 28) * div(29, epact + 1) * div(21 - golden, 11))
    weekday = (y + div(y, 4) + moon + 2 - century + div(century, 4)) % 7
    shift = moon - weekday
    month = 3 + div(shift + 40, 44)
    return F.make_date(y, month, shift + 28 - 31 * div(month, 4))


# Numbers


def stable_round(c: Column | str, places: int = 3) -> Column:
    """Half-up rounding through a decimal, so that differences in the last bits of parallel sums don't show."""
    return F.round(col(c).cast("decimal(28,9)"), places).cast("double")


def ratio(a: Column | str, b: Column | str) -> Column:
    """Null where the divisor is zero."""
    return F.try_divide(col(a), col(b))


def percent_change(new: Column | str, old: Column | str) -> Column:
    """NaN where the base is zero."""
    return F.when(col(old) == 0, F.lit(float("nan"))).otherwise(100 * (col(new) / F.nullif(col(old), F.lit(0)) - 1))


def strict_greatest(*columns: Column | str) -> Column:
    """Null if any argument is null."""
    cs = [col(c) for c in columns]
    missing = cs[0].isNull()
    for c in cs[1:]:
        missing = missing | c.isNull()
    return F.when(~missing, F.greatest(*cs))


def strict_least(*columns: Column | str) -> Column:
    cs = [col(c) for c in columns]
    missing = cs[0].isNull()
    for c in cs[1:]:
        missing = missing | c.isNull()
    return F.when(~missing, F.least(*cs))


def clip(c: Column | str, low: Column, high: Column) -> Column:
    return F.least(F.greatest(col(c), low), high)


def distance_m(lat1: Column | str, lon1: Column | str, lat2: Column | str, lon2: Column | str) -> Column:
    """Great-circle metres by the haversine formula."""
    a, b = F.radians(col(lat1)), F.radians(col(lat2))
    half = lambda x: F.pow(F.sin(x / 2), F.lit(2))
    h = half(b - a) + F.cos(a) * F.cos(b) * half(F.radians(col(lon2)) - F.radians(col(lon1)))
    return 2 * EARTH_M * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


# Hashes and draws


def short_id(*parts: Column | str, length: int = 12) -> Column:
    return F.substring(F.sha2(F.concat_ws("|", *[col(p) for p in parts]), 256), 1, length)


def drawn_index(key: Column | str, n: Column | int) -> Column:
    """A number under n from a hash of the key: the same draw for the same key, wherever it is computed.

    Fifteen hexadecimal digits fit a signed 64-bit integer.
    """
    digits = F.conv(F.substring(F.sha2(col(key), 256), 1, 15), 16, 10).cast("bigint")
    return digits % (n if isinstance(n, Column) else F.lit(n))


# Presentation


def local_number(c: Column | str, places: int = 2) -> Column:
    """1234.5 as '1.234,50'."""
    return F.translate(F.format_number(col(c), places), ",.", ".,")


def digit_mask(c: Column | str) -> Column:
    return F.regexp_replace(col(c), r"\d", "9")
