"""Time functions on ``timestamp_ntz`` with zone-free microsecond arithmetic.

Instants are kept as UTC wall-clock values; nothing here depends on the
session time zone, so results are identical on every executor and cluster.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trackcast.config import RUSH_HOURS, SEASONS, TIME_PERIOD_BINS, WEEKEND_DAYS

US_PER_MIN = 60_000_000
US_PER_HOUR = 60 * US_PER_MIN


def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_us(ts) -> Column:
    """Microseconds since 1970-01-01 of a wall-clock timestamp."""
    return F.timestamp_diff("MICROSECOND", _epoch(), col_(ts).cast("timestamp_ntz"))


def from_epoch_us(us: Column) -> Column:
    return F.timestamp_add("MICROSECOND", us, _epoch())


def micros_past_hour(ts) -> Column:
    return F.pmod(epoch_us(ts), F.lit(US_PER_HOUR))


def hour_floor(ts) -> Column:
    """Truncate to the whole hour."""
    t = col_(ts)
    return F.timestamp_add("MICROSECOND", -micros_past_hour(t), t.cast("timestamp_ntz"))


def round_hour_half_up(ts) -> Column:
    """Minute >= 30 goes to the next hour, seconds ignored below that (F2)."""
    return hour_floor(F.timestamp_add("MINUTE", F.lit(30), col_(ts).cast("timestamp_ntz")))


def round_hour_half_even(ts, zone: str = "UTC") -> Column:
    """Nearest hour, exact half hour goes to the hour that is even on the clock of ``zone``."""
    t = col_(ts)
    r = micros_past_hour(t)
    base = hour_floor(t)
    half = F.lit(30 * US_PER_MIN)
    clock = base if zone == "UTC" else F.convert_timezone(F.lit("UTC"), F.lit(zone), base)
    up = (r > half) | ((r == half) & (F.hour(clock) % 2 == 1))
    return F.when(t.isNull(), F.lit(None)).when(up, F.timestamp_add("HOUR", F.lit(1), base)).otherwise(base)


def abs_diff_us(a, b) -> Column:
    """Absolute time difference in microseconds."""
    return F.abs(F.timestamp_diff("MICROSECOND", col_(b), col_(a)))


# ---- temporal parts (F6-F10) -------------------------------------------------

def temporal_parts(ts) -> dict[str, Column]:
    t = col_(ts)
    return {
        "hour_of_day": F.hour(t),
        "day_of_week": F.weekday(t),  # 0 = Monday
        "day_of_month": F.dayofmonth(t),
        "month": F.month(t),
        "quarter": F.quarter(t),
        "year": F.year(t),
    }


def is_weekend(day_of_week: Column) -> Column:
    return F.coalesce(day_of_week.isin(*WEEKEND_DAYS), F.lit(False))


def is_rush_hour(hour: Column) -> Column:
    pred = F.lit(False)
    for lo, hi in RUSH_HOURS:
        pred = pred | ((hour >= lo) & (hour < hi))
    return F.coalesce(pred, F.lit(False))


def season(month: Column) -> Column:
    expr = None
    for m, name in SEASONS.items():
        expr = (F.when(month == m, name) if expr is None else expr.when(month == m, name))
    return expr


def time_period(hour: Column) -> Column:
    from trackcast.functions.binning import bin_column
    edges, labels = TIME_PERIOD_BINS
    return bin_column(hour, edges, labels, include_lowest=True)


# ---- parsing (F1, F3, F4) -----------------------------------------------------

# FIXED VALUES: accepted timestamp text formats, tried in order.
TIMESTAMP_FORMATS = (
    "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm",
    "yyyy-MM-dd HH:mm:ss.SSSSSS",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd HH:mm",
    "yyyy-MM-dd",
    "dd/MM/yyyy HH:mm:ss",
    "dd/MM/yyyy HH:mm",
    "dd/MM/yyyy",
    "yyyyMMdd'T'HHmmss",
    "yyyyMMdd'T'HHmm",
    "MMM d yyyy HH:mm:ss",
    "MMM d yyyy HH:mm",
    "MMM d yyyy",
    "d MMM yyyy HH:mm:ss",
    "d MMM yyyy HH:mm",
    "d MMM yyyy",
)

#: A zone at the end of a text that has a time: Z, UTC or an offset such as +02:00, +0200 or +02.
ZONE_SUFFIX = r"(?<=[0-9])\s*(Z|UTC|[+-][0-9]{2}(?::?[0-9]{2})?)$"


def parse_timestamp(c, formats=TIMESTAMP_FORMATS, source_tz: str = "UTC") -> Column:
    """Text or timestamp to the UTC wall clock as timestamp_ntz; unparseable text gives null (F1).

    A text that names its zone or offset is taken at its word; a text without one is in ``source_tz``.
    Only texts with a time of day can have an offset (``-01-15`` of a plain date is none).
    """
    x = F.trim(col_(c).cast("string"))
    zone = F.when(x.contains(":") | x.rlike("T[0-9]{4}"), F.regexp_extract(x, ZONE_SUFFIX, 1)).otherwise(F.lit(""))
    named = zone != ""
    bare = F.when(named, F.regexp_replace(x, ZONE_SUFFIX, "")).otherwise(x)
    parsed = F.coalesce(*[F.try_to_timestamp(bare, F.lit(f)) for f in formats]).cast("timestamp_ntz")
    digits = F.rpad(F.regexp_replace(zone, "[^0-9]", ""), 4, "0")
    minutes = F.when(zone.isin("Z", "UTC"), F.lit(0)).otherwise(
        (F.substring(digits, 1, 2).try_cast("int") * 60 + F.substring(digits, 3, 2).try_cast("int"))
        * F.when(zone.startswith("-"), -1).otherwise(1))
    local = parsed if source_tz == "UTC" else F.convert_timezone(F.lit(source_tz), F.lit("UTC"), parsed)
    return F.when(named, F.timestamp_add("MINUTE", -minutes, parsed)).otherwise(local)


def strict_weather_time(c) -> Column:
    """Only ``yyyy-MM-dd'T'HH:mm`` is accepted."""
    return F.try_to_timestamp(col_(c), F.lit("yyyy-MM-dd'T'HH:mm")).cast("timestamp_ntz")


def parse_clock(text, day, use_suffix_date: bool = False) -> Column:
    """``HH:MM[:SS][ - DD/MM]`` to that day's HH:MM:00.

    ``X``, ``Non rilevato``, blank, no colon or a non-number give null; the
    ``DD/MM`` suffix is ignored (the query day is kept) unless ``use_suffix_date``
    (N16): then it replaces day and month, and an impossible date gives null.
    """
    s = col_(text)
    time_part = F.substring_index(s, " - ", 1)
    parts = F.split(time_part, ":")
    hh = F.get(parts, 0).try_cast("int")
    mm = F.get(parts, 1).try_cast("int")
    ok = (s.isNotNull() & (F.trim(s) != "") & ~s.isin("X", "Non rilevato") & time_part.contains(":")
          & hh.between(0, 23) & mm.between(0, 59))
    d = col_(day).cast("date")
    if use_suffix_date:
        suffix = F.regexp_extract(s, r" - ([0-9]{1,2}/[0-9]{1,2})\s*$", 1)
        d = F.when(suffix == "", d).otherwise(F.try_to_timestamp(
            F.concat_ws("/", suffix, F.year(d).cast("string")), F.lit("d/M/yyyy")).cast("date"))
    stamp = F.make_timestamp_ntz(F.year(d), F.month(d), F.dayofmonth(d), hh, mm, F.lit(0))
    return F.when(ok, stamp)
