"""String functions of the train feed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trackcast.config import HIGH_SPEED_CATEGORIES, MAJOR_CITIES, REGIONAL_CATEGORIES


def extract_destination(route: Column) -> Column:
    """With ``<br>``: the part after it, up to ``(``, trimmed; else the trimmed
    route; null or empty gives ''."""
    after = F.get(F.split(route, "<br>"), 1)
    dest = F.trim(F.substring_index(after, "(", 1))
    return (F.when(route.isNull() | (route == ""), F.lit(""))
            .when(route.contains("<br>"), dest)
            .otherwise(F.trim(route)))


def parse_delay(text: Column, allow_negative: bool = False) -> Column:
    """All-digit text to its number, anything else 0 (negative numbers too, unless
    ``allow_negative``, N17). A long; digits beyond 64 bits give null."""
    digits = "^-?[0-9]+$" if allow_negative else "^[0-9]+$"
    return F.when(F.coalesce(text.rlike(digits), F.lit(False)), text.try_cast("bigint")).otherwise(F.lit(0).cast("bigint"))


def pick_delay(departure: Column, arrival: Column) -> Column:
    return F.when(departure != 0, departure).otherwise(arrival)


def delay_status(actual_departure: Column, delay: Column) -> Column:
    cancelled = F.coalesce(actual_departure.contains("X") | actual_departure.contains("Non rilevato"), F.lit(False))
    return (F.when(cancelled, F.lit("cancelled"))
            .when(delay > 5, F.lit("delayed"))
            .when(delay < -2, F.lit("early"))
            .otherwise(F.lit("on_time")))


def is_major_destination(destination: Column) -> Column:
    return F.coalesce(destination.rlike("|".join(MAJOR_CITIES)), F.lit(False))


def is_high_speed(category: Column) -> Column:
    return F.coalesce(category.isin(*HIGH_SPEED_CATEGORIES), F.lit(False))


def is_regional(category: Column) -> Column:
    return F.coalesce(category.isin(*REGIONAL_CATEGORIES), F.lit(False))


def route_complexity(route: Column) -> Column:
    return F.coalesce(F.length(route), F.lit(0))
