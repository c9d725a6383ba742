"""Raw payload parsing as Spark jobs over tables of landed documents.

The reference parses one HTTP response at a time; here every landed page or
payload is a row, and parsing is column expressions + ``explode`` -- one
narrow pass, no shuffle. Rejected train entries keep their page id so the
per-page counts and a quarantine table come from the same pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackcast.config import TRAIN_COLUMNS
from trackcast.functions import text as T
from trackcast.functions.timefns import parse_clock
from trackcast.operators.spatial import EXAMPLE_REGION, inside
from trackcast.schemas import HOURLY_PAYLOAD, STATION_FEED

# FIXED VALUES: the page's embedded table and its quoted entries.
TABLE_PATTERN = r"(?s)var table = \[(.*?)\];"
ENTRY_PATTERN = r"'([^']*)'"
BLANK = r"^\s*$"


def page_entries(pages: DataFrame, html: str = "html") -> DataFrame:
    """Per page: whether a table exists and the train entries (quoted,
    non-blank entries after the header), as an array column. With a column ``first`` the rows are fragments of pages, and
    only those that start a page (``first`` 0) have a header."""
    h = F.col(html)
    has_table = F.coalesce(h.rlike(TABLE_PATTERN), F.lit(False))
    body = F.regexp_extract(h, TABLE_PATTERN, 1)
    quoted = F.regexp_extract_all(body, F.lit(ENTRY_PATTERN), 1)
    kept = F.filter(quoted, lambda e: ~e.rlike(BLANK))
    without = F.when(F.size(kept) > 1, F.slice(kept, 2, F.size(kept) - 1)).otherwise(F.array().cast("array<string>"))
    if "first" in pages.columns:
        without = F.when(F.col("first") > 0, kept).otherwise(without)
    trains = F.when(has_table, without).otherwise(F.array().cast("array<string>"))
    return pages.withColumns({"has_table": has_table, "entries_found": F.when(has_table, F.size(kept)).otherwise(0),
                              "train_entries": trains})


def parse_entry(entry: Column, station: Column, day: Column) -> dict[str, Column]:
    """A7 fields of one entry: >= 9 comma fields, trimmed."""
    f = F.split(entry, ",")
    g = lambda i: F.trim(F.get(f, i))
    category, number, route = g(0), g(1), g(2)
    dep_planned, dep_actual = g(6), g(7)
    arr_delay, dep_delay = T.parse_delay(g(5)), T.parse_delay(g(8))
    delay = T.pick_delay(dep_delay, arr_delay)
    status = T.delay_status(dep_actual, delay)
    cancelled_text = dep_actual.contains("X") | dep_actual.contains("Non rilevato")
    scheduled = parse_clock(dep_planned, day)
    actual = F.when(~cancelled_text, parse_clock(dep_actual, day))
    midnight = F.to_timestamp_ntz(F.date_format(day, "yyyy-MM-dd"))
    return {
        "valid": F.size(f) >= 9,
        "train_id": number,
        "timestamp": F.coalesce(scheduled, midnight),
        "station_code": station,
        "scheduled_time": scheduled,
        "actual_time": actual,
        "delay_minutes": delay,
        "train_category": category,
        "route": route,
        "delay_status": status,
        "destination": T.extract_destination(route),
        "is_cancelled": status == F.lit("cancelled"),
    }


def parse_train_pages(pages: DataFrame, *, station: str = "station_code", day: str = "day",
                      page_id: str = "page_id") -> dict[str, DataFrame]:
    """A6 + A7: ``rows`` (parsed trains), ``rejected`` (entries with fewer
    than 9 fields) and ``counts`` (per page: found / kept / rejected). ``pages`` are whole pages, or fragments of
    them with the position of their first train entry in ``first``."""
    first = F.col("first") if "first" in pages.columns else F.lit(0)
    p = page_entries(pages)
    e = p.select(page_id, station, day, "has_table", "entries_found", first.alias("_first"),
                 F.posexplode_outer("train_entries").alias("_at", "entry"))
    # a fragment's number of entries goes with its first row
    e = e.withColumns({"pos": (F.col("_first") + F.col("_at")).cast("int"),
                       "entries_found": F.when(F.coalesce("_at", F.lit(0)) == 0, F.col("entries_found")).otherwise(0)})
    fields = parse_entry(F.col("entry"), F.col(station), F.col(day))
    parsed = e.select(page_id, "pos", "entry", "has_table", "entries_found",
                      *[v.alias(k) for k, v in fields.items()])
    has_entry = F.col("entry").isNotNull()
    rows = parsed.where(has_entry & F.col("valid")).select(page_id, "pos", *TRAIN_COLUMNS)
    rejected = parsed.where(has_entry & ~F.col("valid")).select(page_id, "pos", "entry")
    counts = parsed.groupBy(page_id).agg(
        F.max("has_table").alias("has_table"), F.sum("entries_found").cast("int").alias("entries_found"),
        F.count_if(has_entry & F.col("valid")).alias("kept"),
        F.count_if(has_entry & ~F.col("valid")).alias("rejected"))
    return {"rows": rows, "rejected": rejected, "counts": counts}


def explode_hourly(payloads: DataFrame, *, doc: str = "payload") -> DataFrame:
    """A5: one row per hour of each payload; ``time`` drives, a shorter array
    gives nulls past its end, a payload without ``time`` gives no row. A column ``first`` says that the rows are fragments
    of payloads and where they start."""
    first = F.col("first") if "first" in payloads.columns else F.lit(0)
    p = payloads.withColumn("_p", F.from_json(F.col(doc), HOURLY_PAYLOAD))
    h = F.col("_p.hourly")
    x = p.select(F.col("_p.station_code").alias("station_code"),
                 F.posexplode(F.coalesce(h["time"], F.array().cast("array<string>"))).alias("pos", "time"),
                 h.alias("h"), first.alias("_first"))
    at = lambda name: F.get(F.col("h")[name], F.col("pos"))
    return x.select("station_code", F.col("time").alias("timestamp"), at("temperature_2m").alias("temperature"),
                    at("windspeed_10m").alias("wind_speed"), at("precipitation").alias("precip_mm"),
                    at("weathercode").alias("weather_code"), (F.col("_first") + F.col("pos")).cast("int").alias("pos"))


def parse_station_feed(feed: DataFrame, *, doc: str = "doc", region=EXAMPLE_REGION) -> DataFrame:
    """A8 + D3: blank codes skipped, unparseable coordinates skip the row,
    stations outside the region (or without coordinates) left out."""
    p = feed.select(F.from_json(F.col(doc), STATION_FEED).alias("s"))
    code = F.col("s.codiceStazione")
    lat_t, lon_t = F.col("s.lat"), F.col("s.lon")
    lat, lon = lat_t.try_cast("double"), lon_t.try_cast("double")
    bad = (lat_t.isNotNull() & lat.isNull()) | (lon_t.isNotNull() & lon.isNull())
    out = p.where(F.coalesce(code, F.lit("")) != "").where(~bad).select(
        code.alias("station_code"), F.coalesce(F.col("s.localita.nomeLungo"), F.lit("")).alias("station_name"),
        lat.alias("latitude"), lon.alias("longitude"))
    return out.where(inside(F.col("longitude"), F.col("latitude"), region))
