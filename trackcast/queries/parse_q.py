"""Parser jobs over landed documents."""

from __future__ import annotations


from pyspark.sql import functions as F

from trackcast import landed
from trackcast.catalog import register
from trackcast.functions import text as T
from trackcast.functions.timefns import parse_clock as parse_clock_fn
from trackcast.functions.timefns import strict_weather_time
from trackcast.operators.spatial import EXAMPLE_REGION, ring_edges_sql
from trackcast.schemas import WEATHER
from trackcast.session import new_work_dir
from trackcast.sources import parsers as P
from trackcast.sources import sinks as B

_PG = landed.TRAIN_PAGES_SQL.strip()

_CLOCK = """case when {t} is null or trim({t}) = '' or {t} in ('X', 'Non rilevato')
    or not contains(split_part({t}, ' - ', 1), ':') then null
  when try_cast(split_part(split_part({t}, ' - ', 1), ':', 1) as integer) between 0 and 23
   and try_cast(split_part(split_part({t}, ' - ', 1), ':', 2) as integer) between 0 and 59
  then cast({d} as timestamp) + to_hours(try_cast(split_part(split_part({t}, ' - ', 1), ':', 1) as integer))
       + to_minutes(try_cast(split_part(split_part({t}, ' - ', 1), ':', 2) as integer)) end"""

_DELAY = "case when regexp_matches({x}, '^[0-9]+$') then cast({x} as bigint) else 0 end"

PARSE_CTES = f""",
{_PG},
pg as (
  select page_id, station_code, day, coalesce(regexp_matches(html, '(?s)var table = \\[(.*?)\\];'), false) as has_table,
    list_filter(regexp_extract_all(regexp_extract(html, '(?s)var table = \\[(.*?)\\];', 1), '''([^'']*)''', 1),
                lambda e: not regexp_matches(e, '^\\s*$')) as kept
  from train_pages),
ents as (
  select page_id, station_code, day, unnest(kept[2:]) as entry, cast(unnest(range(0, len(kept) - 1)) as integer) as pos
  from pg where has_table and len(kept) > 1),
fl as (
  select page_id, pos, entry, station_code, day, string_split(entry, ',') as f from ents),
fv as (
  select page_id, pos, entry, station_code, day, len(f) >= 9 as valid,
    trim(f[1]) as category, trim(f[2]) as number, trim(f[3]) as route, trim(f[7]) as dep_planned,
    trim(f[8]) as dep_actual, {_DELAY.format(x='trim(f[6])')} as arr_delay, {_DELAY.format(x='trim(f[9])')} as dep_delay
  from fl),
parsed as (
  select page_id, pos, valid, number as train_id,
    coalesce({_CLOCK.format(t='dep_planned', d='day')}, cast(day as timestamp)) as timestamp,
    station_code, {_CLOCK.format(t='dep_planned', d='day')} as scheduled_time,
    case when not (contains(dep_actual, 'X') or contains(dep_actual, 'Non rilevato'))
         then {_CLOCK.format(t='dep_actual', d='day')} end as actual_time,
    case when dep_delay <> 0 then dep_delay else arr_delay end as delay_minutes,
    category as train_category, route,
    case when contains(dep_actual, 'X') or contains(dep_actual, 'Non rilevato') then 'cancelled'
         when (case when dep_delay <> 0 then dep_delay else arr_delay end) > 5 then 'delayed'
         when (case when dep_delay <> 0 then dep_delay else arr_delay end) < -2 then 'early'
         else 'on_time' end as delay_status,
    case when route is null or route = '' then '' when route like '%<br>%'
         then trim(split_part(split_part(route, '<br>', 2), '(', 1)) else trim(route) end as destination
  from fv)"""


def _pages(s):
    return landed.train_pages(s.trains_raw, s.table("pages"))


@register("extract_train_rows", PARSE_CTES + """
select p.page_id, p.has_table, cast(case when p.has_table then len(p.kept) else 0 end as integer) as entries_found,
  count(*) filter (where x.valid) as kept, count(*) filter (where not x.valid) as rejected
from pg p left join parsed x on x.page_id = p.page_id
group by p.page_id, p.has_table, p.kept""")
def extract_train_rows(s):
    """Per landed page, whether it holds a table and how many entries were
    found, kept and rejected (header and blank entries removed)."""
    return P.parse_train_pages(_pages(s))["counts"]


@register("parse_train_entry", PARSE_CTES + """
select page_id, pos, train_id, timestamp, station_code, scheduled_time, actual_time, delay_minutes, train_category,
  route, delay_status, destination, delay_status = 'cancelled' as is_cancelled
from parsed where valid""")
def parse_train_entry(s):
    """Every train entry of every landed page parsed to the 11 columns."""
    return P.parse_train_pages(_pages(s))["rows"]


@register("delay_status", PARSE_CTES + "\nselect page_id, pos, delay_minutes, delay_status from parsed where valid")
def delay_status(s):
    """cancelled / delayed / early / on time from the parsed entries."""
    return P.parse_train_pages(_pages(s))["rows"].select("page_id", "pos", "delay_minutes", "delay_status")


# clock texts rendered from every raw train row in each accepted and rejected form
_CLOCK_FORMS = (
    ("full", "concat(date_format(ts, 'HH:mm:ss'), ' - ', date_format(ts, 'dd/MM'))",
     "strftime(ts, '%H:%M:%S') || ' - ' || strftime(ts, '%d/%m')"),
    ("short", "date_format(ts, 'HH:mm')", "strftime(ts, '%H:%M')"),
    ("no_colon", "date_format(ts, 'HH')", "strftime(ts, '%H')"),
    ("hour_shift", "concat(cast(hour(ts) + 20 as string), ':', date_format(ts, 'mm'))",
     "cast(hour(ts) + 20 as varchar) || ':' || strftime(ts, '%M')"),
    ("cancelled", "'X'", "'X'"), ("not_detected", "'Non rilevato'", "'Non rilevato'"), ("blank", "''", "''"),
)


@register("parse_clock", "select ingest_seq, form, text, " + _CLOCK.format(t="text", d="day") + " as parsed from ("
          + " union all ".join(f"select ingest_seq, '{n}' as form, {d} as text, cast(ts as date) as day "
                               f"from (select ingest_seq, timestamp as ts from trains_raw) r" for n, _, d in _CLOCK_FORMS)
          + ") t")
def parse_clock(s):
    """clock text to that day's HH:MM:00; X / Non rilevato / blank / no
    colon / out-of-range give null; the DD/MM suffix is ignored."""
    r = s.trains_raw.select("ingest_seq", F.col("timestamp").alias("ts"))
    parts = [r.select("ingest_seq", F.lit(n).alias("form"), F.expr(e).alias("text"), F.to_date("ts").alias("day"))
             for n, e, _ in _CLOCK_FORMS]
    t = parts[0]
    for p in parts[1:]:
        t = t.unionByName(p)
    return t.select("ingest_seq", "form", "text", parse_clock_fn(F.col("text"), F.col("day")).alias("parsed"))


_DELAY_FORMS = (("plain", "cast(delay_minutes as string)", "cast(delay_minutes as varchar)"),
                ("padded", "concat(' ', cast(abs(delay_minutes) as string))",
                 "' ' || cast(abs(delay_minutes) as varchar)"),
                ("absolute", "cast(abs(delay_minutes) as string)", "cast(abs(delay_minutes) as varchar)"),
                ("large", "concat(cast(abs(delay_minutes) as string), '0000000000')",
                 "cast(abs(delay_minutes) as varchar) || '0000000000'"))


@register("parse_delay", "select ingest_seq, form, text, " + _DELAY.format(x="text") + " as delay from ("
          + " union all ".join(f"select ingest_seq, '{n}' as form, {d} as text from trains_raw"
                               for n, _, d in _DELAY_FORMS) + ") t")
def parse_delay(s):
    """all-digit delay text to int, anything else (sign, blank, null) 0."""
    r = s.trains_raw
    parts = [r.select("ingest_seq", F.lit(n).alias("form"), F.expr(e).alias("text")) for n, e, _ in _DELAY_FORMS]
    t = parts[0]
    for p in parts[1:]:
        t = t.unionByName(p)
    return t.select("ingest_seq", "form", "text", T.parse_delay(F.col("text")).alias("delay"))


_HOURLY_SQL = """
select station_code, strftime(timestamp, '%Y-%m-%dT%H:%M') as timestamp, temperature, wind_speed,
  case when pos < n - 1 then precip_mm end as precip_mm, weather_code, pos,
  try_strptime(strftime(timestamp, '%Y-%m-%dT%H:%M'), '%Y-%m-%dT%H:%M') as parsed_timestamp
from (select *, cast(row_number() over (partition by station_code, cast(timestamp as date)
                                        order by timestamp, ingest_seq) - 1 as integer) as pos,
        count(*) over (partition by station_code, cast(timestamp as date)) as n
      from weather_raw where station_code is not null and timestamp is not null) w"""


@register("explode_hourly_payload", _HOURLY_SQL)
def explode_hourly_payload(s):
    """A5: landed hourly payloads to one row per hour (time drives, a short
    array gives nulls), timestamps parsed strictly (F3)."""
    x = P.explode_hourly(landed.hourly_payloads(s.weather_raw))
    return x.withColumn("parsed_timestamp", strict_weather_time("timestamp"))


_FEED_SQL = f"""
select station_code, station_name, latitude, longitude from (
  select case when n_regionkey = 0 then '' else 'S' || lpad(cast(n_nationkey as varchar), 2, '0') end as station_code,
    n_name as station_name,
    case when n_nationkey % 11 = 0 then null when n_nationkey % 8 = 7 then null
         else 44.7e0 + n_nationkey * 0.09e0 end as latitude,
    case when n_nationkey % 8 = 7 then null else 8.4e0 + ((n_nationkey * 7) % 25) * 0.13e0 end as longitude,
    n_nationkey % 11 = 0 as bad
  from nation) f
where station_code <> '' and not bad and latitude is not null and longitude is not null
  and (select sum(case when ((y1 > f.latitude) != (y2 > f.latitude))
                   and f.longitude < (x2 - x1) * (f.latitude - y1) / (y2 - y1) + x1 then 1 else 0 end) % 2
       from ({ring_edges_sql(EXAMPLE_REGION)}) e(x1, y1, x2, y2)) = 1"""


@register("parse_station_feed", _FEED_SQL)
def parse_station_feed(s):
    """A8 + D3: station feed records to stations inside the region."""
    return P.parse_station_feed(landed.station_feed(s.table("nation")))


# ---- files written by one job and scanned by the next (A4, A9) -------------------------

@register("scan_curated_csv", "select station_code, timestamp, temperature, wind_speed, precip_mm, weather_code, "
                             "cast(year(timestamp) as integer) as year, station_code as file_station from weather")
def scan_curated_csv(s):
    """A4: curated weather CSV files (written per station and year, header
    once) read back with an explicit schema and their file paths."""
    path = new_work_dir(s.spark, "curated-csv")
    B.write_partitioned(B.curated_weather(s.weather), path, partition_by=("station_code", "year"), fmt="csv",
                        mode="overwrite")
    from pyspark.sql.types import IntegerType, StructType
    schema = StructType(list(WEATHER.fields)).add("year", IntegerType())
    df = s.spark.read.schema(schema).option("header", True).options(**B.TS_OPTIONS).csv(path)
    src = F.regexp_extract(F.col("_metadata.file_path"), "station_code=([^/]+)", 1)
    return df.select(*WEATHER.fieldNames(), "year", src.alias("file_station"))


@register("scan_raw_json", "select strftime(timestamp, '%Y-%m-%d') as date, station_code, train_id, timestamp, "
                          "delay_minutes, delay_status from trains_raw")
def scan_raw_json(s):
    """Raw train documents landed as JSON under date/station folders, read
    back recursively with an explicit schema."""
    path = new_work_dir(s.spark, "raw-json")
    B.write_partitioned(B.land_raw(s.trains_raw), path, partition_by=("date", "station_code"), fmt="json",
                        mode="overwrite")
    df = s.spark.read.schema("payload string, date string, station_code string").json(path)
    doc = "struct<train_id:string, timestamp:timestamp_ntz, delay_minutes:int, delay_status:string>"
    return df.select("date", "station_code", F.from_json("payload", doc, B.TS_OPTIONS).alias("r")).select(
        "date", "station_code", "r.*")
