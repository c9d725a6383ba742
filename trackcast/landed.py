"""Landed raw documents rendered from the adapter rows (stand-in inputs).

These builders only render rows into the raw shapes the parsers read (a
train page with an embedded table, an hourly weather payload, a station
feed); they do none of the parsers' work. Each has a Spark form and a DuckDB
form producing the same documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Entries in a fragment of a rendered document, and sequence numbers in a slot that is numbered on its own.
FRAGMENT = 500
SLOT = 1 << 16

# FIXED VALUES: page layout around the table and its header entry.
PAGE_HEAD = "<html><body><script>var table = ["
PAGE_TAIL = "];</script></body></html>"
HEADER_ENTRY = "Categoria,Numero,Tratta,Arrivo programmato,Arrivo reale,Ritardo arrivo,Partenza programmata,Partenza reale,Ritardo partenza"
NOTE_PREFIX = "Aggiornato alle "


def _entry_spark() -> F.Column:
    c = F.col
    clock = lambda ts: F.concat(F.date_format(ts, "HH:mm:ss"), F.lit(" - "), F.date_format(ts, "dd/MM"))
    dep_actual = (F.when(c("is_cancelled"), F.lit("X")).when(c("actual_time").isNull(), F.lit("Non rilevato"))
                  .otherwise(F.date_format("actual_time", "HH:mm")))
    delay = F.coalesce(c("delay_minutes").cast("string"), F.lit(""))
    return F.concat_ws(",", c("train_category"), c("train_id"), F.coalesce(c("route"), F.lit("")),
                       clock(c("scheduled_time")), F.coalesce(F.date_format("actual_time", "HH:mm"), F.lit("")), delay,
                       clock(c("scheduled_time")), dep_actual, delay)


def with_positions(rows: DataFrame, group: list[str], slot: Column, order: list[str]) -> DataFrame:
    """``rows`` with their position ``pos`` in their group and its number of rows ``n``.

    ``slot`` rises with the order; slots are counted (combined before the shuffle) and their counts summed up per group, rows are
    numbered within a slot only. So no task sorts a whole group, however large, but one row per slot of it."""
    rows = rows.withColumn("_slot", slot)
    key = [*group, "_slot"]
    counts = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy(*group)
    counts = counts.select(*key, (F.sum("_n").over(whole.orderBy("_slot")) - F.col("_n")).alias("_first"), F.sum("_n").over(whole).alias("n"))
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return (rows.withColumn("_rank", rank).join(counts, key)
            .withColumn("pos", F.col("_first") + F.col("_rank") - 1).drop("_slot", "_rank", "_first"))


def train_pages(trains_raw: DataFrame, pages: DataFrame) -> DataFrame:
    """One page per (station, hour) holding header + entries + a blank entry +
    a short note entry, in fragments whose ``first`` is the position of their first train; plus every page of the
    ``pages`` table (no table), each one fragment."""
    t = trains_raw.where(F.col("station_code").isNotNull() & F.col("timestamp").isNotNull()).select(
        "station_code", F.date_format("timestamp", "yyyy-MM-dd HH").alias("hour"), "ingest_seq", _entry_spark().alias("e"))
    page = t.groupBy("station_code", "hour").agg(F.min("ingest_seq").alias("page_id"))
    at = with_positions(t, ["station_code", "hour"], F.expr(f"ingest_seq div {SLOT}"), ["ingest_seq"])
    g = at.groupBy("station_code", "hour", "n", F.expr(f"pos div {FRAGMENT} * {FRAGMENT}").alias("first")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "e"))).alias("es"))
    quoted = F.array_join(F.transform(F.col("es"), lambda x: F.concat(F.lit("'"), x["e"], F.lit("'"))), ",")
    head = F.when(F.col("first") == 0, F.lit(f"'{HEADER_ENTRY}',")).otherwise("")
    note = F.when(F.col("first") + F.size("es") == F.col("n"), F.concat(
        F.lit(",'  ','" + NOTE_PREFIX), F.substring("hour", 12, 2), F.lit("'"))).otherwise("")
    html = F.concat(F.lit(PAGE_HEAD), head, quoted, note, F.lit(PAGE_TAIL))
    gen = g.join(page, ["station_code", "hour"]).select(
        F.col("page_id").cast("bigint").alias("page_id"), "station_code",
        F.to_date(F.substring("hour", 1, 10)).alias("day"), html.alias("html"), "first")
    web = pages.select((-F.col("page_id") - 1).cast("bigint").alias("page_id"), F.lit("S00").alias("station_code"),
                       F.lit("2024-01-01").cast("date").alias("day"), "html", F.lit(0).cast("bigint").alias("first"))
    return gen.unionByName(web)


TRAIN_PAGES_SQL = f"""
train_pages as (
  select cast(min(ingest_seq) as bigint) as page_id, station_code, cast(substr(h, 1, 10) as date) as day,
    '{PAGE_HEAD}''{HEADER_ENTRY}'',' || string_agg('''' || e || '''', ',' order by ingest_seq)
      || ',''  '',''{NOTE_PREFIX}' || substr(h, 12, 2) || '''{PAGE_TAIL}' as html
  from (select station_code, ingest_seq, strftime(timestamp, '%Y-%m-%d %H') as h,
          concat_ws(',', train_category, train_id, coalesce(route, ''),
            strftime(scheduled_time, '%H:%M:%S') || ' - ' || strftime(scheduled_time, '%d/%m'),
            coalesce(strftime(actual_time, '%H:%M'), ''), coalesce(cast(delay_minutes as varchar), ''),
            strftime(scheduled_time, '%H:%M:%S') || ' - ' || strftime(scheduled_time, '%d/%m'),
            case when is_cancelled then 'X' when actual_time is null then 'Non rilevato'
                 else strftime(actual_time, '%H:%M') end,
            coalesce(cast(delay_minutes as varchar), '')) as e
        from trains_raw where station_code is not null and timestamp is not null) x
  group by station_code, h
  union all
  select -page_id - 1, 'S00', date '2024-01-01', html from pages)"""


def hourly_payloads(weather_raw: DataFrame) -> DataFrame:
    """One payload per (station, day): parallel hourly arrays; the
    precipitation array stops one hour short (a shorter array). In fragments whose ``first`` is the position of their first hour."""
    w = weather_raw.where(F.col("station_code").isNotNull() & F.col("timestamp").isNotNull()).withColumn("day", F.to_date("timestamp"))
    at = with_positions(w, ["station_code", "day"], F.date_trunc("minute", "timestamp"), ["timestamp", "ingest_seq"])
    g = at.groupBy("station_code", "day", "n", F.expr(f"pos div {FRAGMENT} * {FRAGMENT}").alias("first")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "timestamp", "temperature", "precip_mm", "wind_speed", "weather_code"))).alias("r"))
    arr = lambda name: F.transform("r", lambda x: x[name])
    short = F.when(F.col("first") + F.size("r") == F.col("n"), F.size("r") - 1).otherwise(F.size("r"))
    hourly = F.struct(F.transform("r", lambda x: F.date_format(x["timestamp"], "yyyy-MM-dd'T'HH:mm")).alias("time"),
                      arr("temperature").alias("temperature_2m"),
                      F.slice(arr("precip_mm"), F.lit(1), short).alias("precipitation"),
                      arr("wind_speed").alias("windspeed_10m"), arr("weather_code").alias("weathercode"))
    return g.select("station_code", "day", F.to_json(F.struct("station_code", hourly.alias("hourly"))).alias("payload"), "first")


def station_feed(nation: DataFrame) -> DataFrame:
    """Station feed records: one per nation row, code blank for region 0,
    unparseable latitude text where the key is a multiple of 11."""
    k = F.col("n_nationkey")
    code = F.when(F.col("n_regionkey") == 0, F.lit("")).otherwise(
        F.concat(F.lit("S"), F.lpad(k.cast("string"), 2, "0")))
    lat = F.when(k % 11 == 0, F.lit("n/a")).when(k % 8 == 7, F.lit(None)).otherwise(
        (F.lit(44.7) + k * F.lit(0.09)).cast("string"))
    lon = F.when(k % 8 == 7, F.lit(None)).otherwise((F.lit(8.4) + ((k * 7) % 25) * F.lit(0.13)).cast("string"))
    doc = F.to_json(F.struct(code.alias("codiceStazione"), F.struct(F.col("n_name").alias("nomeLungo")).alias("localita"),
                             lat.alias("lat"), lon.alias("lon")))
    return nation.select(k.alias("feed_id"), doc.alias("doc"))
